"""Secret scan over an incremental ledger of content-addressed blobs.

Every historical version of a file is a row with a path and a text. A blob is a
distinct text, addressed by its SHA-256. The ledger holds one row per blob and
version of the rules that was scanned, with the findings; a run scans only the
pairs the ledger lacks, and joins findings back to all paths of a blob.

Null text counts as empty; repeated rows are repeated paths of one blob. An
empty table gives an empty result. Columns beyond those named are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import slices

FOUND = "array<struct<kind:string,start:bigint,end:bigint>>"


@dataclass(frozen=True)
class Rule:
    """A kind of secret: a pattern, and how long a group of a match must be."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


# The first three are what every user of the report expects.
BASE = ("assign", "access", "hex")
RULES = (
    Rule(
        "assign",
        r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        6,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    # The runs of at least 24 are the runs of any length of which the shorter fail.
    Rule("hex", r"[0-9a-f]{24,}", 0, 24),
    Rule("pem", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("webtoken", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("forge", r"gh[pousr]_[A-Za-z0-9]{36,}"),
)


def version_of(rules: Sequence[Rule]) -> str:
    """Names the rules by their content, so that a changed rule is a new version."""
    return hashlib.sha256(repr(tuple(rules)).encode()).hexdigest()[:16]


def find(text: str, compiled: Sequence[tuple[Rule, re.Pattern]]) -> list[dict]:
    """All findings in a text by start, then in the order of the rules."""
    found = []
    for rank, (rule, pattern) in enumerate(compiled):
        for m in pattern.finditer(text):
            start, end = m.span(rule.group)
            if end - start >= rule.least:
                found.append((m.start(), rank, m.end(), rule.kind))
    return [{"kind": kind, "start": start, "end": end} for start, _, end, kind in sorted(found)]


def address(text: Column) -> Column:
    """A blob's address: the SHA-256 of its UTF-8 bytes."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256))


def _ledger(spark: SparkSession, path: str, version: str) -> DataFrame | None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        return None
    return spark.read.schema(f"blob binary, found {FOUND}, rule_version string").parquet(path).where(
        F.col("rule_version") == version
    )


def scan(
    versions: DataFrame, ledger: str, text: str = "text", rules: Sequence[Rule] = RULES
) -> int:
    """Scan the blobs of ``versions`` that ``ledger`` lacks for these rules, and add them.

    Distinct blobs are reduced to one row per map task before the shuffle, so a
    text with a third of all rows moves once per task. Blobs already in the
    ledger leave before their text is read by a regular expression. Returns the
    number of pairs added.
    """
    spark, version = versions.sparkSession, version_of(rules)
    blobs = versions.select(
        address(F.col(text)).alias("blob"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    known = _ledger(spark, ledger, version)
    if known is not None:
        blobs = blobs.join(known.select("blob"), "blob", "left_anti")
    distinct = blobs.groupBy("blob").agg(F.first("text").alias("text"))
    kind = pa.list_(
        pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
    )
    rules = tuple(rules)

    def scanned(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = [(r, re.compile(r.pattern, re.ASCII)) for r in rules]
        for batch in slices(batches, "text"):
            found = [find(t, compiled) for t in batch.column("text").to_pylist()]
            yield pa.record_batch(
                [batch.column("blob"), pa.array(found, kind)], names=["blob", "found"]
            )

    added = distinct.mapInArrow(scanned, f"blob binary, found {FOUND}")
    before = known.count() if known is not None else 0
    added.withColumn("rule_version", F.lit(version)).write.mode("append").parquet(ledger)
    return _ledger(spark, ledger, version).count() - before


def findings(
    versions: DataFrame,
    ledger: str,
    paths: Sequence[str],
    text: str = "text",
    rules: Sequence[Rule] = RULES,
) -> DataFrame:
    """For every row of ``versions`` its ``paths`` columns, ``blob`` and the blob's ``found``.

    The join's sides are both plain shuffles, so Spark can split a blob that many
    paths share.
    """
    known = _ledger(versions.sparkSession, ledger, version_of(rules))
    rows = versions.select(*paths, address(F.col(text)).alias("blob"))
    return rows.join(known.select("blob", "found"), "blob", "left")
