"""Personal data by patterns, and by contexts bootstrapped from what they find.

Emails, IP addresses, card and phone numbers that pass their tests are the seed
entities. The word before and the word after an entity are its lexical patterns, and so is
its own shape: runs of digits with their length, runs of letters, and the marks between.
Other tokens that look like identifiers are candidates, with their patterns.
Spark scores the graph of patterns and instances in rounds. A word's confidence is the share of all its
occurrences in the corpus that stand by an entity of the kind; a shape's is the share of
seeds among all tokens of that shape that look like identifiers. Candidates in a pattern of high
confidence, which several different instances support, become entities of the kind, and the words
beside them patterns of the next round. What the last round's patterns reveal is returned.

Null text counts as empty: no entities. Copies of a text count as often as they
occur, but support a pattern once. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, NOT_ALNUM, drop, filled, saved, signed, slices, span_hashes
from .common import prefix_sums, text_bytes, word_hashes, words
from .secrets import address

#: The kinds in the order reports list them.
KINDS = ("email", "ip", "card", "phone")
ROUNDS = 3
#: Distinct entities that must support a pattern, and the confidence it needs.
SUPPORT = 3
CONFIDENCE = 0.5
#: The same for shapes. One run of digits in ten passes a card's test by chance; where three
#: in ten do, the others are mostly cards with a wrong digit.
SHAPE_CONFIDENCE = 0.3
#: Occurrences without an entity that every pattern is given beforehand.
PRIOR = 2.0

SPANS = "array<struct<kind:string,start:bigint,end:bigint>>"
MENTIONS = "array<struct<kind:string,start:bigint,end:bigint,instance:bigint,before:bigint,after:bigint,shape:bigint>>"

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A run of digits that fails from its start fails from within, so only starts are tried.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TOKEN = re.compile(r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+")
_WORD = re.compile(r"[A-Za-z0-9\u0080-\U0010ffff]+")
_RUN = re.compile(r"[0-9]+|[A-Za-z\u0080-\U0010ffff]+")
#: Characters beside an entity in which its neighbours are looked for.
_WINDOW = 100


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of local part, ``@`` and dotted domain, in time linear in the text."""
    done, at = 0, text.find("@")
    while at >= 0:
        run = text[done:at]
        start = done + len(run.rstrip(_LOCAL))
        done = at + 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            yield start, m.end()
            done = m.end()
        at = text.find("@", done)


def find(text: str) -> list[tuple[str, int, int]]:
    """The seed entities by kind, then start; leftmost and without overlap in a kind."""
    found = [("email", a, b) for a, b in _emails(text)] if "@" in text else []
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in m[0].split(".")):
            found.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                found.append(("phone", *m.span()))
    return found


def _candidates(text: str, seeds: list[tuple[str, int, int]]) -> Iterator[tuple[int, int]]:
    """Tokens with five digits or an ``@`` that touch no seed, without the marks around them."""
    taken = sorted((a, b) for _, a, b in seeds)
    k = 0
    for m in _TOKEN.finditer(text):
        raw = m[0].strip(".,;:!?()[]{}<>\"'`*$%&#|")
        if len(raw) < 6 or not (sum(c.isdigit() for c in raw) >= 5 or "@" in raw[1:-1]):
            continue
        start = m.start() + m[0].index(raw)
        while k < len(taken) and taken[k][1] <= m.start():
            k += 1
        if k == len(taken) or taken[k][0] >= m.end():
            yield start, start + len(raw)


def _neighbours(text: str, start: int, end: int) -> tuple[str, str]:
    """The words next to a span, lower-cased; empty where there is none."""
    low = max(0, start - _WINDOW)
    before = after = ""
    for m in _WORD.finditer(text, low, start):
        # a word that the window cuts is not known whole
        before = m[0] if m.start() > low or low == 0 else ""
    if (m := _WORD.search(text, end, end + _WINDOW)) and m.end() < end + _WINDOW:
        after = m[0]
    return before, after


def _shape(token: str) -> str:
    """Runs of digits by their length, runs of letters, and marks as they are."""
    return _RUN.sub(lambda m: f"9{len(m[0])}" if m[0][0] in "0123456789" else "a", token)


def _hashed(texts: list[str]) -> list[int | None]:
    """The words' hashes as ``words`` gives them; None for no word."""
    data, offsets = text_bytes(pa.array(texts, pa.large_string()))
    h = signed(span_hashes(prefix_sums(LOWER[data]), offsets[:-1], offsets[1:]))
    return [int(x) if t else None for x, t in zip(h, texts, strict=True)]


def _scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per document with seeds and mentions, and at the end one with the word counts."""
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
    mention = pa.struct(
        [*span, *((n, pa.int64()) for n in ("instance", "before", "after", "shape"))]
    )
    names = ["doc_id", "blob", "spans", "mentions", "words", "counts"]
    seen, often = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for batch in slices(batches, "text"):
        texts = filled(batch.column("text"))
        data, offsets = text_bytes(texts)
        data = LOWER[data]
        starts, ends, _ = words(data, offsets, NOT_ALNUM)
        h, n = np.unique(signed(word_hashes(data, starts, ends)), return_counts=True)
        seen, back = np.unique(np.concatenate([seen, h]), return_inverse=True)
        often = np.bincount(back, np.concatenate([often, n]), len(seen)).astype(np.int64)
        spans, kept = [], []
        for text in texts.to_pylist():
            found = find(text)
            spans.append([{"kind": k, "start": a, "end": b} for k, a, b in found])
            both = [*found, *((None, a, b) for a, b in _candidates(text, found))]
            rows = [(k, a, b, text[a:b], *_neighbours(text, a, b), _shape(text[a:b])) for k, a, b in both]
            kept.append(rows)
        flat = [r for rows in kept for r in rows]
        hashed = (_hashed([r[i] for r in flat]) for i in (3, 4, 5, 6))
        at = np.cumsum([0, *map(len, kept)])
        listed = [
            {"kind": r[0], "start": r[1], "end": r[2], "instance": i, "before": b, "after": a, "shape": s}
            for r, i, b, a, s in zip(flat, *hashed, strict=True)
        ]
        none = pa.nulls(batch.num_rows, pa.list_(pa.int64()))
        yield pa.record_batch(
            [
                batch.column("doc_id"),
                batch.column("blob"),
                pa.array(spans, pa.list_(span)),
                pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(listed, mention)),
                none,
                none,
            ],
            names=names,
        )
    yield pa.record_batch(
        [
            pa.nulls(1, pa.int64()),
            pa.nulls(1, pa.binary()),
            pa.nulls(1, pa.list_(span)),
            pa.nulls(1, pa.list_(mention)),
            pa.array([seen], pa.list_(pa.int64())),
            pa.array([often], pa.list_(pa.int64())),
        ],
        names=names,
    )


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One pass over all texts, written: ``doc_id, blob, spans, mentions`` and word counts."""
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        address(F.col(text)).alias("blob"),
        F.col(text).alias("text"),
    )
    schema = (
        f"doc_id bigint, blob binary, spans {SPANS}, mentions {MENTIONS}, "
        "words array<bigint>, counts array<bigint>"
    )
    return saved(rows.mapInArrow(_scan, schema), "pii-scan")


def _patterns_of(mentions: DataFrame) -> DataFrame:
    """A row per mention and pattern: what the mentions have, ``side`` and ``word``."""
    sides = F.array(
        *(F.struct(F.lit(side).alias("side"), F.col(f"m.{side}").alias("word")) for side in ("before", "after", "shape"))
    )
    return mentions.withColumn("s", F.explode(sides)).where(F.col("s.word").isNotNull())


def patterns(
    scanned: DataFrame, rounds: int = ROUNDS, support: int = SUPPORT, confidence: float = CONFIDENCE
) -> DataFrame:
    """``side, word, kind, confidence`` of the patterns of high confidence.

    Every step is a join or an aggregate over mentions, which are few beside the
    texts; each round's new entities are written, so a round never repeats another.
    """
    mentions = scanned.where(F.size("mentions") > 0).select(F.explode("mentions").alias("m"))
    edges = saved(
        _patterns_of(mentions)
        .groupBy("s.side", "s.word", "m.instance", "m.kind")
        .agg(F.count(F.lit(1)).cast("double").alias("n")),
        "pii-edges",
        keep=False,
    )
    beside = edges.where("side <> 'shape'").select("word").distinct()
    in_corpus = (
        scanned.where(F.col("words").isNotNull())
        .select(F.explode(F.arrays_zip("words", "counts")).alias("w"))
        .groupBy(F.col("w.words").alias("word"))
        .agg(F.sum("w.counts").alias("total"))
        .join(beside, "word", "left_semi")
        .select(F.explode(F.array(F.lit("before"), F.lit("after"))).alias("side"), "word", F.col("total").cast("double"))
    )
    of_shape = edges.where("side = 'shape'").groupBy("side", "word").agg(F.sum("n").alias("total"))
    totals = saved(in_corpus.unionByName(of_shape), "pii-totals", keep=False)
    seeds, others = edges.where(F.col("kind").isNotNull()), edges.where(F.col("kind").isNull()).drop("kind")
    entities, written = seeds, []
    for _ in range(rounds):
        supported = (
            entities.groupBy("side", "word", "kind")
            .agg(F.sum("n").alias("hits"), F.count(F.lit(1)).alias("supports"))
            .where(F.col("supports") >= support)
        )
        share = F.least("hits", "total") / (F.col("total") + F.lit(PRIOR))
        needed = F.when(F.col("side") == "shape", F.lit(SHAPE_CONFIDENCE)).otherwise(F.lit(confidence))
        good = (
            supported.join(totals, ["side", "word"])
            .select("side", "word", "kind", share.alias("confidence"))
            .where(F.col("confidence") >= needed)
        )
        good = saved(good, "pii-good", keep=False)
        found = (
            others.join(good, ["side", "word"])
            .groupBy("instance")
            .agg(F.max_by("kind", F.struct("confidence", "kind")).alias("kind"))
        )
        # Their shape is no evidence: only seeds have passed a test of what they are.
        entities = seeds.unionByName(others.where("side <> 'shape'").join(found, "instance").select(*seeds.columns))
        written.append(good)
    result = saved(good, "pii-confidence")
    for df in (edges, totals, *written):
        drop(df)
    return result


def discovered(scanned: DataFrame, confidence: float = CONFIDENCE) -> DataFrame:
    """``blob, extra``: for each text the entities that contexts alone reveal, by kind and start."""
    good = patterns(scanned, confidence=confidence)
    mentions = (
        scanned.where(F.size("mentions") > 0)
        .select("blob", F.explode("mentions").alias("m"))
        .where(F.col("m.kind").isNull())
    )
    spans = (
        _patterns_of(mentions)
        .select("blob", "m.start", "m.end", "s.side", "s.word")
        .join(good, ["side", "word"])
        .groupBy("blob", "start", "end")
        .agg(F.max_by("kind", F.struct("confidence", "kind")).alias("kind"))
    )
    order = F.struct(kind_rank(F.col("kind")).alias("rank"), "start", "kind", "end")
    listed = spans.groupBy("blob").agg(F.array_sort(F.collect_list(order)).alias("x"))
    return saved(
        listed.select(
            "blob",
            F.transform("x", lambda r: F.struct(r["kind"].alias("kind"), r["start"].alias("start"), r["end"].alias("end"))).alias("extra"),
        ),
        "pii-extra",
    )


def kind_rank(kind: Column) -> Column:
    return F.array_position(F.array(*map(F.lit, KINDS)), kind)


def detect(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row ``doc_id``, the seeds ``spans``, and ``extra`` entities found by context."""
    scanned = scan(docs, doc_id, text)
    extra = discovered(scanned)
    rows = scanned.where(F.col("spans").isNotNull()).select("doc_id", "blob", "spans")
    return rows.join(extra, "blob", "left").select(
        "doc_id", "spans", F.coalesce("extra", F.array().cast(SPANS)).alias("extra")
    )


def redact(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with every entity in the text replaced by its kind in brackets.

    Overlapping entities are replaced together, under the kind of the first. Null
    text stays null.
    """
    scanned = scan(docs, doc_id, text)
    extra = discovered(scanned)
    names = docs.columns
    key, more = "_worklens_blob", "_worklens_extra"
    rows = docs.withColumn(key, address(F.col(text))).join(
        extra.select(F.col("blob").alias(key), F.col("extra").alias(more)), key, "left"
    ).select(*(F.col(f"`{n}`") for n in names), F.col(more))

    def replaced(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            out = []
            for t, extra in zip(batch.column(text).to_pylist(), batch.column(more).to_pylist(), strict=True):
                spans = sorted(
                    [(a, b, k) for k, a, b in find(t or "")]
                    + [(x["start"], x["end"], x["kind"]) for x in extra or ()]
                )
                if not spans:
                    out.append(t)
                    continue
                parts, done = [], 0
                for a, b, k in spans:
                    if a >= done:
                        parts += [t[done:a], f"[{k.upper()}]"]
                    done = max(done, b)
                out.append("".join([*parts, t[done:]]))
            at = batch.schema.get_field_index(text)
            yield pa.record_batch(
                [
                    pa.array(out, batch.column(text).type) if i == at else c
                    for i, c in enumerate(batch.columns)
                    if batch.schema.names[i] != more
                ],
                names=[n for n in batch.schema.names if n != more],
            )

    return rows.mapInArrow(replaced, docs.schema)
