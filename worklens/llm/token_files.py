"""Token ids of a corpus in compact files.

Ids are replaced by their rank in the corpus's frequencies, so that common ids
are small, and written in a byte-aligned code of variable length: the lengths
(1 to 4 bytes) of four numbers share a control byte, and control bytes stand
apart from the data bytes. Decoding looks the lengths up in a table of the 256
control bytes and gathers the bytes with numpy.

A file is a Parquet part that Spark writes, so any store and a lost executor
are its matter: one row per block with ``part`` (ranges of ``doc_id`` in
order), ``block``, ``before`` (ids of the part before the block), ``doc_ids``,
``counts``, ``control`` and ``data``. The ranks lie beside them.

Null text counts as empty: the end id alone. Rows that share a ``doc_id`` follow
each other, ordered by their text's hash; null ids come first. An empty table
gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop, saved, slices
from .tokens import ENCODE_BYTES, encode

#: Bytes beyond the first of the four numbers of each control byte, side by side.
EXTRA = (
    (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3).astype(np.uint8).copy().view(np.uint32)[:, 0]
)

FILE = (
    "part int, block int, before bigint, doc_ids array<bigint>, counts array<bigint>, "
    "control binary, data binary"
)


def pack(numbers: np.ndarray) -> tuple[bytes, bytes]:
    """Control and data bytes of unsigned 32-bit numbers."""
    most = int(numbers.max(initial=0))
    width = 1 if most < 1 << 8 else 2 if most < 1 << 16 else 3 if most < 1 << 24 else 4
    numbers = numbers.astype(np.uint16 if width < 3 else np.uint32)
    codes = np.zeros(-(-len(numbers) // 4) * 4, np.uint8)
    extra = codes[: len(numbers)]
    for k in range(1, width):
        extra += numbers >= 1 << 8 * k
    at = np.cumsum(extra, dtype=np.int64)
    size = int(at[-1]) + len(numbers) if len(numbers) else 0
    at -= extra
    at += np.arange(len(numbers))
    data = np.empty(size, np.uint8)
    data[at] = numbers.astype(np.uint8)
    for k in range(1, width):
        has = np.flatnonzero(extra >= k)
        data[at[has] + k] = (numbers[has] >> 8 * k).astype(np.uint8)
    four = codes.reshape(-1, 4)
    control = four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6
    return control.tobytes(), data.tobytes()


def unpack(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ``n`` numbers that ``pack`` wrote."""
    extra = EXTRA[np.frombuffer(control, np.uint8)].view(np.uint8)[:n]
    raw = np.frombuffer(data, np.uint8)
    at = np.cumsum(extra, dtype=np.int64)
    at -= extra
    at += np.arange(n)
    numbers = raw[at].astype(np.uint32)
    for k in range(1, int(extra.max(initial=0)) + 1):
        has = np.flatnonzero(extra >= k)
        numbers[has] |= raw[at[has] + k].astype(np.uint32) << np.uint32(8 * k)
    return numbers


_IDS = (
    "part int, block int, before bigint, doc_ids array<bigint>, counts array<bigint>, "
    "ids array<bigint>, often array<bigint>, control binary, data binary"
)


def write(
    docs: DataFrame,
    folder: str,
    path: str,
    end_id: int,
    doc_id: str = "doc_id",
    text: str = "text",
) -> None:
    """Tokenize whole texts and write their ids to ``folder`` by ascending ``doc_id``.

    Texts move once, by ranges, and are tokenized once. Their ids are first written with
    ranks by the frequencies of their own block, which the block carries; the sums
    of those are the corpus's frequencies, at most one per id of the vocabulary,
    and a second pass over the compact blocks puts its ranks in place of theirs.
    """
    spark = docs.sparkSession

    def blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before = TaskContext.get().partitionId(), 0
        for k, batch in enumerate(slices(batches, "text", ENCODE_BYTES)):
            ids, offsets = encode(batch.column("text"), path, end_id)
            total = np.bincount(ids)
            by_rank = np.argsort(-total, kind="stable")[: np.count_nonzero(total)]
            rank_of = np.zeros(len(total), np.uint32)
            rank_of[by_rank] = np.arange(len(by_rank), dtype=np.uint32)
            control, data = pack(rank_of[ids])
            yield _one_row(
                _IDS,
                [part, k, before, batch.column("doc_id"), np.diff(offsets), by_rank, total[by_rank], control, data],
            )
            before += len(ids)

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    # The order of ties must not depend on the run, so the hash decides them everywhere.
    tie = F.xxhash64("text")
    ranged = rows.repartitionByRange(parts, "doc_id", tie).sortWithinPartitions("doc_id", tie)
    local = saved(ranged.mapInArrow(blocks, _IDS), "token-blocks", keep=False)
    total = (
        local.select(F.explode(F.arrays_zip("ids", "often")).alias("x"))
        .groupBy(F.col("x.ids").alias("id"))
        .agg(F.sum("x.often").alias("n"))
        .toArrow()
        .to_pandas()
        .sort_values(["n", "id"], ascending=[False, True])
    )
    by_rank = total["id"].to_numpy(np.int64)
    spark.createDataFrame(
        pa.table({"rank": pa.array(np.arange(len(by_rank)), pa.int64()), "id": pa.array(by_rank)})
    ).coalesce(1).write.parquet(f"{folder}/ranks")
    rank_of = np.zeros(int(by_rank.max(initial=0)) + 1, np.uint32)
    rank_of[by_rank] = np.arange(len(by_rank), dtype=np.uint32)

    def ranked(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: batch.column(n)[i] for n in batch.schema.names}
                n = int(pc.sum(row["counts"].values).as_py())
                local_ranks = unpack(row["control"].as_buffer(), row["data"].as_buffer(), n)
                control, data = pack(rank_of[row["ids"].values.to_numpy()][local_ranks])
                yield _one_row(
                    FILE,
                    [*(row[c].as_py() for c in ("part", "block", "before")), row["doc_ids"].values, row["counts"].values, control, data],
                )

    local.mapInArrow(ranked, FILE).write.parquet(f"{folder}/ids")
    drop(local)


def _one_row(schema: str, values: list) -> pa.RecordBatch:
    columns = []
    for field, value in zip(schema.split(", "), values, strict=True):
        name, kind = field.split()
        if kind == "array<bigint>":
            item = pa.array(value, pa.int64())
            columns.append((name, pa.ListArray.from_arrays(pa.array([0, len(item)], pa.int32()), item)))
        else:
            arrow = {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary()}[kind]
            columns.append((name, pa.array([value], arrow)))
    return pa.record_batch([c for _, c in columns], names=[n for n, _ in columns])


def read(spark, folder: str) -> DataFrame:
    """Per document of the files: ``doc_id, start, n_tokens, ids`` in the files' order.

    ``ids`` holds the ids as little-endian unsigned 32-bit integers.
    """
    files = spark.read.schema(FILE).parquet(f"{folder}/ids")
    by_rank = (
        spark.read.schema("rank bigint, id bigint").parquet(f"{folder}/ranks")
        .toArrow()
        .to_pandas()
        .sort_values("rank")["id"]
        .to_numpy(np.uint32)
    )
    # One row per part; the parts are the ranges of the writing shuffle.
    totals = (
        files.select("part", F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x).alias("n"))
        .groupBy("part")
        .agg(F.sum("n").alias("n"))
        .toArrow()
        .to_pandas()
        .sort_values("part")
    )
    first = dict(zip(totals["part"], totals["n"].cumsum() - totals["n"], strict=True))

    def documents(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: batch.column(n)[i] for n in batch.schema.names}
                counts = row["counts"].values.to_numpy()
                ends = np.cumsum(counts)
                control, data = row["control"].as_buffer(), row["data"].as_buffer()
                ids = by_rank[unpack(control, data, int(counts.sum()))]
                raw = memoryview(ids.astype("<u4")).cast("B")
                bounds = zip(ends - counts, ends, strict=True)
                yield pa.record_batch(
                    [
                        row["doc_ids"].values,
                        pa.array(ends - counts + row["before"].as_py() + first[row["part"].as_py()]),
                        row["counts"].values,
                        pa.array([bytes(raw[4 * a : 4 * b]) for a, b in bounds], pa.binary()),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids"],
                )

    return files.mapInArrow(documents, "doc_id bigint, start bigint, n_tokens bigint, ids binary")

