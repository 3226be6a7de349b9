"""Draw the documents most like a target, by importance weights of hashed word runs.

Features are all runs of one to three words, hashed into ``BUCKETS`` buckets. A
bucket's gain is the logarithm of how much more often the target has it than the
documents do, as a whole number of thousandths. A document's weight is the sum of the gains of its
features, taken bit by bit: its counts per bucket become planes of bits, one for each power of two, and
so do the gains, those below zero apart. The bits that a count plane and a gain plane share
are counted (AND, popcount) and added up with their powers of two, so weights are exact.
Documents with enough words get a Gumbel number from their id, and the greatest sums are drawn.

A run's hash is put together from those of its words: CRC-32 is linear, so the one of
``a b`` follows from those of ``a`` and ``b`` and the length of ``b``.

What the driver and every task hold is ``BUCKETS`` counts, whatever the corpus. Ranks
come from a running number within ranges of the order, plus the ranges before.

Null text has no words; texts with fewer than ``LEAST`` words are weighed but never drawn. Texts
are read whole, of any length. Rows with repeated ids are documents of their own, with the same
number from their id; a null id counts as the empty string there and comes last in ties. An empty table
gives no rows; an empty target makes every gain the same function of the document counts. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, NOT_ALNUM, filled, saved, slices, text_bytes, words

BUCKETS = 10_000
#: Words of the longest run.
RUN = 3
#: Words that a document needs to be drawn.
LEAST = 20
#: Documents whose counts are planes at once; bounds the memory of the counts.
PLANED = 256

_BYTES = -(-BUCKETS // 64) * 8  # of a plane, in whole 64-bit words


# --- hashes of runs of words -------------------------------------------------------


def _shifts() -> np.ndarray:
    """``[b, k, v]``: what byte ``v`` at place ``k`` of a CRC becomes when ``2**b`` more bytes follow."""
    tables = np.zeros((32, 4, 256), np.uint32)
    zero = zlib.crc32(b"\0", 0xFFFFFFFF) ^ 0xFFFFFFFF
    for k in range(4):
        for v in range(256):
            tables[0, k, v] = zlib.crc32(b"\0", (v << 8 * k) ^ 0xFFFFFFFF) ^ 0xFFFFFFFF ^ zero
    for b in range(1, 32):
        tables[b] = _through(tables[b - 1], tables[b - 1])
    return tables


def _through(table: np.ndarray, crc: np.ndarray) -> np.ndarray:
    out = table[0][crc & 255]
    for k in (1, 2, 3):
        out = out ^ table[k][(crc >> np.uint32(8 * k)) & 255]
    return out


_SHIFTS = _shifts()


def followed(crc: np.ndarray, length: np.ndarray, last: np.ndarray) -> np.ndarray:
    """CRCs of two strings in a row, from both CRCs and the length of the second."""
    crc = crc.copy()
    for b in range(int(length.max(initial=0)).bit_length()):
        rows = np.flatnonzero((length >> b) & 1)
        crc[rows] = _through(_SHIFTS[b], crc[rows])
    return crc ^ last


def features(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all features, the text each is of, and the words of each text."""
    data, offsets = text_bytes(column)
    data = LOWER[data]
    starts, ends, rows = words(data, offsets, NOT_ALNUM)
    n_words = np.diff(rows)
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), n_words
    # Words and what lies between them take turns.
    bounds = np.empty(2 * len(starts), np.int64)
    bounds[::2], bounds[1::2] = starts, ends
    turns = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(bounds), pa.py_buffer(data)]
    ).dictionary_encode()
    which = turns.indices.to_numpy()[::2]
    distinct = turns.dictionary.to_pylist()
    alone = np.array([zlib.crc32(w) for w in distinct], np.uint32)
    spaced = np.array([zlib.crc32(b" ", zlib.crc32(w)) for w in distinct], np.uint32)
    word, before, size = alone[which], spaced[which], ends - starts
    text = np.repeat(np.arange(len(n_words)), n_words)
    crcs, of = [word], [text]
    lead, at = before, np.arange(len(word))  # runs with a space behind them, and where they begin
    for k in range(1, RUN):
        at = at[(at + k < len(text))]
        lead = lead[: len(at)]
        same = text[at] == text[at + k]
        at, lead = at[same], lead[same]
        crcs.append(followed(lead, size[at + k], word[at + k]))
        of.append(text[at])
        if k + 1 < RUN:
            lead = followed(lead, size[at + k] + 1, before[at + k])
    return (np.concatenate(crcs) % BUCKETS).astype(np.int64), np.concatenate(of), n_words


# --- counts of the corpus ----------------------------------------------------------


def totals(df: DataFrame, text: str) -> np.ndarray:
    """Features of all rows per bucket."""

    def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in slices(batches, "text"):
            total += np.bincount(features(filled(batch.column("text")))[0], minlength=BUCKETS)
        some = np.flatnonzero(total)
        yield pa.record_batch([pa.array(some), pa.array(total[some])], names=["bucket", "n"])

    found = df.select(F.col(text).alias("text")).mapInArrow(counted, "bucket bigint, n bigint")
    rows = found.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    total = np.zeros(BUCKETS, np.int64)
    total[rows["bucket"].to_numpy()] = rows["n"].to_numpy()
    return total


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """``floor(1000 ln((t+1)(S+n) / ((s+1)(T+n))))`` per bucket, in doubles."""
    all_s, all_t = float(source.sum() + BUCKETS), float(target.sum() + BUCKETS)
    return np.array(
        [math.floor(1000 * math.log((t + 1.0) * all_s / ((s + 1.0) * all_t))) for s, t in zip(source, target, strict=True)],
        np.int64,
    )


# --- weights by planes of bits -----------------------------------------------------


def planes(values: np.ndarray) -> list[np.ndarray]:
    """Bits of whole numbers in rows of buckets: a plane of 64-bit words for each power of two."""
    out = []
    for bit in range(int(values.max(initial=0)).bit_length()):
        packed = np.packbits((values >> bit) & 1 != 0, axis=-1)
        wide = np.zeros((*packed.shape[:-1], _BYTES), np.uint8)
        wide[..., : packed.shape[-1]] = packed
        out.append(wide.view(np.uint64))
    return out


def weights(bucket: np.ndarray, text: np.ndarray, n: int, gain: np.ndarray) -> np.ndarray:
    """Sums of the gains of each text's features."""
    signed = [(1, plane, k) for k, plane in enumerate(planes(np.maximum(gain, 0)))]
    signed += [(-1, plane, k) for k, plane in enumerate(planes(np.maximum(-gain, 0)))]
    order = np.argsort(text, kind="stable")
    bucket, text = bucket[order], text[order]
    out = np.zeros(n, np.int64)
    for first in range(0, n, PLANED):
        some = min(PLANED, n - first)
        lo, hi = np.searchsorted(text, (first, first + some))
        cell = (text[lo:hi] - first) * BUCKETS + bucket[lo:hi]
        counts = np.bincount(cell, minlength=some * BUCKETS).reshape(some, BUCKETS)
        for i, plane in enumerate(planes(counts)):
            for sign, mask, k in signed:
                shared = np.bitwise_count(plane & mask).sum(axis=1, dtype=np.int64)
                out[first : first + some] += sign * (shared << (i + k))
    return out


def gumbel(doc_id: int | None, seed: int) -> int:
    """A document's Gumbel number in thousandths, from its id."""
    text = f"{seed}:{'' if doc_id is None else doc_id}"
    h = int(hashlib.sha256(text.encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


# --- draw --------------------------------------------------------------------------


def draw(
    docs: DataFrame,
    target: DataFrame,
    share: int = 5,
    seed: int = 42,
    doc_id: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
) -> DataFrame:
    """Of every row ``n_features``, ``weight``, ``score``, and the ``rank`` of those drawn.

    ``share`` hundredths of the rows with enough words are drawn, greatest scores first.
    """
    spark = docs.sparkSession
    gain = gains(totals(docs, text), totals(target, target_text))

    def weighed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            bucket, of, n_words = features(filled(batch.column("text")))
            n = batch.num_rows
            weight = weights(bucket, of, n, gain)
            number = np.array([gumbel(i, seed) for i in batch.column("doc_id").to_pylist()], np.int64)
            yield pa.record_batch(
                [
                    batch.column("doc_id"),
                    pa.array(np.bincount(of, minlength=n).astype(np.int64)),
                    pa.array(weight),
                    pa.array(weight + number),
                    pa.array(n_words >= LEAST),
                ],
                names=["doc_id", "n_features", "weight", "score", "eligible"],
            )

    schema = "doc_id bigint, n_features bigint, weight bigint, score bigint"
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    # Of rows alike in all columns any order is right; their place in the table splits them.
    scored = saved(rows.mapInArrow(weighed, f"{schema}, eligible boolean"), "weighed").withColumn(
        "place", F.monotonically_increasing_id()
    )
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("place")]

    def numbered(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), 0
        for batch in batches:
            nth = np.arange(seen, seen + batch.num_rows)
            seen += batch.num_rows
            yield pa.record_batch(
                [*(batch.column(c) for c in names), pa.array(np.full(len(nth), part), pa.int32()), pa.array(nth)],
                names=[*names, "part", "nth"],
            )

    names = ["doc_id", "n_features", "weight", "score"]
    eligible = scored.where("eligible").repartitionByRange(parts, *order).sortWithinPartitions(*order)
    ranked = saved(eligible.mapInArrow(numbered, f"{schema}, part int, nth bigint"), "ranked")
    per_part = ranked.groupBy("part").agg(F.count(F.lit(1)).alias("n")).toArrow().to_pandas()
    per_part = per_part.sort_values("part")  # one row per range
    before = {int(p): int(n) for p, n in zip(per_part["part"], per_part["n"].cumsum() - per_part["n"], strict=True)}
    drawn = share * int(per_part["n"].sum()) // 100

    def placed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            start = np.array([before[p] for p in batch.column("part").to_pylist()], np.int64)
            rank = start + batch.column("nth").to_numpy() + 1
            yield pa.record_batch(
                [*(batch.column(c) for c in names), pa.array(rank, mask=rank > drawn)], names=[*names, "rank"]
            )

    short = scored.where("not eligible").select(*names, F.lit(None).cast("long").alias("rank"))
    return ranked.mapInArrow(placed, f"{schema}, rank bigint").unionByName(short)
