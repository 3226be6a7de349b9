"""Pack documents into training sequences by cutting-stock column generation.

Texts are tokenized whole, long documents are cut into full sequences and a
rest, and the rests are the stock items. Spark counts their lengths; the
histogram, of at most ``sequence`` lengths, goes to the driver. Lengths are
rounded up to classes of ``step`` tokens. A linear program covers the histogram
with patterns of classes; dynamic programming over the sequence's length (an
unbounded knapsack) finds the pattern worth most at the program's prices, until
none is worth more than a sequence. Whole parts of the solution are taken as
they are, and the few items left are filled in largest first. Spark then ranks
the rests of each class, and a rank falls into a pattern, a sequence and a place.

Null text counts as empty: a document of the end id alone. Repeated rows are
documents of their own. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import saved, slices
from .tokens import ENCODE_BYTES, encode

SEQUENCE = 4096
STEP = 16
#: Patterns priced at most; the program's solution so far covers everything anyhow.
ROUNDS = 3000
#: Worth of the best pattern beyond a sequence that is let be. The solution is
#: then at most so much above the program's optimum, as a share of it.
TOLERANCE = 1e-4


def best_pattern(price: np.ndarray, capacity: int) -> np.ndarray:
    """How many of each class to put into ``capacity`` units for the greatest total price.

    Class ``c`` takes ``c + 1`` units.
    """
    best = np.zeros(capacity + 1)
    choice = np.full(capacity + 1, -1)
    for room in range(1, capacity + 1):
        worth = price[:room] + best[room - 1 :: -1][: len(price[:room])]
        c = int(np.argmax(worth)) if len(worth) else -1
        best[room], choice[room] = best[room - 1], -1
        if c >= 0 and worth[c] > best[room]:
            best[room], choice[room] = worth[c], c
    pattern = np.zeros(len(price), np.int64)
    room = capacity
    while room > 0:
        if (c := choice[room]) < 0:
            room -= 1
        else:
            pattern[c] += 1
            room -= c + 1
    return pattern


def solve(demand: np.ndarray, capacity: int, rounds: int = ROUNDS) -> list[tuple[int, np.ndarray]]:
    """Patterns and how often to use each, covering ``demand`` items of each class exactly."""
    used = np.flatnonzero(demand)
    if not len(used):
        return []
    need = demand[used].astype(float)
    basis = np.diag((capacity // (used + 1)).astype(float))
    inverse = np.diag(1 / np.diag(basis))
    amount = inverse @ need
    for k in range(rounds):
        price = np.zeros(len(demand))
        price[used] = np.maximum(inverse.sum(axis=0), 0)
        column = best_pattern(price, capacity)[used].astype(float)
        if price[used] @ column <= 1 + TOLERANCE:
            break
        step = inverse @ column
        rows = np.flatnonzero(step > 1e-9)
        leaving = rows[np.argmin(amount[rows] / step[rows])]
        basis[:, leaving] = column
        turn = inverse[leaving] / step[leaving]
        inverse -= np.outer(step, turn)
        inverse[leaving] = turn
        if k % 50 == 49:
            inverse = np.linalg.inv(basis)
        amount = np.maximum(inverse @ need, 0)
    plan, left = [], demand.astype(np.int64).copy()
    for times, column in zip(amount, basis.T, strict=True):
        pattern = np.zeros(len(demand), np.int64)
        pattern[used] = np.rint(column).astype(np.int64)
        has = pattern > 0
        whole = min(int(times + 1e-6), int((left[has] // pattern[has]).min()))
        if whole > 0:
            plan.append((whole, pattern))
            left -= whole * pattern
    while left.any():
        pattern, room = np.zeros(len(demand), np.int64), capacity
        for c in np.flatnonzero(left)[::-1]:
            pattern[c] = min(left[c], room // (c + 1))
            room -= pattern[c] * (c + 1)
        has = pattern > 0
        whole = int((left[has] // pattern[has]).min())
        plan.append((whole, pattern))
        left -= whole * pattern
    return plan


def placed(plan: list[tuple[int, np.ndarray]], classes: int) -> list[tuple[np.ndarray, ...]]:
    """For each class the plan by rank: where a pattern's ranks begin, its first
    sequence, its items of the class in a sequence, and the place of the first."""
    rows: list[list[tuple[int, int, int, int]]] = [[] for _ in range(classes)]
    rank, sequence = np.zeros(classes, np.int64), 0
    for times, pattern in plan:
        place = 0
        for c in np.flatnonzero(pattern)[::-1]:
            rows[c].append((rank[c], sequence, pattern[c], place))
            rank[c] += times * pattern[c]
            place += pattern[c]
        sequence += times
    return [tuple(np.array(r, np.int64).reshape(-1, 4).T) for r in rows]


def pieces(
    docs: DataFrame,
    path: str,
    end_id: int,
    sequence: int = SEQUENCE,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Documents cut into pieces of at most ``sequence`` ids.

    ``doc_id, start, length, ids_crc32`` (of the ids as little-endian unsigned
    32-bit integers) and ``doc_tokens``; the end id is counted.
    """

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", ENCODE_BYTES):
            ids, offsets = encode(batch.column("text"), path, end_id)
            long = np.diff(offsets)
            n = -(-long // sequence)
            row = np.repeat(np.arange(len(n)), n)
            start = (np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)) * sequence
            size = np.minimum(sequence, long[row] - start)
            raw = memoryview(ids.astype("<u4")).cast("B")
            first = offsets[row] + start
            sums = [
                zlib.crc32(raw[4 * a : 4 * (a + b)]) for a, b in zip(first, size, strict=True)
            ]
            yield pa.record_batch(
                [
                    batch.column("doc_id").take(pa.array(row)),
                    *(pa.array(x, pa.int64()) for x in (start, size, sums, long[row])),
                ],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"],
            )

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        cut, "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"
    )


def pack(
    docs: DataFrame,
    path: str,
    end_id: int,
    sequence: int = SEQUENCE,
    step: int = STEP,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """The pieces of all documents with ``sequence_id`` and ``offset``, without gaps."""
    spark = docs.sparkSession
    classes = -(-sequence // step)
    cut = saved(pieces(docs, path, end_id, sequence, doc_id, text), "pieces")
    kind = F.ceil(F.col("length") / F.lit(step)).cast("int") - 1
    histogram = cut.groupBy(kind.alias("kind")).agg(F.count(F.lit(1)).alias("n")).toArrow().to_pandas()
    demand = np.zeros(classes, np.int64)
    demand[histogram["kind"].to_numpy(int)] = histogram["n"].to_numpy()
    plan = placed(solve(demand, sequence // step), classes)

    # Ranks within a class: a running number per range of the order, then the
    # numbers of the ranges before. Ranges follow the order, so all of them
    # together hold hardly more (range, class) pairs than there are ranges.
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = ["kind", "doc_id", "start", "ids_crc32"]

    def numbered(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), np.zeros(classes, np.int64)
        for batch in batches:
            kinds = batch.column("kind").to_numpy()
            # sorted by class: a run per class
            first = np.searchsorted(kinds, kinds)
            rank = np.arange(len(kinds)) - first + seen[kinds]
            seen += np.bincount(kinds, minlength=classes)
            yield pa.record_batch(
                [*batch.columns, pa.array(np.full(len(kinds), part), pa.int32()), pa.array(rank)],
                names=[*batch.schema.names, "part", "nth"],
            )

    ordered = cut.withColumn("kind", kind).repartitionByRange(parts, *order).sortWithinPartitions(*order)
    schema = (
        "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
        "kind int, part int, nth bigint"
    )
    ranked = saved(ordered.mapInArrow(numbered, schema), "ranked")
    counts = ranked.groupBy("kind", "part").agg(F.count(F.lit(1)).alias("n")).toArrow().to_pandas()
    counts = counts.sort_values(["kind", "part"])
    counts["before"] = counts.groupby("kind")["n"].cumsum() - counts["n"]
    before = dict(zip(zip(counts["kind"], counts["part"], strict=True), counts["before"], strict=True))

    def assigned(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds = batch.column("kind").to_numpy()
            parts_of = batch.column("part").to_numpy()
            nth = batch.column("nth").to_numpy()
            sequence_id, place = np.zeros(len(nth), np.int64), np.zeros(len(nth), np.int64)
            for c, p in {*zip(kinds.tolist(), parts_of.tolist(), strict=True)}:
                rows = np.flatnonzero((kinds == c) & (parts_of == p))
                rank = nth[rows] + before[c, p]
                begins, first, each, slot = plan[c]
                k = np.searchsorted(begins, rank, "right") - 1
                sequence_id[rows] = first[k] + (rank - begins[k]) // each[k]
                place[rows] = slot[k] + (rank - begins[k]) % each[k]
            keep = [batch.column(n) for n in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")]
            yield pa.record_batch(
                [*keep, pa.array(sequence_id), pa.array(place)],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "place"],
            )

    rows = ranked.mapInArrow(
        assigned,
        "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
        "sequence_id bigint, place bigint",
    )
    # A sequence has at most as many pieces as tokens: a bounded window.
    before_it = Window.partitionBy("sequence_id").orderBy("place").rowsBetween(
        Window.unboundedPreceding, -1
    )
    return rows.withColumn(
        "offset", F.coalesce(F.sum("length").over(before_it), F.lit(0).cast("long"))
    ).drop("place")
