"""Approximate nearest neighbours by inner product in a hash-prefix forest.

A tree gives every vector a string of ``BITS`` signs of random projections and
keeps the strings in a sorted array. A query finds in every tree the vectors
with the longest common prefix with its own string, and then ascends in all
trees together: one bit less of prefix, more candidates, until it has enough.
Only the candidates' inner products are computed, in double precision and each
by itself, so equal vectors have equal scores.

The strings are made once and written with their vectors, dealt evenly to shards of at
most ``SHARD`` rows, or fewer rows where that leaves tasks idle. A shard and a slice of at
most ``SLICE`` queries meet in a cell, which is one task's work: it sorts the shard's strings
into the trees, then reads the queries batch by batch. So no task holds more than a shard and a
batch, nothing is collected or broadcast but the sample below, and a lost task is run again
from the written strings. Shipping costs a query once per shard and a shard once per
slice; only the best of a cell are shuffled on. Queries are the stated set: every ``EVERY``-th id.

The least number of candidates, as a share of a shard, is measured on a bounded sample of
queries against brute force, so that ``RECALL`` is reached on that sample. Vectors without near
neighbours need a large share, in the extreme the trees' roots, which are all rows.

Vectors take one more component, which lifts them all to the greatest norm, so
that inner products order like angles. Vectors that are null, zero, of another
length than the most common one, or hold null or non-finite components take no part.
Repeated vectors are candidates each, and so are rows with a repeated id; of those
the least vector is the query, and a query's own id is never its neighbour. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import saved

EVERY = 20
TOP = 20
TREES = 48
BITS = 24
#: Rows of a shard, and queries that meet it in one task.
SHARD = 200_000
SLICE = 20_000
#: Shards are made smaller than that to give every task some rows, but not smaller than this.
LEAST = 4_000
#: Recall aimed at on the sample, which is a little more than has to be reached.
RECALL = 0.95
SAMPLE = 100


def valid(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """``vec_id, v`` of the usable vectors, all of one length."""
    v = F.col("v")
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("v"))
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = rows.where(F.col("vec_id").isNotNull() & v.isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(v, lambda x: x != 0))
    sizes = rows.groupBy(F.size("v").alias("size")).agg(F.count(F.lit(1)).alias("n"))
    most = sizes.orderBy(F.col("n").desc(), "size").first()
    return rows.where(F.size("v") == (most["size"] if most else 0))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _projections(size: int, trees: int, bits: int) -> np.ndarray:
    return np.random.default_rng(20240229).standard_normal((size, trees * bits))


def _strings(x: np.ndarray, trees: int, bits: int) -> np.ndarray:
    """Each row's string in each tree, as a number that sorts like it."""
    signs = (x @ _projections(x.shape[1], trees, bits) > 0).reshape(len(x), trees, bits)
    return signs @ (1 << np.arange(bits - 1, -1, -1))


def _lifted(x: np.ndarray, norm: float) -> np.ndarray:
    rest = np.sqrt(np.maximum(norm * norm - (x * x).sum(axis=1), 0))
    return np.column_stack([x, rest])


def forest(string: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per tree the rows in the order of their strings, and the sorted strings."""
    order = np.argsort(string, axis=0, kind="stable").T
    return order, np.take_along_axis(string.T, order, axis=1)


def _run(array: np.ndarray, string: np.ndarray, length: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the entries with the first ``length`` bits of ``string`` begin and end in a sorted array."""
    low = string >> (bits - length) << (bits - length)
    return np.searchsorted(array, low), np.searchsorted(array, low + (1 << (bits - length)))


def _level(arrays: np.ndarray, queries: np.ndarray, enough: float, bits: int) -> np.ndarray:
    """Per query the prefix length at which the ascent has seen ``enough`` entries in all trees together."""
    level = np.zeros(len(queries), np.int64)
    open_ = np.arange(len(queries))
    for length in range(bits, 0, -1):
        total = np.zeros(len(open_))
        for t, array in enumerate(arrays):
            low, high = _run(array, queries[open_, t], np.int64(length), bits)
            total += high - low
        full = total >= enough
        level[open_[full]] = length
        open_ = open_[~full]
        if not len(open_):
            break
    return level


def seen_by(
    trees: tuple[np.ndarray, np.ndarray], queries: np.ndarray, enough: float, bits: int = BITS
) -> Iterator[np.ndarray]:
    """Per query a mask of the shard's rows that it sees: those with the level's prefix in any tree."""
    order, arrays = trees
    level = _level(arrays, queries, enough, bits)
    runs = [_run(array, queries[:, t], level, bits) for t, array in enumerate(arrays)]
    for q in range(len(queries)):
        seen = np.full(order.shape[1], level[q] == 0)
        if level[q]:
            for rows, (low, high) in zip(order, runs):
                seen[rows[low[q] : high[q]]] = True
        yield seen


def candidates(string: np.ndarray, queries: np.ndarray, enough: float, bits: int = BITS) -> np.ndarray:
    """Which of the rows with these strings each query sees."""
    seen = list(seen_by(forest(string), queries, enough, bits))
    return np.array(seen).reshape(len(queries), len(string))


def _best(score: np.ndarray, ids: np.ndarray, top: int) -> np.ndarray:
    """The places of the best scores, best first, equal ones by id."""
    kept = np.arange(len(score))
    if len(score) > top:
        # everything down to the last place's score, ties included
        kept = np.flatnonzero(score >= -np.partition(-score, top - 1)[top - 1])
    return kept[np.lexsort((ids[kept], -score[kept]))][:top]


def _scores(x: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Inner products, each added up in the same order whatever rows lie beside it."""
    return (v * x).sum(axis=1)


def _hashed(rows: DataFrame, lift: float | None, trees: int, bits: int) -> DataFrame:
    """``rows`` and their strings, which are one column of 4-byte numbers; ``lift`` is the norm to lift to.

    Queries keep their direction only: their lifted component is zero.
    """

    def hashed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                v = _matrix(batch.column("v"))
                full = _lifted(v, lift) if lift is not None else np.column_stack([v, np.zeros(len(v))])
                made = _strings(full, trees, bits).astype("<u4")
                yield batch.append_column("strings", pa.array([row.tobytes() for row in made], pa.binary()))

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(hashed, f"{schema}, strings binary")


def _unpacked(column: pa.Array, trees: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u4").astype(np.int64).reshape(-1, trees)


def calibrated(index: DataFrame, queries: DataFrame, top: int, trees: int, bits: int) -> float:
    """Share of a shard's entries a query must see for ``RECALL`` on a sample of queries.

    A neighbour is seen unless the ascent ends above its common prefix with the query, so the
    entries one bit further down must not be enough.
    """
    chosen = queries.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).toArrow().combine_chunks()
    if not chosen.num_rows:
        return 1.0
    ids, x = chosen["vec_id"].to_numpy(), _matrix(chosen["v"].combine_chunks())
    strings = _unpacked(chosen["strings"], trees)

    def needed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            own, v, string = batch.column("vec_id").to_numpy(), _matrix(batch.column("v")), _unpacked(batch.column("strings"), trees)
            arrays = forest(string)[1]
            for q in range(len(ids)):
                others = np.flatnonzero(own != ids[q])
                score = _scores(x[q], v[others])
                best = _best(score, own[others], top)
                c = others[best]
                differ = strings[q] ^ string[c]
                common = np.where(differ > 0, bits - 1 - np.floor(np.log2(np.maximum(differ, 1))), bits).max(axis=1)
                below = np.minimum(common.astype(np.int64) + 1, bits)
                size = np.zeros(len(c))
                for t, array in enumerate(arrays):
                    low, high = _run(array, np.repeat(strings[q, t], len(c)), below, bits)
                    size += high - low
                size[common == bits] = 0
                yield pa.record_batch(
                    [pa.array(np.full(len(c), q)), pa.array(score[best]), pa.array(own[c]), pa.array(size / len(own))],
                    names=["q", "score", "vec_id", "share"],
                )

    found = index.mapInArrow(needed, "q bigint, score double, vec_id bigint, share double")
    rank = F.row_number().over(Window.partitionBy("q").orderBy(F.col("score").desc(), "vec_id"))
    share = found.withColumn("rank", rank).where(F.col("rank") <= top).select("share").toArrow()["share"].to_numpy()
    return float(np.quantile(share, RECALL)) * 1.1 if len(share) else 1.0


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[int, bool, pa.RecordBatch]]:
    """A batch cut where the cell changes, or its rows end and its queries begin."""
    cell = batch.column("cell").to_numpy()
    query = batch.column("query").to_numpy(zero_copy_only=False)
    edges = np.flatnonzero((cell[1:] != cell[:-1]) | (query[1:] != query[:-1])) + 1
    for a, b in zip([0, *edges], [*edges, len(cell)]):
        yield int(cell[a]), bool(query[a]), batch.slice(a, b - a)


def search(
    vectors: DataFrame,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    every: int = EVERY,
    top: int = TOP,
    trees: int = TREES,
    bits: int = BITS,
    shard: int = SHARD,
    slice_: int = SLICE,
) -> DataFrame:
    """``query_id, rank, vec_id, score`` of each query's ``top`` nearest found."""
    spark = vectors.sparkSession
    rows = valid(vectors, vec_id, embedding)
    asked = F.pmod("vec_id", F.lit(every)) == 0
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    size = rows.select(F.max(square).alias("square"), F.count(F.lit(1)).alias("n"), F.count_if(asked).alias("asked")).first()
    if not size["n"]:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shards = max(-(-size["n"] // shard), min(tasks, -(-size["n"] // LEAST)))
    slices = max(1, -(-size["asked"] // slice_))
    dealt = rows.repartition(shards).withColumn("shard", F.spark_partition_id())
    index = saved(_hashed(dealt, float(np.sqrt(size["square"])), trees, bits), "forest")
    least = rows.where(asked).groupBy("vec_id").agg(F.min("v").alias("v"))
    queries = saved(_hashed(least, None, trees, bits), "queries")
    share = calibrated(index, queries, top, trees, bits)

    def in_cells(df: DataFrame, query: bool, shard_: str, slice_: str) -> DataFrame:
        cell = F.expr(f"{shard_} * {slices} + {slice_}").cast("int")
        return df.select(cell.alias("cell"), F.lit(query).alias("query"), "vec_id", "v", "strings")

    every_slice = index.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))
    of_slice = F.pmod(F.xxhash64("vec_id"), F.lit(slices))
    every_shard = queries.withColumn("slice", of_slice).withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    cells = in_cells(every_slice, False, "shard", "slice").unionByName(in_cells(every_shard, True, "shard", "slice"))
    cells = cells.repartitionById(shards * slices, F.col("cell")).sortWithinPartitions("cell", "query")

    def probe(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, parts, built = None, [], None
        for batch in batches:
            for cell, query, some in _runs(batch) if batch.num_rows else ():
                if cell != at:
                    at, parts, built = cell, [], None
                if not query:
                    parts.append(some)
                    continue
                if parts:  # the shard is whole
                    own = np.concatenate([p.column("vec_id").to_numpy() for p in parts])
                    v = np.concatenate([_matrix(p.column("v")) for p in parts])
                    built = forest(np.concatenate([_unpacked(p.column("strings"), trees) for p in parts]))
                    parts = []
                if built is None:
                    continue
                ids, x = some.column("vec_id").to_numpy(), _matrix(some.column("v"))
                found = [[], [], []]
                for q, seen in enumerate(seen_by(built, _unpacked(some.column("strings"), trees), share * len(own), bits)):
                    c = np.flatnonzero(seen)
                    c = c[own[c] != ids[q]]
                    score = _scores(x[q], v[c])
                    best = _best(score, own[c], top)
                    for column, values in zip(found, (np.full(len(best), ids[q]), own[c[best]], score[best])):
                        column.append(values)
                yield pa.record_batch([pa.array(np.concatenate(column)) for column in found], names=["query_id", "vec_id", "score"])

    found = cells.mapInArrow(probe, "query_id bigint, vec_id bigint, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")
