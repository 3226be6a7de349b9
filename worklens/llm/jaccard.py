"""Jaccard similarity join of documents by chosen paths.

A document is the set of its word five-grams. A tree splits the sets: a node
chooses coordinates of a MinHash signature, that is shared random orders of all
tokens, and sends each set to the child named by the token that comes first in
the order. The choice depends on the node alone, so two similar sets often take
a common path. A node of at most ``LIMIT`` sets is a bucket, where all pairs are
compared; larger nodes split again, and at ``DEPTH`` they are compared in
blocks. Independent trees are grown until a pair at the threshold meets with
probability ``RECALL``; nearer pairs meet more surely still.

Sets are compared once: documents with equal sets are one vertex with a count. In a
bucket, sketches of the signatures drop pairs far below the threshold; the
others are compared exactly. A pair belongs to the least of the buckets both share,
so no pair is counted twice and none is written out: a bucket gives a row per
set, with its links and the least set it is joined to there.

Words are lower-cased and separated by white space; a text of fewer than five
words is the one n-gram of all its words. Texts without words, null ones
included, are copies of each other. Rows with the same id and text are links of
each other like other copies. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import drop, filled, lists, mixed, saved, signed, slices, text_bytes, word_hashes, words

WIDTH = 5
THRESHOLD = 0.8
RECALL = 0.9999
#: Sets in a bucket or block, and levels of a tree.
LIMIT = 1000
DEPTH = 3
#: Coordinates of a signature; a sketch keeps a byte of each.
COORDINATES = 64
#: Equal bytes of two sketches that let a pair be compared. At similarity 0.8 a
#: sketch falls short with a probability of about one in a million.
ALIKE = 36
_PAIRS = 40_000


# --- sets, signatures and paths ---------------------------------------------------


def shingles(column: pa.Array, width: int = WIDTH) -> list[np.ndarray]:
    """The sorted distinct n-gram hashes of each row, of a few megabytes of text at a time."""
    batch = pa.record_batch([column], names=["text"])
    return [s for part in slices([batch], "text") for s in _shingles(part.column("text"), width)]


def _shingles(column: pa.Array, width: int) -> list[np.ndarray]:
    data, offsets = text_bytes(pc.utf8_lower(filled(column)))
    starts, ends, at = words(data, offsets)
    h = word_hashes(data, starts, ends)
    grams = np.zeros(len(h), np.uint64)
    for k in range(width):
        grams[: max(len(h) - k, 0)] += h[k:] * np.uint64(2 * (7919 * k + 104729) + 1)
    grams = mixed(grams)
    sets = []
    for a, b in zip(at[:-1], at[1:], strict=True):
        if b - a >= width:
            sets.append(np.unique(grams[a : b - width + 1]))
        else:
            whole = hashlib.blake2b(h[a:b].tobytes(), digest_size=8).digest()
            sets.append(np.frombuffer(whole if b > a else b"", np.uint64))
    return sets


_ORDERS = mixed(np.arange(1, 2 * COORDINATES + 1, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))


def signature(tokens: np.ndarray) -> np.ndarray:
    """For each order of all tokens the hash of the set's first."""
    if not len(tokens):
        return np.zeros(COORDINATES, np.uint32)
    # multiply-shift orders of mixed hashes; the high half is compared
    high = (tokens * (_ORDERS[:COORDINATES, None] | np.uint64(1)) + _ORDERS[COORDINATES:, None]) >> np.uint64(32)
    return high.min(axis=1).astype(np.uint32)


def survival(depth: int, similarity: float) -> float:
    """Probability that two sets share a node at ``depth``, for the choices made here."""
    p = 1.0
    for _ in range(depth):
        s = similarity * p
        p = 0.75 * s + 0.25 * (1 - (1 - s) ** 2)
    return p


def runs_for(recall: float, depth: int = DEPTH, similarity: float = THRESHOLD) -> int:
    return math.ceil(math.log(1 - recall) / math.log(1 - survival(depth, similarity)))


def _names(node: np.ndarray, coordinate: np.ndarray, token: np.ndarray) -> np.ndarray:
    return mixed(
        mixed(node + (coordinate + np.uint64(1)) * np.uint64(0xE7037ED1A0B428DB)) + token.astype(np.uint64)
    )


def roots(runs: int) -> list[tuple[int, int]]:
    """Tree and coordinate of every choice at the roots: one, and in every fourth tree two.

    Trees take different coordinates as long as there are any.
    """
    chosen = [r for r in range(runs) for _ in range(1 + (r % 4 == 0))]
    return [(r, k % COORDINATES) for k, r in enumerate(chosen)]


def _matrix(column: pa.Array, kind, width: int) -> np.ndarray:
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    first = np.frombuffer(offsets, np.int64)[column.offset] if len(column) else 0
    if not len(column):
        return np.zeros((0, width), kind)
    size = np.dtype(kind).itemsize * width * len(column)
    return np.frombuffer(data, np.uint8)[first : first + size].view(kind).reshape(-1, width)


def row_key(doc_id: Column, text: Column) -> Column:
    """16 bytes that equal rows share."""
    return F.unhex(F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("?")), F.lit(":"), F.coalesce(text, F.lit("")))))


def described(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``doc_id, key, vertex`` (digest of the set), ``size`` and ``signature``; written."""

    def describe(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            sets = shingles(batch.column("text"))
            yield pa.record_batch(
                [
                    batch.column("doc_id"),
                    batch.column("key"),
                    pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                    pa.array([len(s) for s in sets], pa.int32()),
                    pa.array([signature(s).tobytes() for s in sets], pa.binary()),
                ],
                names=["doc_id", "key", "vertex", "size", "signature"],
            )

    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), row_key(F.col(doc_id), F.col(text)).alias("key"), F.col(text).alias("text")
    )
    return saved(
        rows.mapInArrow(describe, "doc_id bigint, key binary, vertex binary, size int, signature binary"), "jaccard-rows"
    )


def vertices(rows: DataFrame) -> DataFrame:
    """One row per distinct set: how many rows have it, the first of them, and the signature."""
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "key")
    return saved(
        rows.groupBy("vertex").agg(
            F.count(F.lit(1)).alias("copies"),
            F.min(order).alias("lead"),
            F.first("size").alias("size"),
            F.first("signature").alias("signature"),
        ),
        "jaccard-vertices",
    )


def leaves(sets: DataFrame, runs: int, limit: int, depth: int) -> DataFrame:
    """``node, members, vertex`` for all buckets with two sets or more; written.

    One round per level. Only nodes larger than ``limit`` go on, so the rounds
    after the first handle few rows. Counts are combined before their shuffle and joined
    back between plain shuffles, so Spark can split a node that many sets share.
    """
    first = roots(runs)
    tree = mixed(np.array([r for r, _ in first], np.uint64) + np.uint64(0x1D8E4E27C47D124F))
    coordinate = np.array([c for _, c in first], np.uint64)

    def start(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens = _matrix(batch.column("signature"), np.uint32, COORDINATES)[:, coordinate.astype(int)]
            node = _names(tree[None, :], coordinate[None, :], tokens)
            yield pa.record_batch(
                [
                    pa.array(signed(node.reshape(-1))),
                    batch.column("vertex").take(pa.array(np.repeat(np.arange(len(node)), len(first)))),
                ],
                names=["node", "vertex"],
            )

    def split(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node = batch.column("node").to_numpy().view(np.uint64)
            tokens = _matrix(batch.column("signature"), np.uint32, COORDINATES)
            index = np.arange(len(node))
            one = mixed(node + np.uint64(1)) % np.uint64(COORDINATES)
            two = mixed(node + np.uint64(2)) % np.uint64(COORDINATES)
            second = np.flatnonzero((mixed(node + np.uint64(3)) % np.uint64(4) == 0) & (one != two))
            who = np.concatenate([index, second])
            which = np.concatenate([one, two[second]])
            child = _names(node[who], which, tokens[who, which.astype(int)])
            yield pa.record_batch(
                [pa.array(signed(child)), batch.column("vertex").take(pa.array(who))], names=["node", "vertex"]
            )

    rows = sets.where(F.col("size") > 0).select("vertex", "signature").mapInArrow(start, "node bigint, vertex binary")
    levels, above = [], None
    for level in range(1, depth + 1):
        rows = rows if level == 1 else saved(rows, "jaccard-level", keep=False)
        counts = saved(
            rows.groupBy("node").agg(F.count(F.lit(1)).alias("members")).where(F.col("members") > 1), "jaccard-counts", keep=False
        )
        both = rows.join(counts, "node")
        if level == depth:
            levels.append(saved(both, "jaccard-leaves", keep=False))
            drop(counts)
            break
        levels.append(saved(both.where(F.col("members") <= limit), "jaccard-leaves", keep=False))
        large = saved(both.where(F.col("members") > limit).select("node", "vertex"), "jaccard-large", keep=False)
        drop(counts)
        if above is not None:
            drop(above)
        above = large
        if large.isEmpty():
            break
        rows = large.join(sets.select("vertex", "signature"), "vertex").mapInArrow(split, "node bigint, vertex binary")
    if above is not None:
        drop(above)
    result = levels[0]
    for more in levels[1:]:
        result = result.unionByName(more)
    result._worklens_levels = levels
    return result


# --- buckets ----------------------------------------------------------------------


def _by_bucket(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows sorted by bucket as tables that hold whole buckets, of a batch's size about."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        names = batch.column("bucket").to_numpy(zero_copy_only=False)
        if not len(names) or names[0] == names[-1]:
            continue
        cut = int(np.searchsorted(names, names[-1], "left"))
        yield pa.Table.from_batches([*held[:-1], batch.slice(0, cut)]).combine_chunks()
        held = [batch.slice(cut)]
    if held and sum(b.num_rows for b in held):
        yield pa.Table.from_batches(held).combine_chunks()


def _column(table: pa.Table, name: str) -> pa.Array:
    column = table.column(name)
    return column.chunk(0) if column.num_chunks == 1 else column.combine_chunks()


def _owned_pairs(table: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of a bucket whose sketches are alike and whose least common bucket it is.

    In a bucket of two blocks only pairs across them count.
    """
    bucket = _column(table, "bucket").to_numpy()
    node = _column(table, "node").to_numpy()
    side = _column(table, "side").to_numpy()
    pair = _column(table, "across").to_numpy(zero_copy_only=False)
    sketch = _matrix(_column(table, "sketch"), np.uint8, COORDINATES)
    vertex = _matrix(_column(table, "vertex"), np.uint64, 2)
    paths = _column(table, "paths")
    at = paths.offsets.to_numpy().astype(np.int64)
    flat = paths.flatten().to_numpy()
    at = at - at[0]
    wide = int(np.diff(at).max(initial=0))
    table_of = np.full((len(bucket), wide), np.iinfo(np.int64).max)
    rows = np.repeat(np.arange(len(bucket)), np.diff(at))
    table_of[rows, np.arange(len(flat)) - at[:-1][rows]] = flat
    last = np.searchsorted(bucket, bucket, "right")
    step = max(1, _PAIRS * 16 // max(1, wide * wide))
    far = 1
    alive = np.flatnonzero(last - np.arange(len(bucket)) > far)
    while len(alive):
        a, b = alive, alive + far
        meet = (~pair[a] | (side[a] != side[b])) & (vertex[a] != vertex[b]).any(axis=1)
        a, b = a[meet], b[meet]
        for k in range(0, len(a), _PAIRS):
            x, y = a[k : k + _PAIRS], b[k : k + _PAIRS]
            near = (sketch[x] == sketch[y]).sum(axis=1) >= ALIKE
            x, y = x[near], y[near]
            for m in range(0, len(x), step):
                u, v = x[m : m + step], y[m : m + step]
                earlier = table_of[u] < node[u][:, None]
                shared = (table_of[u][:, :, None] == table_of[v][:, None, :]).any(axis=2)
                own = ~(earlier & shared).any(axis=1)
                if own.any():
                    yield u[own], v[own]
        far += 1
        alive = alive[last[alive] - alive > far]


def _candidates(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows that have a pair to compare in their bucket."""
    for table in _by_bucket(batches):
        keep = np.zeros(table.num_rows, bool)
        for a, b in _owned_pairs(table):
            keep[a] = True
            keep[b] = True
        if keep.any():
            yield from table.filter(pa.array(keep)).combine_chunks().to_batches()


def _similar(sets: list[np.ndarray], a: np.ndarray, b: np.ndarray, threshold: float) -> np.ndarray:
    """Which of the pairs have at least the similarity, exactly."""
    size = np.array([len(s) for s in sets])
    members = np.unique(np.concatenate([a, b]))
    if len(a) <= 4 * len(members):
        common = np.array([len(np.intersect1d(sets[x], sets[y], assume_unique=True)) for x, y in zip(a, b, strict=True)])
    else:
        # many pairs among few sets: a product of 0/1 matrices over shared tokens
        place = np.full(len(sets), -1)
        place[members] = np.arange(len(members))
        owner = np.repeat(np.arange(len(members)), size[members])
        _, code, often = np.unique(np.concatenate([sets[m] for m in members]), return_inverse=True, return_counts=True)
        shared = often > 1
        column = np.cumsum(shared) - 1
        owner, column = owner[shared[code]], column[code[shared[code]]]
        by = np.argsort(column, kind="stable")
        owner, column = owner[by], column[by]
        product = np.zeros((len(members), len(members)), np.float32)
        for low in range(0, int(column[-1]) + 1 if len(column) else 0, 2048):
            x, y = np.searchsorted(column, [low, low + 2048])
            part = np.zeros((len(members), 2048), np.float32)
            part[owner[x:y], column[x:y] - low] = 1
            product += part @ part.T
        common = product[place[a], place[b]].astype(np.int64)
    return common >= threshold * (size[a] + size[b] - common) - 1e-9


def _verified(threshold: float):
    def verify(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _by_bucket(batches):
            bucket = _column(table, "bucket").to_numpy()
            names = _column(table, "vertex").to_pylist()
            copies = _column(table, "copies").to_numpy()
            sets = shingles(_column(table, "text"))
            edges = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
            pairs = list(_owned_pairs(table))
            if not pairs:
                continue
            a, b = (np.concatenate(x) for x in zip(*pairs, strict=True))
            of = np.searchsorted(edges, a, "right")
            order = np.argsort(of, kind="stable")
            a, b, of = a[order], b[order], of[order]
            good = np.zeros(len(a), bool)
            for k in np.unique(of):
                x, y = np.searchsorted(of, [k, k + 1])
                good[x:y] = _similar(sets, a[x:y], b[x:y], threshold)
            a, b = a[good], b[good]
            links = np.bincount(a, copies[b], len(bucket)) + np.bincount(b, copies[a], len(bucket))
            lead = _components(a, b, names)
            rows = np.flatnonzero(links)
            yield pa.record_batch(
                [
                    pa.array([names[r] for r in rows], pa.binary()),
                    pa.array(links[rows].astype(np.int64)),
                    pa.array([names[lead[r]] for r in rows], pa.binary()),
                ],
                names=["vertex", "links", "root"],
            )

    return verify


def _components(a: np.ndarray, b: np.ndarray, names: list[bytes]) -> np.ndarray:
    """For each row the row of the least name it is connected to, by pairs."""
    rank = np.zeros(len(names), np.int64)
    order = np.array(sorted(range(len(names)), key=names.__getitem__), np.int64)
    rank[order] = np.arange(len(names))
    label = rank.copy()
    while True:
        least = label.copy()
        np.minimum.at(least, a, label[b])
        np.minimum.at(least, b, label[a])
        least = least[order[least]]  # follow the label's own label
        if (least == label).all():
            return order[label]
        label = least


def _spread(members: DataFrame, sets: DataFrame, limit: int) -> DataFrame:
    """A row per set and bucket. Nodes above ``limit`` are cut in blocks, one bucket per two blocks."""
    blocks = F.ceil(F.col("x.members") / F.lit(limit)).cast("int")
    each = (
        members.groupBy("vertex")
        .agg(F.sort_array(F.collect_list(F.struct("node", "members"))).alias("all"))
        .join(sets.select("vertex", "copies", "lead", "signature"), "vertex")
        .mapInArrow(_sketched, "vertex binary, copies bigint, key binary, sketch binary, paths array<bigint>, members array<bigint>")
    )
    rows = each.withColumn("x", F.explode(F.arrays_zip("paths", "members"))).drop("members")
    block = F.pmod(F.xxhash64("vertex", "x.paths"), blocks).cast("int")
    rows = rows.select(
        "vertex", "copies", "key", "sketch", "paths",
        F.col("x.paths").alias("node"), block.alias("side"), blocks.alias("blocks"),
    )
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    return rows.withColumn("other", other).select(
        F.xxhash64("node", F.least("side", "other"), F.greatest("side", "other")).alias("bucket"),
        "node", "side", (F.col("side") != F.col("other")).alias("cross"), "blocks", "other",
        "vertex", "copies", "key", "sketch", "paths",
    ).select(
        "bucket", "node", "side", (F.col("cross")).alias("across"), "vertex", "copies", "key", "sketch", "paths"
    )


def _sketched(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        tokens = _matrix(batch.column("signature"), np.uint32, COORDINATES)
        sketch = np.ascontiguousarray(tokens.view(np.uint8).reshape(len(tokens), COORDINATES, 4)[:, :, 1])
        every = batch.column("all")
        flat = every.flatten()
        at = every.offsets.to_numpy().astype(np.int64)
        at = at - at[0]
        yield pa.record_batch(
            [
                batch.column("vertex"),
                batch.column("copies"),
                batch.column("lead").field("key"),
                pa.array([s.tobytes() for s in sketch], pa.binary()),
                lists(flat.field("node").to_numpy(), at, pa.int64()),
                lists(flat.field("members").to_numpy(), at, pa.int64()),
            ],
            names=["vertex", "copies", "key", "sketch", "paths", "members"],
        )


_ROW = "bucket bigint, node bigint, side int, across boolean, vertex binary, copies bigint, key binary, sketch binary, paths array<bigint>"


def linked(docs: DataFrame, sets: DataFrame, doc_id: str, text: str, threshold: float, runs: int, limit: int, depth: int) -> DataFrame:
    """``vertex, links, root``: per set and bucket its links there, and the least set joined; written."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    members = leaves(sets, runs, limit, depth)
    spread = _spread(members, sets, limit).repartition(parts, "bucket").sortWithinPartitions("bucket", "side", "vertex")
    found = saved(spread.mapInArrow(_candidates, _ROW), "jaccard-candidates", keep=False)
    for level in members._worklens_levels:
        drop(level)
    # rows that agree in id and text are one, however many they are
    texts = (
        docs.select(row_key(F.col(doc_id), F.col(text)).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
        .groupBy("key")
        .agg(F.first("text").alias("text"))
    )
    whole = found.join(texts, "key").drop("key")
    whole = whole.repartition(parts, "bucket").sortWithinPartitions("bucket", "side", "vertex")
    result = saved(
        whole.mapInArrow(_verified(threshold), "vertex binary, links bigint, root binary"), "jaccard-links"
    )
    drop(found)
    return result


# --- classes ----------------------------------------------------------------------


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``vertex, label``: the least vertex each vertex of the edges is connected to; written.

    Each round takes the least label of the neighbours, then the label's own
    label. Labels are written each round; edges are few, one per set and bucket.
    """
    pairs = saved(
        edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where(F.col("u") != F.col("v")).distinct(), "cc-edges", keep=False
    )
    both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
    labels = saved(
        both.groupBy(F.col("u").alias("vertex")).agg(F.min(F.least("u", "v")).alias("label")), "cc-labels", keep=False
    )
    while True:
        near = (
            both.join(labels.withColumnRenamed("vertex", "v"), "v")
            .groupBy(F.col("u").alias("vertex")).agg(F.min("label").alias("near"))
        )
        hooked = saved(
            labels.join(near, "vertex").select("vertex", F.col("label").alias("old"), F.least("label", "near").alias("label")),
            "cc-hooked", keep=False,
        )
        jump = hooked.select(F.col("vertex").alias("label"), F.col("label").alias("next"))
        after = saved(
            hooked.join(jump, "label").select("vertex", "old", F.least("label", "next").alias("label")), "cc-labels", keep=False
        )
        moved = after.where(F.col("old") != F.col("label")).isEmpty()
        drop(hooked)
        drop(labels)
        labels = after
        if moved:
            drop(pairs)
            return labels.select("vertex", "label")


def join(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    threshold: float = THRESHOLD,
    recall: float = RECALL,
    limit: int = LIMIT,
    depth: int = DEPTH,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, key, class_id, class_key, n_links``.

    Rows linked directly or through others share a class, named by the least id
    in it (a null only if all are) and by the key of its first row. ``n_links`` counts the
    other rows of at least the similarity.
    """
    rows = described(docs, doc_id, text)
    sets = vertices(rows)
    links = linked(docs, sets, doc_id, text, threshold, runs_for(recall, depth, threshold), limit, depth)
    labels = components(links, "vertex", "root")
    total = links.groupBy("vertex").agg(F.sum("links").alias("links"))
    known = saved(
        sets.select("vertex", "copies", "lead").join(labels, "vertex", "left").join(total, "vertex", "left").select(
            "vertex",
            "lead",
            F.coalesce("label", "vertex").alias("label"),
            (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        ),
        "jaccard-sets",
    )
    leads = saved(known.groupBy("label").agg(F.min("lead").alias("first")), "jaccard-classes")
    named = saved(
        known.join(leads, "label").select(
            "vertex", F.col("first.doc_id").alias("class_id"), F.col("first.key").alias("class_key"), "n_links"
        ),
        "jaccard-named",
    )
    return rows.select("doc_id", "key", "vertex").join(named, "vertex").drop("vertex")


def deduplicate(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each class of ``docs``, the first by id, with all columns as they are."""
    names = docs.columns
    classes = join(docs, doc_id, text)
    first = saved(classes.where(F.col("key") == F.col("class_key")).select("key").distinct(), "jaccard-kept")
    key = "_worklens_key"
    rows = docs.withColumn(key, row_key(F.col(doc_id), F.col(text)))
    kept = rows.join(first.withColumnRenamed("key", key), key)
    # rows that agree in id and text are one
    return kept.dropDuplicates([key]).select(*(F.col(f"`{n}`") for n in names))
