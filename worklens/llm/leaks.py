"""Benchmark decontamination with spaced seeds.

A seed is a window of tokens of which a fixed mask reads some and ignores the
rest, so a passage whose words were replaced here and there still shares seeds
with its source. Benchmark and training seeds meet by hash; around each hit the
two token sequences are laid side by side, and the longest interval with the hit
counts if enough of its tokens agree.

The benchmark is the stated query set. It is taken in blocks of at most
``BLOCK_TOKENS`` tokens, so what is broadcast has a fixed bound whatever its
size; every block meets all documents where they lie, without a shuffle.

Tokens are the lower-cased runs of letters and digits. An overlap has at least
``LEAST`` tokens between its first and last agreeing token, or all of a shorter
item, and agrees in ``SHARE`` of them. Items of fewer than 8 tokens say nothing.
An interval is sought up to ``REACH`` tokens from a hit; longer overlaps are the union
of their hits' intervals.
Null text counts as empty, empty texts neither leak nor are leaked; an empty
benchmark or table gives no findings. Rows of one id and text are one finding.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, NOT_ALNUM, mixed, slices, text_bytes, word_hashes, words
from .secrets import address

#: Each reads eight tokens. Substitutions every 5, 4 or 3 tokens leave one of them whole.
MASKS = ("11111111", "111101111", "1110111011", "1101110111", "11011011011")
LEAST = 13
SHARE = 0.75
#: Tokens compared on either side of a hit.
REACH = 64
BLOCK_TOKENS = 500_000
#: Items are cut into pieces of so many tokens, which overlap by two reaches.
PIECE = 20_000


@dataclass(frozen=True)
class Block:
    """Seeds of some benchmark items, sorted by hash for each mask."""

    tokens: np.ndarray  # hashes of all items' tokens
    bounds: np.ndarray  # each item's first token, and the end
    item_of: np.ndarray  # each token's item
    hashes: tuple[np.ndarray, ...]
    places: tuple[np.ndarray, ...]  # token positions of the sorted seeds
    bits: tuple[np.ndarray, ...]  # which low bits of a hash occur
    owners: np.ndarray  # items that share a place's surroundings, end to end
    owned: np.ndarray  # their offsets by place
    sets: np.ndarray  # a hash of a place's owners
    ids: list


def tokenized(column: pa.Array):
    data, offsets = text_bytes(column)
    data = LOWER[data]
    starts, ends, at = words(data, offsets, NOT_ALNUM)
    return data, offsets, starts, ends, at, word_hashes(data, starts, ends)


def seeds(tokens: np.ndarray, mask: str) -> np.ndarray:
    """The seed hash of every window, by its first token."""
    n = len(tokens) - len(mask) + 1
    total = np.zeros(max(n, 0), np.uint64)
    if n <= 0:
        return total
    for k, c in enumerate(mask):
        if c == "1":
            total = total * np.uint64(0x9E3779B97F4A7C15) + tokens[k : k + n]
    return mixed(total)


def prepare(ids: list, texts: list[str]) -> Block | None:
    """Seeds of these items; None if no item is long enough."""
    _, _, _, _, at, tokens = tokenized(pa.array(texts, pa.large_string()))
    cut = [
        (i, a + s, min(a + s + PIECE, b))
        for i, (a, b) in enumerate(zip(at[:-1], at[1:], strict=True))
        for s in range(0, max(1, b - a - 2 * REACH), PIECE - 2 * REACH)
        if b - a >= len(MASKS[0])
    ]
    if not cut:
        return None
    tokens = np.concatenate([tokens[a:b] for _, a, b in cut])
    size = np.array([b - a for _, a, b in cut])
    bounds = np.concatenate([[0], np.cumsum(size)])
    item_of = np.repeat(np.arange(len(cut)), size)
    # Places with the same surroundings in several items are verified once.
    around = np.zeros(len(tokens), np.uint64)
    for k in range(-REACH, REACH + len(MASKS[-1])):
        place = np.arange(len(tokens)) + k
        inside = (place >= bounds[item_of]) & (place < bounds[item_of + 1])
        here = np.where(inside, tokens[np.clip(place, 0, len(tokens) - 1)], np.uint64(1))
        around = mixed(around * np.uint64(0x9E3779B97F4A7C15) + here)
    order = np.argsort(around, kind="stable")
    new = np.append(True, around[order][1:] != around[order][:-1])
    group = np.cumsum(new) - 1
    first = order[new]
    lead = np.zeros(len(tokens), np.int64)
    lead[order] = first[group]
    owned = np.zeros(len(tokens) + 1, np.int64)
    counts = np.zeros(len(tokens), np.int64)
    counts[first] = np.bincount(group)
    np.cumsum(counts, out=owned[1:])
    owners = np.zeros(len(tokens), np.int64)
    source = np.array([i for i, _, _ in cut])[item_of]
    rank = np.arange(len(order)) - np.flatnonzero(new)[group]
    owners[owned[first][group] + rank] = source[order]
    sets = np.zeros(len(tokens), np.uint64)
    np.add.at(sets, lead, mixed(source.astype(np.uint64) + np.uint64(1)))
    hashes, places, bits = [], [], []
    width = np.uint64((1 << int(np.ceil(np.log2(16 * len(tokens) + 16)))) - 1)
    for mask in MASKS:
        h = seeds(tokens, mask)
        start = np.arange(len(h))
        fits = (start + len(mask) <= bounds[item_of[: len(h)] + 1]) & (lead[: len(h)] == start)
        h, start = h[fits], start[fits]
        by = np.argsort(h, kind="stable")
        hashes.append(h[by])
        places.append(start[by])
        found = np.zeros(int(width) + 1, bool)
        found[h & width] = True
        bits.append(found)
    return Block(tokens, bounds, item_of, tuple(hashes), tuple(places), tuple(bits), owners, owned, sets, ids)


def blocks(benchmark: DataFrame, item_id: str = "item_id", text: str = "text") -> Iterator[Block]:
    """The benchmark in blocks of bounded size; an item of any length is cut to pieces."""
    ids, texts, size = [], [], 0
    for row in benchmark.select(F.col(item_id).alias("i"), F.coalesce(F.col(text), F.lit("")).alias("t")).toLocalIterator():
        ids.append(row["i"])
        texts.append(row["t"])
        size += len(row["t"]) // 2 + 1  # at least as many as its tokens
        if size >= BLOCK_TOKENS:
            if (block := prepare(ids, texts)) is not None:
                yield block
            ids, texts, size = [], [], 0
    if texts and (block := prepare(ids, texts)) is not None:
        yield block


def overlaps(tokens: np.ndarray, at: np.ndarray, block: Block):
    """Verified overlaps as (row, first token, token behind the last, place in the block)."""
    none = np.zeros(0, np.int64)
    mine, theirs = [none], [none]
    for mask, known, places, bits in zip(MASKS, block.hashes, block.places, block.bits, strict=True):
        h = seeds(tokens, mask)
        near = np.flatnonzero(bits[h & np.uint64(len(bits) - 1)])
        low = np.searchsorted(known, h[near], "left")
        many = np.searchsorted(known, h[near], "right") - low
        near, low, many = near[many > 0], low[many > 0], many[many > 0]
        spot = np.repeat(near, many)
        k = np.arange(len(spot)) - np.repeat(np.cumsum(many) - many, many)
        inside = np.searchsorted(at, spot, "right") == np.searchsorted(at, spot + len(mask) - 1, "right")
        mine.append(spot[inside])
        theirs.append(places[np.repeat(low, many) + k][inside])
    i, j = np.concatenate(mine), np.concatenate(theirs)
    if not len(i):
        return none, none, none, none
    # Hits that start side by side on a diagonal lie in one run of agreeing tokens, which any
    # longest interval holds as a whole; a long run is taken up again, as a hit reaches so far only.
    order = np.lexsort((i, block.item_of[j], i - j))
    i, j = i[order], j[order]
    same = (np.diff(i - j) == 0) & (np.diff(block.item_of[j]) == 0) & (np.diff(i) <= 1)
    same &= (np.diff(i // 16) == 0) & (block.sets[j[1:]] == block.sets[j[:-1]])
    pick = np.flatnonzero(np.append(True, ~same))
    results = []
    for part in np.array_split(pick, len(pick) // 20_000 + 1):
        results.append(_verified(tokens, at, block, i[part], j[part]))
    return tuple(np.concatenate(x) for x in zip(*results, strict=True))


def _verified(tokens, at, block, i, j):
    """The longest interval around each hit that agrees in ``SHARE``, if it is long enough."""
    row = np.searchsorted(at, i, "right") - 1
    item = block.item_of[j]
    left = np.minimum(np.minimum(i - at[row], j - block.bounds[item]), REACH)
    right = np.minimum(np.minimum(at[row + 1] - i, block.bounds[item + 1] - j), REACH + len(MASKS[-1]))

    def scores(steps: np.ndarray, sign: int, most: int) -> np.ndarray:
        """By tokens gone: the best sum of (agree - SHARE) at an agreeing token there or beyond."""
        k = np.arange(most)
        ok = k < steps[:, None]
        a = np.clip(i[:, None] + (k if sign > 0 else -1 - k), 0, len(tokens) - 1)
        b = np.clip(j[:, None] + (k if sign > 0 else -1 - k), 0, len(block.tokens) - 1)
        same = ok & (tokens[a] == block.tokens[b])
        score = np.where(same, np.cumsum(same - SHARE, axis=1), -np.inf)
        score = np.column_stack([np.zeros(len(i)), score])
        return np.maximum.accumulate(score[:, ::-1], axis=1)[:, ::-1]

    ahead, behind = scores(right, 1, REACH + len(MASKS[-1])), scores(left, -1, REACH)
    # Neither rises with the distance: going on behind wherever the sum allows it, and else
    # coming back ahead, passes the longest pair.
    every = np.arange(len(i))
    back, on = np.zeros(len(i), np.int64), right.copy()
    first, last = np.zeros(len(i), np.int64), np.zeros(len(i), np.int64)
    for _ in range(ahead.shape[1] + behind.shape[1]):
        fits = behind[every, back] + ahead[every, on] >= 0
        better = fits & (back + on > first + last) & (on > 0)
        first, last = np.where(better, back, first), np.where(better, on, last)
        more = fits & (back < left)
        back, on = back + more, np.where(more, on, np.maximum(on - 1, 0))
    need = np.minimum(LEAST, block.bounds[item + 1] - block.bounds[item])
    good = first + last >= need
    return row[good], (i - first)[good], (i + last)[good], j[good]


_FOUND = "doc_id bigint, blob binary, items array<bigint>, spans array<struct<start:bigint,end:bigint>>, n_tokens bigint"


def _search(block_ref):
    """Map function: for each row that overlaps the block, the items and the character spans."""

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = block_ref.value
        span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
        for batch in slices(batches, "text"):
            data, offsets, starts, ends, at, tokens = tokenized(batch.column("text"))
            row, first, last, place = overlaps(tokens, at, block)
            if not len(row):
                continue
            chars = np.zeros(len(data) + 1, np.int64)
            np.cumsum((data & 0xC0) != 0x80, out=chars[1:])
            rows, items, spans, covered = [], [], [], []
            order = np.lexsort((last, first, row))
            for r, group in _runs(row[order]):
                k = order[group]
                rows.append(r)
                owners = {o for p in place[k] for o in block.owners[block.owned[p] : block.owned[p + 1]]}
                items.append([block.ids[o] for o in sorted(owners)])
                merged = _merged(first[k], last[k])
                base = chars[offsets[r]]
                spans.append([{"start": chars[starts[a]] - base, "end": chars[ends[b - 1]] - base} for a, b in merged])
                covered.append(sum(b - a for a, b in merged))
            at_rows = pa.array(rows)
            yield pa.record_batch(
                [
                    batch.column("doc_id").take(at_rows),
                    batch.column("blob").take(at_rows),
                    pa.array(items, pa.list_(pa.int64())),
                    pa.array(spans, pa.list_(span)),
                    pa.array(covered, pa.int64()),
                ],
                names=["doc_id", "blob", "items", "spans", "n_tokens"],
            )

    return search


def _runs(sorted_rows: np.ndarray) -> Iterator[tuple[int, slice]]:
    edges = np.flatnonzero(np.diff(sorted_rows)) + 1
    for a, b in zip([0, *edges], [*edges, len(sorted_rows)], strict=True):
        yield int(sorted_rows[a]), slice(a, b)


def _merged(first: np.ndarray, last: np.ndarray) -> list[tuple[int, int]]:
    """Union of ranges sorted by start."""
    out: list[list[int]] = []
    for a, b in zip(first.tolist(), last.tolist(), strict=True):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [tuple(x) for x in out]


def find(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Contaminated rows: ``doc_id, items`` (ascending), ``spans`` by start in
    characters, and ``n_tokens`` in overlaps. With several blocks of the benchmark their
    spans stand side by side, and ``n_tokens`` is the greatest of them."""
    spark = docs.sparkSession
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), address(F.col(text)).alias("blob"), F.col(text).alias("text")
    )
    found = spark.createDataFrame([], _FOUND)
    for block in blocks(benchmark):
        found = found.unionByName(rows.mapInArrow(_search(spark.sparkContext.broadcast(block)), _FOUND))
    return (
        found.groupBy("doc_id", "blob")
        .agg(
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("spans")))).alias("spans"),
            F.max("n_tokens").alias("n_tokens"),
        )
        .drop("blob")
    )


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` without an overlap, all columns as they are; no shuffle."""
    for block in blocks(benchmark):
        ref = docs.sparkSession.sparkContext.broadcast(block)

        def kept(batches: Iterable[pa.RecordBatch], ref=ref) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches, text):
                _, _, _, _, at, tokens = tokenized(batch.column(text))
                row, *_ = overlaps(tokens, at, ref.value)
                keep = np.ones(batch.num_rows, bool)
                keep[row] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(kept, docs.schema)
    return docs
