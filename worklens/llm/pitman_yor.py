"""Language-model scores from a hierarchical Pitman-Yor model.

A word follows the word before it in one restaurant per previous word, whose parent is
the restaurant of all words. That one's base distribution spells words: a letter follows
its last three letters in one restaurant per context, whose parent is the
restaurant of the last two, and so on to one letter, none, and all bytes alike.
A text's tokens are words of the training texts or unknown: all others are one
event, which has what a new table gives to spellings outside the vocabulary. A text's
first word follows its start. Whether a text ends before a token is a choice apart, the
same behind each word; its base probability is the spelling without letters.

Seating is sampled by Gibbs. A pair's customers are its occurrences in training
texts; given the word's probability in the parent and the tables of the others, the
number of its tables is drawn as a block from its conditional distribution. Each
table sends a customer to the restaurant of all words, where tables are drawn likewise
and send the word's letters as customers to the context restaurants, whose
tables send customers to their parents in turn. After ``BURN`` sweeps, the
predictive probabilities of ``KEPT`` sweeps are averaged.

Spark does the work on words and pairs. Texts are read in slices: a slice's distinct
words go to the partition of their hash with their counts, its distinct pairs to that of
the previous word's hash. There the corpus's tables are merged and written once; in each sweep
the pairs' partitions send tables by word to the words' partitions and get the words'
probabilities back, and only tables and probabilities are written. In the end texts are read
again, ``ROUNDS`` shares one after the other, and each slice gets the probabilities of its pairs; both
readings must give the same rows. So what is moved is per slice and distinct word or pair, a
frequent word cannot crowd a partition, and texts do not move. The restaurants of three
letters lie in partitions by context and are joined to the words' letters; only those of
two letters or less, which byte pairs bound, are gathered and broadcast.

Null text counts as empty: the end alone. A row without an id is for training. Repeated
rows count and are scored each. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, SPACE, drop, prefix_sums, saved, slices, span_hashes
from .common import text_bytes, word_hashes, words
from .token_files import pack, unpack

SWEEPS, BURN = 3, 1
KEPT = SWEEPS - BURN
#: Text bytes whose distinct words are sent together.
SLICE = 6_000_000
#: Parts of a bucket of pairs, by the previous word, which are seated one after the other.
FINER = 4
#: Rounds in which texts are scored: what they ask of the pairs, and the answers, take disk for a round at a time.
ROUNDS = 4
#: Customers of a dish up to which the conditional is summed exactly.
EXACT = 100
#: Pulls an almost empty restaurant to its parent.
STRENGTH = 1.0
ORDERS = 4
_GAP = 0x20  # bounds words and ends their spelling


# --- seating ----------------------------------------------------------------------


def stirling(most: int, discount: float) -> np.ndarray:
    """Logarithms of the generalized Stirling numbers: ways to seat c customers at t tables."""
    s = np.full((most + 1, most + 1), -np.inf)
    s[0, 0] = 0.0
    for c in range(1, most + 1):
        t = np.arange(1, c + 1)
        with np.errstate(divide="ignore"):
            stay = s[c - 1, 1 : c + 1] + np.log(np.maximum(c - 1 - t * discount, 0))
        s[c, 1 : c + 1] = np.logaddexp(s[c - 1, 0:c], stay)
    return s


def draw_tables(
    customers: np.ndarray, base: np.ndarray, weight: np.ndarray, discount: float, rng: np.random.Generator
) -> np.ndarray:
    """Tables of each dish, drawn given its customers.

    ``base`` is the logarithm of the dish's probability in the parent, ``weight`` what the
    restaurant gives to the parent: its strength and the discount of all its tables.
    """
    tables = np.minimum(customers, 1).astype(np.int64)
    several = np.flatnonzero(customers > 1)
    if not len(several):
        return tables
    small = several[customers[several] <= EXACT]
    ways = stirling(min(EXACT, int(customers[small].max(initial=1))), discount)
    order = small[np.argsort(customers[small], kind="stable")]
    edges = np.flatnonzero(np.diff(customers[order], prepend=-1))
    for a, b in zip(edges, [*edges[1:], len(order)], strict=False):
        c = int(customers[order[a]])
        for low in range(a, b, 200_000 // c + 1):
            rows = order[low : min(b, low + 200_000 // c + 1)]
            t = np.arange(1, c + 1)
            # each further table raises the weight by a discount
            more = np.cumsum(np.log(weight[rows, None] + discount * np.arange(c)[None, :]), axis=1)
            p = more + t * base[rows, None] + ways[c, 1 : c + 1]
            p = np.cumsum(np.exp(p - p.max(axis=1, keepdims=True)), axis=1)
            tables[rows] = 1 + (p < rng.random(len(rows))[:, None] * p[:, -1:]).sum(axis=1)
    big = several[customers[several] > EXACT]
    if len(big):
        # seat them in lots that grow with what is seated; within a lot the rates hardly move
        seated, share = np.ones(len(big)), np.exp(base[big])
        c, t = customers[big].astype(float), np.ones(len(big))
        while (seated < c).any():
            lot = np.minimum(np.maximum(seated * 0.1, 1), c - seated)
            new = (weight[big] + discount * t) * share
            t += np.minimum(rng.poisson(lot * new / (new + np.maximum(seated - discount * t, 1e-9))), lot)
            seated += lot
        tables[big] = np.minimum(t, c).astype(np.int64)
    return tables


# --- letters ----------------------------------------------------------------------


@dataclass
class Letters:
    """Seating in the context restaurants; cells are ``context << 8 | byte``, by order."""

    cells: list[np.ndarray] = field(default_factory=lambda: [np.zeros(0, np.int64) for _ in range(ORDERS)])
    customers: list[np.ndarray] = field(default_factory=lambda: [np.zeros(0, np.int64) for _ in range(ORDERS)])
    tables: list[np.ndarray] = field(default_factory=lambda: [np.zeros(0, np.int64) for _ in range(ORDERS)])
    rooms: list[np.ndarray] = field(default_factory=lambda: [np.zeros(0, np.int64) for _ in range(ORDERS)])
    guests: list[np.ndarray] = field(default_factory=lambda: [np.zeros(0, np.int64) for _ in range(ORDERS)])
    laid: list[np.ndarray] = field(default_factory=lambda: [np.zeros(0, np.int64) for _ in range(ORDERS)])
    discount: list[float] = field(default_factory=lambda: [0.5] * ORDERS)

    def probability(self, cells: np.ndarray) -> np.ndarray:
        """Of the bytes of order-3 cells in their contexts, backing off along shared parents."""
        p = np.full(len(cells), 1 / 256)
        for k in range(ORDERS):
            p = self._at(k, _shorter(cells, k), p)
        return p

    def _at(self, k: int, cells: np.ndarray, parent: np.ndarray) -> np.ndarray:
        n, t = _found(self.cells[k], cells, self.customers[k], self.tables[k])
        total, laid = _found(self.rooms[k], cells >> 8, self.guests[k], self.laid[k])
        own = n - self.discount[k] * t + (STRENGTH + self.discount[k] * laid) * parent
        return np.where(total > 0, own / (STRENGTH + total), parent)


def _found(keys: np.ndarray, wanted: np.ndarray, *values: np.ndarray) -> list[np.ndarray]:
    if not len(keys):
        return [np.zeros(len(wanted)) for _ in values]
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    hit = keys[at] == wanted
    return [np.where(hit, v[at], 0) for v in values]


def _shorter(cells: np.ndarray, order: int) -> np.ndarray:
    return cells & ((1 << 8 * (order + 1)) - 1)


def _summed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    found, back = _numbered(keys)
    return found, np.bincount(back, values, len(found)).astype(np.int64)


def seat_letters(before: Letters, third: tuple | None, second: tuple, rng: np.random.Generator) -> Letters:
    """A sweep over the context restaurants, given customers of the third and second order.

    Customers of contexts without a restaurant of three letters sit in that of two. Without
    ``third``, whose restaurants lie elsewhere then, those of two letters and less are seated.
    """
    now = Letters()
    pairs, all_n = second
    cells, n = third or second
    for k in range(ORDERS - 1 if third else ORDERS - 2, -1, -1):
        one, two = (n == 1).sum(), (n == 2).sum()
        d = float(np.clip(one / (one + 2 * two) if one else 0.5, 0.1, 0.9))
        wide = cells  # the cell's own bytes suffice to look its shorter contexts up
        p = np.full(len(cells), 1 / 256)
        for j in range(k):
            p = before._at(j, _shorter(wide, j), p)
        (laid,) = _found(before.rooms[k], cells >> 8, before.laid[k])
        t = draw_tables(n, np.log(p), STRENGTH + d * laid, d, rng)
        now.cells[k], now.customers[k], now.tables[k], now.discount[k] = cells, n, t, d
        now.rooms[k], now.guests[k] = _summed(cells >> 8, n)
        _, now.laid[k] = _summed(cells >> 8, t)
        if k == ORDERS - 1:
            # what sits above goes down as tables only
            gone, sitting = _summed(_shorter(cells, k - 1), n - t)
            at = np.searchsorted(pairs, gone)
            n = all_n.copy()
            n[at] -= sitting
            cells = pairs
        elif k:
            cells, n = _summed(_shorter(cells, k - 1), t)
    return now


def spelling(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The cells of all letters of the words, ends included, and each word's offsets in them."""
    size = ends - starts + 1
    at = np.zeros(len(size) + 1, np.int64)
    np.cumsum(size, out=at[1:])
    flat = np.arange(at[-1])
    step = flat - np.repeat(at[:-1], size)
    padded = np.append(data, np.uint8(_GAP))
    letters = padded[np.minimum(flat + np.repeat(starts - at[:-1], size), len(data))].astype(np.int64)
    letters[at[1:] - 1] = _GAP
    cells = np.zeros(at[-1], np.int64)
    for back in range(ORDERS - 1, -1, -1):
        letter = np.full(at[-1], _GAP, np.int64)
        letter[back:] = letters[: len(letters) - back]
        letter[step < back] = _GAP
        cells = cells << 8 | letter
    return cells, at


# --- words ------------------------------------------------------------------------

_READ = {
    "slice": pa.int64(), "bucket": pa.int32(), "doc_ids": pa.list_(pa.int64()), "held": pa.list_(pa.bool_()),
    "tokens": pa.list_(pa.int64()), "control": pa.binary(), "data": pa.binary(), "contexts": pa.binary(),
    "words": pa.binary(), "sizes": pa.binary(), "cells": pa.binary(), "counts": pa.binary(),
}
_READ_SCHEMA = (
    "slice bigint, bucket int, doc_ids array<bigint>, held array<boolean>, tokens array<bigint>, control binary, data binary, "
    "contexts binary, words binary, sizes binary, cells binary, counts binary"
)


def shrunk(numbers: np.ndarray) -> bytes:
    """The numbers' first bytes, then all their second ones and so on, compressed: small numbers take little."""
    planes = np.ascontiguousarray(numbers).view(np.uint8).reshape(len(numbers), -1).T if len(numbers) else numbers[:0]
    return len(numbers).to_bytes(8, "little") + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def grown(blob: bytes, kind: str = "<u4") -> np.ndarray:
    """The numbers that ``shrunk`` took, of the same kind."""
    n, width = int.from_bytes(blob[:8], "little"), np.dtype(kind).itemsize
    planes = pa.decompress(blob[8:], n * width, codec="zstd", asbytes=True) if n else b""
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(width, n).T).reshape(-1).view(kind)


def ascending(hashes: np.ndarray) -> bytes:
    """``shrunk`` for hashes in order, by their differences."""
    return shrunk(np.diff(hashes.astype("<u8"), prepend=np.uint64(0)))


def descended(blob: bytes) -> np.ndarray:
    """The hashes that ``ascending`` took."""
    return np.cumsum(grown(blob, "<u8"), dtype=np.uint64)


def _read(buckets: int, scoring: bool):
    """Map function: a slice's distinct words and pairs per bucket, or for ``scoring`` its texts and distinct pairs.

    Texts are codes of the slice's distinct pairs, which follow the bucket of the previous word, its
    hash, then the word's. A pair's row holds its previous words' hashes, how many words follow each, the hashes
    of all these, and which follow. Rows of words have buckets below 0.
    """

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for number, batch in enumerate(slices(batches, "text", SLICE)):
            name = part << 32 | number
            data, offsets = text_bytes(batch.column("text"))
            data = LOWER[data]
            starts, ends, at = words(data, offsets, SPACE)
            n = np.diff(at) + 1
            held = batch.column("held").to_numpy(zero_copy_only=False)
            # the end is the word without letters, behind each text's last; it is the start as well
            hashes = np.insert(word_hashes(data, starts, ends), at[1:], _END)
            starts, ends = np.insert(starts, at[1:], 0), np.insert(ends, at[1:], 0)
            distinct, first, code = _distinct(hashes)
            del hashes
            train = np.repeat(~held, n)

            before = np.empty(len(code), np.int64)
            before[1:] = code[:-1]
            before[np.cumsum(n) - n] = np.searchsorted(distinct, _END)
            inner = np.ones(len(code), bool)
            inner[np.cumsum(n) - 1] = False
            bucket = (distinct % np.uint64(buckets)).astype(np.int64)
            behind = np.argsort(bucket, kind="stable")
            place = np.empty(len(behind), np.int64)
            place[behind] = np.arange(len(behind))
            pairs, pair = _numbered(place[before[inner]] * len(distinct) + code[inner])
            del before
            often = np.bincount(pair, train[inner], len(pairs)).astype("<u4")
            u, w = pairs // len(distinct), pairs % len(distinct)  # distinct hashes ascend, so places sort like them
            parts = np.searchsorted(u, np.searchsorted(bucket[behind], np.arange(buckets + 1)))
            out = []
            if scoring:
                control, packed = pack(pair.astype(np.uint32))
                out.append({
                    "doc_ids": batch.column("doc_id").to_pylist(), "held": held.tolist(), "tokens": n.tolist(),
                    "control": control, "data": packed,
                })
            else:
                count = np.bincount(code, train, len(distinct)).astype("<u4")
                edges = np.searchsorted(bucket[behind], np.arange(buckets + 1))
                for b in range(buckets):
                    mine = behind[edges[b] : edges[b + 1]]
                    if len(mine):
                        size = (ends - starts)[first[mine]]
                        out.append({
                            "bucket": -1 - b, "words": shrunk(_gathered(data, starts[first[mine]], size)),
                            "sizes": shrunk(size.astype("<u4")), "counts": shrunk(count[mine]),
                        })
            for b in range(buckets):
                lo, hi = parts[b], parts[b + 1]
                if lo < hi:
                    mine, many = np.unique(u[lo:hi], return_counts=True)
                    vocabulary, cells = _numbered(w[lo:hi])
                    row = {
                        "bucket": b, "contexts": ascending(distinct[behind][mine]), "words": ascending(distinct[vocabulary]),
                        "sizes": shrunk(many.astype("<u4")), "cells": shrunk(cells.astype("<u4")),
                    }
                    out.append(row if scoring else row | {"counts": shrunk(often[lo:hi])})
            yield _batch([{"slice": name} | row for row in out], _READ)

    return read


def _numbered(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Like ``np.unique`` with the inverse; numbers and their places are sorted as one number where both fit."""
    bits = len(keys).bit_length()
    if not len(keys) or int(keys.max()) >= 1 << 63 - bits:
        return np.unique(keys, return_inverse=True)
    both = np.sort(keys << bits | np.arange(len(keys)))
    key = both >> bits
    new = np.append(True, key[1:] != key[:-1])
    number = np.empty(len(keys), np.int64)
    number[both & ((1 << bits) - 1)] = np.cumsum(new) - 1
    return key[new], number


def _distinct(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Like ``np.unique`` with a place of each and the inverse; sorts the distinct hashes only."""
    found = pa.array(hashes).dictionary_encode()
    some, number = found.dictionary.to_numpy(), found.indices.to_numpy()
    by = np.argsort(some)
    rank = np.empty(len(by), np.int64)
    rank[by] = np.arange(len(by))
    place = np.empty(len(by), np.int64)
    place[number] = np.arange(len(number))
    return some[by], place[by], rank[number]


def _batch(rows: list[dict], kinds: dict[str, pa.DataType]) -> pa.RecordBatch:
    return pa.record_batch([pa.array([r.get(k) for r in rows], t) for k, t in kinds.items()], names=list(kinds))


def _table(rows: list[dict], kinds: dict[str, pa.DataType]) -> pa.Table:
    return pa.Table.from_batches([_batch(rows, kinds)])


_END = np.uint64(0)  # the hash of no bytes


def _gathered(data: np.ndarray, starts: np.ndarray, size: np.ndarray) -> np.ndarray:
    total = np.cumsum(size)
    if not len(total) or not total[-1]:
        return np.zeros(0, np.uint8)
    return data[np.repeat(starts - (total - size), size) + np.arange(total[-1])]


def _rows_of(table: pa.Table) -> Iterator[dict]:
    for batch in table.to_batches():
        yield from batch.to_pylist()


def _hashes(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, bytes and sizes of a row's words."""
    data, size = grown(row["words"], "u1"), grown(row["sizes"]).astype(np.int64)
    ends = np.cumsum(size)
    return span_hashes(prefix_sums(data), ends - size, ends), data, size


#: The words of a bucket; the pairs of a part of a bucket; the words of a bucket's pairs that lie in the bucket ``to``.
_MERGED = {
    "bucket": pa.int32(), "words": pa.binary(), "sizes": pa.binary(), "counts": pa.binary(), "n": pa.int64(),
    "v": pa.int64(), "ends": pa.int64(), "contexts": pa.binary(), "cells": pa.binary(), "once": pa.int64(),
    "twice": pa.int64(), "part": pa.int32(), "to": pa.int32(), "sums": pa.binary(),
}
_MERGED_SCHEMA = (
    "bucket int, words binary, sizes binary, counts binary, n bigint, v bigint, ends bigint, "
    "contexts binary, cells binary, once bigint, twice bigint, part int, to int, sums binary"
)


def _merged(buckets: int):
    """Group function: a bucket's words or pairs, once each."""

    def merge(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        return _table(_merged_words(table, -1 - bucket) if bucket < 0 else _merged_pairs(table, bucket, buckets), _MERGED)

    return merge


def _merged_words(table: pa.Table, bucket: int) -> list[dict]:
    """A bucket's words once each, in the order of their hashes, with their training counts."""
    hashes, texts, sizes, counts = [], [], [], []
    for row in _rows_of(table):
        h, data, size = _hashes(row)
        hashes.append(h)
        texts.append(data)
        sizes.append(size)
        counts.append(grown(row["counts"]))
    size, data = np.concatenate(sizes), np.concatenate(texts)
    distinct, first, back = _distinct(np.concatenate(hashes))
    count = np.bincount(back, np.concatenate(counts), len(distinct)).astype("<i8")
    starts = np.cumsum(size) - size
    flat = _gathered(data, starts[first], size[first])
    return [{
        "bucket": bucket, "words": shrunk(flat), "sizes": shrunk(size[first].astype("<u4")), "counts": shrunk(count),
        "n": int(count.sum()), "v": int((count > 0).sum()), "ends": int(count[size[first] == 0].sum()),
    }]


@dataclass
class Sweep:
    """What a sweep of the words starts from: the tables of the sweep before."""

    number: int
    tables: int
    discount: float


_NO_LETTERS = np.array([_GAP << 24 | _GAP << 16 | _GAP << 8 | _GAP])


def _cells(row: dict) -> tuple[np.ndarray, np.ndarray]:
    size = grown(row["sizes"]).astype(np.int64)
    data, ends = grown(row["words"], "u1"), np.cumsum(size)
    return spelling(data, ends - size, ends)


_WORDS = "bucket int, words binary, sizes binary, counts binary, customers binary, tables binary, n_customers bigint, n_tables bigint, once bigint, twice bigint, base binary"


def _seated(sweep_ref):
    """Cogroup function: a bucket's words with the customers that pairs send, and their tables."""

    def seat(known: pa.Table, sent: pa.Table) -> pa.Table:
        (row,), sweep = known.to_pylist(), sweep_ref.value
        h, _, size = _hashes(row)
        count = grown(row["counts"], "<i8")
        customers = np.zeros(len(h), np.int64)
        places, sums = {}, {}
        for message in _rows_of(sent):
            if message["words"] is None:
                sums[message["bucket"]] = message["sums"]
            else:  # before the first sweep, sums come with the words
                places[message["bucket"]] = np.searchsorted(h, descended(message["words"]))
                sums.setdefault(message["bucket"], message["sums"])
        for bucket, at in places.items():
            customers[at] += grown(sums[bucket])
        if row.get("base") is None:
            tables = np.minimum(customers, 1)
        else:
            rng = np.random.default_rng([sweep.number, row["bucket"]])
            weight = np.full(len(h), STRENGTH + sweep.discount * sweep.tables)
            tables = draw_tables(customers, grown(row["base"], "<f8"), weight, sweep.discount, rng)
        inner = tables.sum()
        tables = np.where(size > 0, tables, np.minimum(count, 1))  # the end sends its letter once
        return pa.table(
            {
                **{k: known.column(k) for k in ("bucket", "words", "sizes", "counts")},
                "customers": pa.array([shrunk(customers.astype("<i8"))], pa.binary()),
                "tables": pa.array([shrunk(tables.astype("<i8"))], pa.binary()),
                "n_customers": pa.array([int(customers.sum())]),
                "n_tables": pa.array([int(inner)]),
                "once": pa.array([int((customers == 1).sum())]),
                "twice": pa.array([int((customers == 2).sum())]),
                "base": pa.nulls(1, pa.binary()),
            }
        )

    return seat


def _letter_counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            cells, at = _cells(row)
            distinct, n = _summed(cells, np.repeat(grown(row["tables"], "<i8"), np.diff(at)))
            distinct, n = distinct[n > 0], n[n > 0]
            yield pa.record_batch(
                [pa.array([row["bucket"]] * len(n), pa.int32()), pa.array(distinct), pa.array(n)], names=["bucket", "cell", "n"]
            )


@dataclass
class Third:
    """What restaurants of three letters need: the sweep, the shorter contexts, their own discount."""

    number: int
    letters: Letters
    discount: float


_THIRD = "part int, cell bigint, n bigint, tables bigint, guests bigint, laid bigint"


def _third_seated(third_ref):
    """Cogroup function: tables of the cells of some contexts, given those of the sweep before."""

    def seat(sent: pa.Table, before: pa.Table) -> pa.Table:
        third = third_ref.value
        part = sent.column("part")[0].as_py() if sent.num_rows else 0
        cells, n = sent.column("cell").to_numpy(), sent.column("n").to_numpy()
        by = np.argsort(cells)
        cells, n = cells[by], n[by]
        rooms, first = np.unique(before.column("cell").to_numpy() >> 8, return_index=True)
        (laid,) = _found(rooms, cells >> 8, before.column("laid").to_numpy()[first])
        rng = np.random.default_rng([third.number, part, 3])
        p = third.letters.probability(cells)
        t = draw_tables(n, np.log(p), STRENGTH + third.discount * laid, third.discount, rng)
        _, room = np.unique(cells >> 8, return_inverse=True)
        guests, laid = (np.bincount(room, x)[room].astype(np.int64) if len(x) else x for x in (n, t))
        columns = [pa.array([part] * len(t), pa.int32()), *(pa.array(x, pa.int64()) for x in (cells, n, t, guests, laid))]
        return pa.table(columns, names=["part", "cell", "n", "tables", "guests", "laid"])

    return seat


def _third_probability(third_ref):
    def weigh(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        third = third_ref.value
        for batch in batches:
            n, t, guests, laid = (batch.column(k).to_numpy() for k in ("n", "tables", "guests", "laid"))
            parent = third.letters.probability(batch.column("cell").to_numpy())
            own = n - third.discount * t + (STRENGTH + third.discount * laid) * parent
            yield pa.record_batch([batch.column("cell"), pa.array(own / (STRENGTH + guests))], names=["cell", "p"])

    return weigh


def _spelled(no_letters: float):
    """Cogroup function: adds how probable a bucket's words are by their letters, among words with any.

    The logarithm; only that of words with tables, whose letters' cells all exist, is used.
    """

    def spell(known: pa.Table, answers: pa.Table) -> pa.Table:
        (row,) = known.to_pylist()
        keys, p = answers.column("cell").to_numpy(), answers.column("p").to_numpy()
        by = np.argsort(keys)
        cells, at = _cells(row)
        distinct, place = _numbered(cells)
        (found,) = (x[place] for x in _found(keys[by], distinct, p[by]))
        total = np.append(0.0, np.cumsum(np.log(np.where(found > 0, found, 1.0))))
        base = total[at[1:]] - total[at[:-1]] - np.log1p(-no_letters)
        return known.set_column(
            known.schema.get_field_index("base"), "base", pa.array([shrunk(base.astype("<f8"))], pa.binary())
        )

    return spell


def _known_mass(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How probable the spellings of the bucket's training words are."""
    for batch in batches:
        for row in batch.to_pylist():
            trained = (grown(row["counts"], "<i8") > 0) & (grown(row["sizes"]) > 0)
            yield pa.record_batch([pa.array([np.exp(grown(row["base"], "<f8"))[trained].sum()])], names=["mass"])


_ANSWERS = {"bucket": pa.int32(), "to": pa.int32(), "word_counts": pa.binary(), "p": pa.binary()}
_ANSWERS_SCHEMA = "bucket int, to int, word_counts binary, p binary"


def _answered(sweep_ref, customers: int, unknown: float, last: bool):
    """Cogroup function: to each bucket of pairs, probabilities of the words it asks for, and in the end their counts."""

    def answer(known: pa.Table, asked: pa.Table) -> pa.Table:
        (row,), sweep = known.to_pylist(), sweep_ref.value
        h, _, _ = _hashes(row)
        count, c, t = (grown(row[k], "<i8") for k in ("counts", "customers", "tables"))
        weight = STRENGTH + sweep.discount * sweep.tables
        p = (c - sweep.discount * t + weight * np.exp(grown(row["base"], "<f8"))) / (STRENGTH + customers)
        p = np.where(count > 0, p, unknown)
        out = []
        for ask in _rows_of(asked):
            at = np.searchsorted(h, descended(ask["words"]))
            out.append({
                "bucket": ask["bucket"], "to": row["bucket"], "p": shrunk(p[at].astype("<f8")),
                "word_counts": shrunk(count[at].astype("<i8")) if last else None,
            })
        return _table(out, _ANSWERS)

    return answer


# --- pairs ------------------------------------------------------------------------

#: The tables of the pairs of a part, and (``to`` is not null) a bucket's sums by word for the words' bucket ``to``.
_SEATS = {"bucket": pa.int32(), "part": pa.int32(), "to": pa.int32(), "tables": pa.binary(), "sums": pa.binary()}
_SEATS_SCHEMA = "bucket int, part int, to int, tables binary, sums binary"


def _merged_pairs(table: pa.Table, bucket: int, buckets: int) -> list[dict]:
    """The training pairs of a bucket once each; its words, held-out texts' too, with the sums of one table a pair."""
    before, after, counts = [], [], []
    for row in _rows_of(table):
        before.append(np.repeat(descended(row["contexts"]), grown(row["sizes"])))
        after.append(descended(row["words"])[grown(row["cells"])])
        counts.append(grown(row["counts"]))
    # by their places among the bucket's previous words and words, in one number
    contexts, _, u = _distinct(np.concatenate(before))
    vocabulary, _, w = _distinct(np.concatenate(after))
    del before, after
    key, c = u * len(vocabulary) + w, np.concatenate(counts)
    del u, w, counts
    key, c = key[c > 0], c[c > 0]
    order = np.argsort(key, kind="stable")
    key, c = key[order], c[order]
    del order
    new = np.flatnonzero(np.append(True, key[1:] != key[:-1])[: len(key)])
    c = np.add.reduceat(c.astype(np.int64), new) if len(new) else c.astype(np.int64)
    many = np.bincount(key[new] // len(vocabulary), minlength=len(contexts))
    contexts, many = contexts[many > 0], many[many > 0]
    by = np.argsort(vocabulary % np.uint64(buckets), kind="stable")
    place = np.empty(len(by), np.int64)
    place[by] = np.arange(len(by))
    cells = place[key[new] % len(vocabulary)]
    vocabulary = vocabulary[by]
    sums = np.bincount(cells, minlength=len(vocabulary)).astype("<u4")
    edges = np.searchsorted(vocabulary % np.uint64(buckets), np.arange(buckets + 1))
    out = []
    home = contexts % np.uint64(FINER * buckets)
    for part in np.unique(home).tolist():
        rooms = home == part
        mine = np.repeat(rooms, many)
        out.append({
            "bucket": bucket, "part": part, "contexts": ascending(contexts[rooms]), "sizes": shrunk(many[rooms].astype("<u4")),
            "cells": shrunk(cells[mine].astype("<u4")), "counts": shrunk(c[mine].astype("<u4")),
            "once": int((c[mine] == 1).sum()), "twice": int((c[mine] == 2).sum()),
        })
    for to in np.flatnonzero(np.diff(edges)).tolist():
        mine = slice(edges[to], edges[to + 1])
        out.append({"bucket": bucket, "to": to, "words": ascending(vocabulary[mine]), "sums": shrunk(sums[mine])})
    return out


def _pairs_seated(number: int, discount: float):
    """Cogroup function: draws the tables of a bucket's pairs, given the words' probabilities and the tables before."""

    def seat(known: pa.Table, answers: pa.Table) -> pa.Table:
        rows = known.to_pylist()
        before = {r["part"]: r["tables"] for r in rows if r["tables"] is not None}
        by = sorted(answers.to_pylist(), key=lambda r: r["to"])
        each = [grown(r["p"], "<f8") for r in by]
        base = np.log(np.concatenate(each))
        sums, out = np.zeros(len(base), np.int64), []
        for row in sorted((r for r in rows if r["cells"] is not None), key=lambda r: r["part"]):
            cells, counts, sizes = (grown(row[k]) for k in ("cells", "counts", "sizes"))
            context = np.repeat(np.arange(len(sizes)), sizes)
            laid = np.bincount(context, grown(before[row["part"]]) if before else None)  # a table each at first
            rng = np.random.default_rng([number, row["part"], 2])
            tables = draw_tables(
                counts.astype(np.int64), base[cells], STRENGTH + discount * laid[context], discount, rng
            )
            sums += np.bincount(cells, tables, len(base)).astype(np.int64)
            out.append({"bucket": row["bucket"], "part": row["part"], "tables": shrunk(tables.astype("<u4"))})
        parts = np.split(sums.astype("<u4"), np.cumsum([len(x) for x in each])[:-1])
        out += [{"bucket": r["bucket"], "to": r["to"], "sums": shrunk(x)} for r, x in zip(by, parts, strict=True)]
        return _table(out, _SEATS)

    return seat


def _replied(discount: float, end: float):
    """Cogroup function: for each slice the words' counts and the scores of its pairs of a bucket."""

    def reply(asked: pa.Table, known: pa.Table) -> pa.Table:
        if not asked.num_rows:
            return _table([], _REPLIES)
        rows = sorted(known.to_pylist(), key=lambda r: -1 if r["to"] is None else r["to"])
        parts = sorted((r for r in rows if r["cells"] is not None), key=lambda r: r["part"])

        def joined(kind: str, blobs) -> np.ndarray:
            return np.concatenate([np.zeros(0, kind), *blobs])

        vocabulary = joined("<u8", (descended(r["words"]) for r in rows if r["words"] is not None))
        contexts = joined("<u8", (descended(r["contexts"]) for r in parts))
        context = np.repeat(np.arange(len(contexts)), joined("<u4", (grown(r["sizes"]) for r in parts)))
        # previous words by hash, and words
        room = np.argsort(contexts)
        contexts, place = contexts[room], np.empty(len(room), np.int64)
        place[room] = np.arange(len(room))
        by = np.argsort(vocabulary)
        rank = np.empty(len(by), np.int64)
        rank[by] = np.arange(len(by))
        context = place[context]
        cell = context * len(by) + rank[joined("<u4", (grown(r["cells"]) for r in parts))]
        order = np.argsort(cell)
        cell, context = cell[order], context[order]
        counts = joined("<u4", (grown(r["counts"]) for r in parts)).astype(np.int64)[order]
        guests = np.bincount(context, counts, len(contexts))
        word_count = joined("<i8", (grown(r["word_counts"], "<i8") for r in rows if r["word_counts"] is not None))[by]
        kept = []
        for number in sorted({r["number"] for r in rows if r["p"] is not None}):
            tables = sorted((r for r in rows if r["number"] == number and r["tables"] is not None), key=lambda r: r["part"])
            t = joined("<u4", (grown(r["tables"]) for r in tables))[order]
            p = joined("<f8", (grown(r["p"], "<f8") for r in rows if r["number"] == number and r["p"] is not None))
            kept.append((counts - discount * t, np.bincount(context, t, len(contexts)), p[by]))
        ordered, owns, out = vocabulary[by], [own for own, *_ in kept], []
        for ask in _rows_of(asked):
            wanted, many = descended(ask["contexts"]), grown(ask["sizes"])
            w = np.searchsorted(ordered, descended(ask["words"]))[grown(ask["cells"])]
            room = np.minimum(np.searchsorted(contexts, wanted), max(len(contexts) - 1, 0))
            there = contexts[room] == wanted if len(contexts) else np.zeros(len(wanted), bool)
            key = np.repeat(np.where(there, room, -1), many) * len(by) + w
            total = np.zeros(len(w))
            for (_, laid, p), seated in zip(kept, _found(cell, key, *owns), strict=True):
                all_, tables = (np.where(there, x[room] if len(x) else 0, 0) for x in (guests, laid))
                share = (STRENGTH + discount * tables) / (STRENGTH + all_)
                total += seated / (STRENGTH + np.repeat(all_, many)) + np.repeat(share, many) * p[w]
            score = np.log10(total / len(kept) * (1 - end))
            out.append({
                "slice": ask["slice"], "bucket": ask["bucket"],
                "counts": shrunk(word_count[w].astype("<i8")), "scores": shrunk(score.astype("<f8")),
            })
        return _table(out, _REPLIES)

    return reply


_REPLIES = {"slice": pa.int64(), "bucket": pa.int32(), "counts": pa.binary(), "scores": pa.binary()}


def _scored(total: int, kinds: int, ends: int, end: float):
    """Cogroup function: the scores of a slice's documents from its pairs' replies."""

    def score(docs: pa.Table, answers: pa.Table) -> pa.Table:
        (row,) = docs.to_pylist()
        by = sorted(answers.to_pylist(), key=lambda r: r["bucket"])
        count = np.concatenate([np.zeros(0, np.int64), *(grown(r["counts"], "<i8") for r in by)])
        value = np.concatenate([np.zeros(0), *(grown(r["scores"], "<f8") for r in by)])
        n = np.array(row["tokens"], np.int64)
        code = unpack(row["control"], row["data"], int((n - 1).sum()))
        edges = np.append(0, np.cumsum(n))

        def summed(values: np.ndarray, last: float) -> np.ndarray:
            return np.add.reduceat(np.insert(values[code], np.cumsum(n - 1), last), edges[:-1])

        def base(count):
            return np.log10((count + 1) / (total + 1 * (kinds + 1)))

        return pa.table(
            {
                "doc_id": pa.array(row["doc_ids"], pa.int64()),
                "held_out": pa.array(row["held"], pa.bool_()),
                "n_tokens": pa.array(n),
                "n_known": pa.array(summed((count > 0).astype(np.int64), int(ends > 0))),
                "train_tokens": pa.array(np.full(len(n), total, np.int64)),
                "base_score": pa.array(summed(base(count), base(ends))),
                "score": pa.array(summed(value, np.log10(end))),
            }
        )

    return score


_RESULT = (
    "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
    "base_score double, score double"
)


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _written(df: DataFrame, name: str, keep: bool = True) -> DataFrame:
    """``saved``, and the shuffle files it took are removed at once: the pairs' are large."""
    conf = df.sparkSession.conf
    before = conf.get(_CLEANUP, None)
    conf.set(_CLEANUP, "true")
    try:
        return saved(df, name, keep)
    finally:
        conf.unset(_CLEANUP) if before is None else conf.set(_CLEANUP, before)


def _letters_seated(seated: DataFrame, number: int, before: tuple | None, rng: np.random.Generator):
    """A sweep over the letters' restaurants, from the words' tables.

    The words with their probabilities by letters, the probability of no letters, and the
    state for the next sweep: the shorter contexts, and the table of those of three letters.
    """
    spark = seated.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    old, old_third = before or (Letters(), None)
    cells = _written(
        seated.select("bucket", "words", "sizes", "tables").mapInArrow(_letter_counts, "bucket int, cell bigint, n bigint"),
        "py-cells", keep=False,
    )
    part = F.pmod(F.hash(F.shiftright("cell", 8)), F.lit(buckets)).alias("part")
    totals = _written(cells.groupBy("cell").agg(F.sum("n").alias("n")).select(part, "cell", "n"), "py-letters", keep=False)
    seen = totals.agg(F.count(F.when(F.col("n") == 1, 1)).alias("once"), F.count(F.when(F.col("n") == 2, 1)).alias("twice"))
    discount = _discount(seen.first(), 0.9)
    ref = spark.sparkContext.broadcast(Third(number, old, discount))
    previous = old_third if old_third is not None else spark.createDataFrame([], _THIRD)
    third = _written(
        totals.groupBy("part").cogroup(previous.groupBy("part")).applyInArrow(_third_seated(ref), _THIRD), "py-third", keep=False
    )
    drop(totals)
    if old_third is not None:
        drop(old_third)
    shorter = F.col("cell").bitwiseAND(F.lit((1 << 24) - 1)).alias("cell")
    got = third.groupBy(shorter).agg(F.sum("tables").alias("n")).toArrow()
    cell, n = got["cell"].to_numpy(), got["n"].to_numpy()
    by = np.argsort(cell)
    now = seat_letters(old, None, (cell[by], n[by]), rng)
    ref = spark.sparkContext.broadcast(Third(number, now, discount))
    p = third.mapInArrow(_third_probability(ref), "cell bigint, p double")
    end = p.where(F.col("cell") == int(_NO_LETTERS[0])).first()
    no_letters = float(end["p"] if end else now.probability(_NO_LETTERS)[0])
    spelled_ = _written(
        seated.groupBy("bucket").cogroup(cells.join(p, "cell").select("bucket", "cell", "p").groupBy("bucket")).applyInArrow(
            _spelled(no_letters), _WORDS
        ),
        "py-spelled", keep=False,
    )
    drop(cells)
    return spelled_, no_letters, (now, third)


def scores(docs: DataFrame, held_out, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Score every text by a model of those that the boolean column ``held_out`` does not mark."""
    spark = docs.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.coalesce(held_out, F.lit(False)).alias("held"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    table = _written(
        rows.mapInArrow(_read(buckets, False), _READ_SCHEMA).groupBy("bucket").applyInArrow(_merged(buckets), _MERGED_SCHEMA),
        "py-merged", keep=False,
    )
    corpus_words, pairs = table.where("v is not null"), table.where("contexts is not null")
    asked = table.where("to is not null").select("bucket", "to", "words", "sums")
    sums = corpus_words.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n", "v", "ends"))).first()
    words_ = corpus_words.select("bucket", "words", "sizes", "counts")
    # of pairs that occur once and twice
    pair_discount = _discount(pairs.agg(F.sum("once").alias("once"), F.sum("twice").alias("twice")).first(), 0.95)
    rng = np.random.default_rng(20240229)
    letters, laid, discount, no_letters = None, 0, 0.5, 0.0
    seats, kept = None, []
    for number in range(SWEEPS + 1):
        sent = asked
        if seats is not None:
            sent = asked.unionByName(seats.where("to is not null").select("bucket", "to", "sums"), allowMissingColumns=True)
        ref = spark.sparkContext.broadcast(Sweep(number, laid, discount))
        seated = _written(
            words_.groupBy("bucket").cogroup(sent.groupBy("to")).applyInArrow(_seated(ref), _WORDS), "py-seated", keep=False
        )
        got = seated.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n_customers", "n_tables", "once", "twice"))).first()
        laid = got["n_tables"]
        if number == 0:
            discount = _discount(got, 0.95)
        if number:
            drop(words_)
        plain = seated
        words_, no_letters, letters = _letters_seated(plain, number, letters, rng)
        drop(plain)
        ref = spark.sparkContext.broadcast(Sweep(number, laid, discount))
        keep, last, unknown = number > BURN, number == SWEEPS, 1.0
        if keep:
            mass = words_.select("sizes", "counts", "base").mapInArrow(_known_mass, "mass double")
            known = min(mass.agg(F.sum("mass")).first()[0] or 0.0, 1 - 1e-9)
            unknown = (STRENGTH + discount * laid) / (STRENGTH + got["n_customers"]) * (1 - known)
        answers = words_.groupBy("bucket").cogroup(asked.groupBy("to")).applyInArrow(
            _answered(ref, got["n_customers"], unknown, last), _ANSWERS_SCHEMA
        )
        if keep:
            answers = _written(answers, "py-answers", keep=False)
            kept.append((number, seats, answers))
        if last:
            break
        before = pairs.select("bucket", "part", "sizes", "cells", "counts")
        if seats is not None:
            before = before.unionByName(
                seats.where("tables is not null").select("bucket", "part", "tables"), allowMissingColumns=True
            )
        else:
            before = before.withColumn("tables", F.lit(None).cast("binary"))
        after = _written(
            before.groupBy("bucket").cogroup(answers.groupBy("bucket")).applyInArrow(
                _pairs_seated(number + 1, pair_discount), _SEATS_SCHEMA
            ),
            "py-seats", keep=False,
        )
        if seats is not None and not keep:
            drop(seats)
        seats = after
    drop(words_)
    drop(letters[1])
    end = float((sums["ends"] + STRENGTH * no_letters) / (sums["n"] + STRENGTH))
    model = pairs.select("bucket", "part", "contexts", "sizes", "cells", "counts").unionByName(
        asked.select("bucket", "to", "words"), allowMissingColumns=True
    )
    for number, tables, answers in kept:
        for part in (tables.where("tables is not null").select("bucket", "part", "tables"), answers):
            model = model.unionByName(part.withColumn("number", F.lit(number)), allowMissingColumns=True)
    turn = F.pmod(F.xxhash64("doc_id", "text"), F.lit(ROUNDS))
    done = [
        _scores_of(rows.where(turn == k), model, buckets, _replied(pair_discount, end), _scored(sums["n"], sums["v"], sums["ends"], end))
        for k in range(ROUNDS)
    ]
    for part in (table, *(x for _, tables, answers in kept for x in (tables, answers))):
        drop(part)
    return reduce(DataFrame.unionByName, done)


def _scores_of(rows: DataFrame, model: DataFrame, buckets: int, reply, score) -> DataFrame:
    """Scores of some texts by the corpus's pairs; written."""
    read = _written(rows.mapInArrow(_read(buckets, True), _READ_SCHEMA), "py-read", keep=False)
    asked = read.where("contexts is not null").select("slice", "bucket", "contexts", "words", "sizes", "cells")
    replies = _written(
        asked.groupBy("bucket").cogroup(model.groupBy("bucket")).applyInArrow(
            reply, "slice bigint, bucket int, counts binary, scores binary"
        ),
        "py-replies", keep=False,
    )
    texts = read.where("doc_ids is not null").select("slice", "doc_ids", "held", "tokens", "control", "data")
    result = _written(texts.groupBy("slice").cogroup(replies.groupBy("slice")).applyInArrow(score, _RESULT), "py-scores")
    drop(read)
    drop(replies)
    return result


def _discount(seen, most: float) -> float:
    """Estimated from how many dishes have one and two customers."""
    return float(np.clip(seen["once"] / (seen["once"] + 2 * seen["twice"]) if seen["once"] else 0.5, 0.1, most))
