"""Which tokens of two tokenizers cover the same bytes of a text.

Both tokenizers cut a space and the text into tokens: ``byte_bpe`` (A) by entries that
are decoded byte by byte, ``piece_bpe`` (B) by pieces in which U+2581 is a space and
<0xHH> a byte. All tokens of both, of some documents at once, are sorted by their start
(``lexsort``); the running maximum of their ends (``maximum.accumulate``) is reached by
a start exactly where both cut, and there a group begins. Inside a group an A and a B token
are linked where their ranges overlap: at every start one of each is open.

How often a pair of ids is linked is counted over all documents. Each slice of
documents is a block of its own, with a list of its distinct pairs; links are
numbers in that list. Pairs of blocks are added up by a shuffle, joined back to the
blocks, and come together with a block's documents, so no task holds more than
a block at a time. That a pair is in every block, like the most frequent words', is a row for each block.

Special tokens' strings inside texts are plain text. Null and empty texts, and those
whose tokens of A or B do not spell out space and text (a text with U+2581,
for example) have no tokens: zeros, and an empty digest. A text of any length
is aligned whole; its memory is that of its tokens. Rows with repeated or null ids are
aligned each for itself, and their links counted each. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import filled, saved, slices, text_bytes
from .tokens import blank_before, spread

#: Bytes of segments and their ids that a worker keeps; beyond, only those of the texts at hand stay.
KEPT_BYTES = 64_000_000
_ENTRY = 200  # bytes of a short string, its place in a dictionary, and its ids
#: Segments handed to a tokenizer at once, whose encodings are large.
ENCODE_SEGMENTS = 10_000

_SUMS = ("n_a", "n_b", "n_groups", "n_links")


def _byte_of() -> dict[str, int]:
    """The bytes that the characters of byte-level entries stand for.

    Fixed rule of such vocabularies: printable bytes are themselves, the others the
    characters from 256 on, in ascending order.
    """
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}


class Ids:
    """Ids of segments end to end, growing."""

    def __init__(self):
        self.ids, self.ends = np.zeros(1 << 12, np.uint32), np.zeros(1 << 10, np.int64)
        self.n = 0

    def add(self, ids: np.ndarray, sizes: np.ndarray) -> None:
        last = int(self.ends[self.n])
        end = last + len(ids)
        while end > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while self.n + len(sizes) >= len(self.ends):
            self.ends = np.concatenate([self.ends, np.zeros_like(self.ends)])
        self.ids[last:end] = ids
        self.ends[self.n + 1 : self.n + len(sizes) + 1] = last + np.cumsum(sizes)
        self.n += len(sizes)

    def of(self, places: np.ndarray) -> np.ndarray:
        """The ids of all ``places``, end to end."""
        first = self.ends[places]
        return self.ids[spread(first, self.ends[places + 1] - first)]


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Lists end to end, and their sizes."""
    sizes = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter(chain.from_iterable(lists), np.uint32, int(sizes.sum())), sizes


class Pair:
    """Both tokenizers, and the ids of the segments met so far."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task per core
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=path_b)
        byte_of = _byte_of()
        entries = self.a.get_vocab(with_added_tokens=True)
        self.bytes_a = [b""] * (max(entries.values()) + 1)
        for entry, i in entries.items():
            if all(c in byte_of for c in entry):
                self.bytes_a[i] = bytes(byte_of[c] for c in entry)
        self.bytes_b = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            self.bytes_b.append(
                bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()
            )
        self.space = self.b.piece_to_id("▁")
        self.widths = [np.array([len(x) for x in side], np.int64) for side in (self.bytes_a, self.bytes_b)]
        self.forget()

    def forget(self) -> None:
        self.place: dict[str, int] = {}
        self.ids = Ids(), Ids()
        self.right = np.zeros(1 << 10, bool)
        self.kept_bytes = 0

    def _learn(self, segments: list[str], in_a_row: bool) -> None:
        """Ids of new segments. In a row, A gets them as one text that it cuts where they meet."""
        for k in range(0, len(segments), ENCODE_SEGMENTS):
            part = segments[k : k + ENCODE_SEGMENTS]
            raw = [s.encode() for s in part]
            size = np.fromiter(map(len, raw), np.int64, len(raw))
            made = self.a.encode_batch_fast(["".join(part)] if in_a_row else part, add_special_tokens=False)
            if in_a_row:
                a = np.array(made[0].ids, np.uint32)
                ends = np.cumsum(self.widths[0][a])
                n_a = np.diff(np.searchsorted(ends, np.cumsum(size)) + 1, prepend=0)
            else:
                a, n_a = _flat([e.ids for e in made])
            # B puts a space in front, which every segment already has.
            made = self.b.encode([s[1:] for s in part], num_threads=1)
            b, n_b = _flat([x if len(s) > 1 else [self.space] for s, x in zip(part, made, strict=True)])
            n = self.ids[0].n
            while n + len(part) > len(self.right):
                self.right = np.concatenate([self.right, np.zeros_like(self.right)])
            self.right[n : n + len(part)] = self._spelled(0, a, n_a, raw, size) & self._spelled(1, b, n_b, raw, size)
            self.place.update(zip(part, range(n, n + len(part)), strict=True))
            self.ids[0].add(a, n_a)
            self.ids[1].add(b, n_b)
            self.kept_bytes += _ENTRY * len(part) + int(size.sum()) + 4 * (len(a) + len(b))

    def _spelled(self, side: int, ids: np.ndarray, n: np.ndarray, raw: list[bytes], size: np.ndarray) -> np.ndarray | bool:
        """Whether the tokens of each segment make its bytes."""
        bytes_of = (self.bytes_a, self.bytes_b)[side]
        made = [bytes_of[i] for i in ids.tolist()]
        at = np.append(0, np.cumsum(n))
        total = np.append(0, np.cumsum(self.widths[side][ids]))[at]
        if (np.diff(total) == size).all() and b"".join(made) == b"".join(raw):
            return True
        return np.array([b"".join(made[i:j]) == x for i, j, x in zip(at[:-1], at[1:], raw, strict=True)])

    def _keep_only(self, segments: list[str]) -> None:
        """Forget all segments but these."""
        kept = [s for s in segments if s in self.place]
        at = np.fromiter(map(self.place.__getitem__, kept), np.int64, len(kept))
        former, right = self.ids, self.right[at]
        self.forget()
        for new, old in zip(self.ids, former, strict=True):
            ids = old.of(at)
            new.add(ids, old.ends[at + 1] - old.ends[at])
            self.kept_bytes += 4 * len(ids)
        self.place = dict(zip(kept, range(len(kept)), strict=True))
        self.right = np.append(right, np.zeros(1, bool))
        self.kept_bytes += sum(_ENTRY + len(s) for s in kept)

    def places(self, segments: list[str]) -> np.ndarray:
        if self.kept_bytes > KEPT_BYTES:
            self._keep_only(segments)
        get = self.place.get
        new = [s for s in segments if get(s) is None]
        # Those that end in white space would be cut otherwise with a space behind them.
        closed = [not (s[-1].isspace() or s[-1] in "\x1c\x1d\x1e\x1f") for s in new]
        self._learn([s for s, c in zip(new, closed, strict=True) if c], True)
        self._learn([s for s, c in zip(new, closed, strict=True) if not c], False)
        return np.fromiter(map(get, segments), np.int64, len(segments))

    def tokens(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of A and of B of all texts, end to end, and the bytes of each text they cover."""
        size = pc.binary_length(column).to_numpy(zero_copy_only=False)
        empty, space = pa.scalar("", pa.large_string()), pa.scalar(" ", pa.large_string())
        texts = pc.binary_join_element_wise(empty, column, space)
        data, first = text_bytes(pc.if_else(pa.array(size > 0), texts, empty))
        spot = np.flatnonzero(data == 0x20)
        spot = spot[spot > 0]
        cut = np.zeros(len(data) + 1, bool)
        cut[spot[~blank_before(data, spot)]] = True
        cut[first] = True
        bounds = np.flatnonzero(cut)  # the last one is the end
        if len(bounds) < 2:
            return np.zeros(0, np.uint32), np.zeros(0, np.uint32), np.zeros(len(column), np.int64)
        segments = pa.LargeStringArray.from_buffers(
            len(bounds) - 1, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(data))
        ).dictionary_encode()
        places = self.places(segments.dictionary.to_pylist())[segments.indices.to_numpy()]
        # A text with a segment that one of them spells otherwise has no tokens.
        wrong = np.append(0, np.cumsum(~self.right[places]))
        at = np.searchsorted(bounds, first)
        good = wrong[at[1:]] == wrong[at[:-1]]
        places = places[np.repeat(good, np.diff(at))]
        return self.ids[0].of(places), self.ids[1].of(places), np.where(good, np.diff(first), 0)


@lru_cache(1)
def pair(path_a: str, path_b: str) -> Pair:
    return Pair(path_a, path_b)


class Aligned:
    """Groups and links of the tokens of some texts."""

    def __init__(self, both: Pair, column: pa.Array):
        a, b, sizes = both.tokens(column)
        self.first = np.append(0, np.cumsum(sizes))  # of each text, among the bytes covered
        ends = [np.cumsum(width[ids]) for ids, width in zip((a, b), both.widths, strict=True)]
        start = np.concatenate([e - width[ids] for e, ids, width in zip(ends, (a, b), both.widths, strict=True)])
        end = np.concatenate(ends)
        ids = np.concatenate([a, b]).astype(np.int64)
        side = np.repeat(np.array([0, 1], np.int8), [len(a), len(b)])
        order = np.lexsort((side, start))
        start, end, self.ids, self.side = start[order], end[order], ids[order], side[order]
        begins = np.ones(len(start), bool)
        begins[1:] = start[1:] >= np.maximum.accumulate(end)[:-1]
        self.group = np.cumsum(begins) - 1
        # The A and the B token that are open at each start, once both of that start are read.
        last = np.ones(len(start), bool)
        last[:-1] = start[1:] != start[:-1]
        open_a = np.cumsum(self.side == 0)[last] - 1
        open_b = np.cumsum(self.side == 1)[last] - 1
        self.links = a[open_a].astype(np.int64), b[open_b].astype(np.int64)
        self.start = start
        # Each text's tokens, groups and links lie in a run.
        self.tokens_of = np.searchsorted(start, self.first)
        self.links_of = np.searchsorted(start[last], self.first)
        self.sums = [
            np.diff(np.append(0, np.cumsum(flags))[self.tokens_of]) for flags in (self.side == 0, self.side == 1, begins)
        ] + [np.diff(self.links_of)]

    def written(self) -> tuple[bytes, np.ndarray]:
        """``a1,a2|b1;a3|b2,b3`` of every text, end to end, and where each one's begins."""
        n = len(self.ids)
        if not n:
            return b"", np.zeros(len(self.first), np.int64)
        order = np.argsort(2 * self.group + self.side, kind="stable")
        ids, side, group = self.ids[order], self.side[order], self.group[order]
        digits = len(str(int(ids.max())))
        shown = np.zeros((n, digits + 1), np.uint8)
        used = np.ones((n, digits + 1), bool)
        rest = ids
        for k in range(digits - 1, -1, -1):
            shown[:, k] = 48 + rest % 10
            if k < digits - 1:
                used[:, k] = rest > 0
            rest = rest // 10
        mark = np.full(n, ord(","), np.uint8)
        mark[:-1][side[1:] != side[:-1]] = ord("|")
        mark[:-1][group[1:] != group[:-1]] = ord(";")
        shown[:, digits] = mark
        ends = self.tokens_of[1:][np.diff(self.tokens_of) > 0] - 1
        used[ends, digits] = False
        at = np.append(0, np.cumsum(used.sum(axis=1)))
        return shown[used].tobytes(), at[self.tokens_of]


_DOC = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, groups string"


def align(
    docs: DataFrame, path_a: str, path_b: str, doc_id: str = "doc_id", text: str = "text", groups: bool = False
) -> DataFrame:
    """Of every row the numbers of its tokens, groups and links, and how its links fare in the corpus.

    ``n_best`` counts the links whose pair of ids is, over all documents, linked as
    often as any with that B id; ``count_sum`` adds up how often the pairs of all links are
    linked. ``groups`` adds the groups themselves as text, ``a1,a2|b1;a3|b2``.
    """

    def aligned(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = pair(path_a, path_b)
        width, block = len(both.bytes_b), TaskContext.get().partitionId() << 32
        for batch in slices(batches, "text"):
            made = Aligned(both, filled(batch.column("text")))
            raw, at = made.written()
            a, b = made.links
            pairs, links, times = np.unique(a * width + b, return_inverse=True, return_counts=True)
            n = batch.num_rows
            shas = [hashlib.sha256(raw[i:j]).hexdigest() if j > i else "" for i, j in zip(at[:-1], at[1:], strict=True)]
            shown = [raw[i:j].decode() for i, j in zip(at[:-1], at[1:], strict=True)] if groups else [None] * n
            packed = links.reshape(-1).astype("<u2" if len(pairs) <= 1 << 16 else "<u4")
            linked = [packed[i:j].tobytes() for i, j in zip(made.links_of[:-1], made.links_of[1:], strict=True)]
            empty = pa.nulls(n, pa.list_(pa.int64()))
            yield pa.record_batch(
                [
                    pa.array(np.full(n, block)),
                    batch.column("doc_id"),
                    *(pa.array(x.astype(np.int64)) for x in made.sums),
                    pa.array(shas, pa.string()),
                    pa.array(shown, pa.string()),
                    pa.array(linked, pa.binary()),
                    empty,
                    empty,
                ],
                names=names,
            )
            if len(pairs):
                rest = {"block": [block], "pairs": [pairs], "times": [times.astype(np.int64)]}
                yield pa.record_batch(
                    [pa.array(rest.get(name, [None]), kind) for name, kind in zip(names, kinds, strict=True)], names=names
                )
            block += 1

    schema = f"block bigint, {_DOC}, links binary, pairs array<bigint>, times array<bigint>"
    names = [column.split()[0] for column in schema.split(", ")]
    kinds = [
        pa.int64(), pa.int64(), *[pa.int64()] * 4, pa.string(), pa.string(), pa.binary(),
        pa.list_(pa.int64()), pa.list_(pa.int64()),
    ]
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    blocks = saved(rows.mapInArrow(aligned, schema), "aligned")
    width = len(pair(path_a, path_b).bytes_b)

    in_blocks = blocks.where(F.col("pairs").isNotNull()).select(
        "block", F.posexplode(F.arrays_zip("pairs", "times")).alias("link", "_")
    ).select("block", "link", F.col("_.pairs").alias("pair"), F.col("_.times").alias("times"))
    # A B id is linked with no more ids than A has: a bounded window.
    by_b = Window.partitionBy(F.col("pair") % width)
    counts = in_blocks.groupBy("pair").agg(F.sum("times").alias("n"))
    counts = counts.withColumn("best", F.col("n") == F.max("n").over(by_b))
    known = in_blocks.select(F.col("block").alias("of_block"), "link", "pair").join(counts, "pair")
    known = known.select("of_block", "link", "n", "best")

    def summed(left: pa.Table, right: pa.Table) -> pa.Table:
        """The documents of a block with what its pairs count."""
        order = np.argsort(right["link"].to_numpy())
        n = right["n"].to_numpy()[order]
        best = right["best"].to_numpy(zero_copy_only=False)[order]
        at = np.append(0, np.cumsum(left["n_links"].to_numpy()))
        number = np.frombuffer(b"".join(left["links"].to_pylist()), "<u2" if len(n) <= 1 << 16 else "<u4")
        columns = {c: left[c] for c in keep}
        for name, values in (("n_best", best.astype(np.int64)), ("count_sum", n)):
            total = np.append(0, np.cumsum(values[number])) if len(number) else np.zeros(1, np.int64)
            columns[name] = pa.array(total[at[1:]] - total[at[:-1]])
        return pa.table(columns)

    keep = ["doc_id", *_SUMS, "groups_sha256", "groups"]
    of_docs = blocks.where(F.col("pairs").isNull()).select("block", *keep, "links")
    out = f"{_DOC}, n_best bigint, count_sum bigint"
    done = of_docs.groupBy("block").cogroup(known.groupBy("of_block")).applyInArrow(summed, out)
    columns = ["doc_id", *_SUMS, "n_best", "count_sum", "groups_sha256"]
    return done.select(*columns, *(["groups"] if groups else []))
