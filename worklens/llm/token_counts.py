"""Count the tokens of whole texts by byte-pair merging, without making token ids.

A text's symbols form a linked list, and a heap holds the adjacent pairs that are
pieces of the model. The pair of the lowest rank, leftmost first, is popped and
merged until none is left; every merge takes one symbol away. A character the
model does not have stands for its UTF-8 bytes and never merges. So the count
is the number of initial symbols less the number of merges.

The model is a sentencepiece BPE model with byte fallback, an identity normalizer
and a space put in front of every text. No merge spans two neighbouring characters that
are neighbours in no piece (a space after a letter, say), so a text is cut there, and
the counts of its segments add up to its own. A Python worker keeps the counts of
segments it has met, up to ``KEPT_BYTES`` of them; a segment may be as long as the text.

Null text counts as empty: no bytes and no tokens. Texts of any length are
counted whole; their memory is that of the longest. Rows with repeated or null ids
are counted each for itself. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import filled, slices, text_bytes

#: Tokens that a text may have without being over the limit.
LIMIT = 4096
#: Bytes of segments and their counts that a worker keeps; beyond, it starts anew.
KEPT_BYTES = 32_000_000
_ENTRY = 160  # bytes of a short string, its place in a dictionary and a number

_SPACE = "▁"


class Merger:
    """Counts of merged segments under one model."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        special = (model.is_byte, model.is_control, model.is_unknown, model.is_unused)
        pieces = {
            model.id_to_piece(i): -model.get_score(i)
            for i in range(model.get_piece_size())
            if not any(test(i) for test in special)
        }
        self.rank = {piece: rank for piece, rank in pieces.items() if len(piece) > 1}
        # Numbers of the single characters; 0 for those of no piece.
        single = sorted(piece for piece in pieces if len(piece) == 1)
        number = {c: k for k, c in enumerate(single, 1)}
        self.letter = np.zeros(0x110000, np.uint16)
        self.letter[[ord(c) for c in single]] = np.arange(1, len(single) + 1)
        self.letter[0x20] = self.letter[ord(_SPACE)]
        self.joins = np.zeros((len(single) + 1, len(single) + 1), bool)
        for piece in self.rank:
            for a, b in zip(piece, piece[1:]):
                self.joins[number[a], number[b]] = True
        self.kept, self.kept_bytes = {}, 0

    def merges(self, symbols: str) -> int:
        """Pairs merged until no adjacent pair is a piece."""
        rank, n = self.rank, len(symbols)
        piece: list[str | None] = list(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []
        for i in range(n - 1):
            if (order := rank.get(symbols[i : i + 2])) is not None:
                heap.append((order, i, symbols[i : i + 2]))
        heapify(heap)
        done = 0
        while heap:
            _, i, pair = heappop(heap)
            left = piece[i]
            if left is None or (j := after[i]) >= n or len(left) + len(piece[j]) != len(pair):
                continue  # one of the two has been merged meanwhile
            piece[i], piece[j] = pair, None
            done += 1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (order := rank.get(pair + piece[k])) is not None:
                    heappush(heap, (order, i, pair + piece[k]))
            if (h := before[i]) >= 0 and (order := rank.get(piece[h] + pair)) is not None:
                heappush(heap, (order, h, piece[h] + pair))
        return done

    def count(self, segment: str) -> int:
        symbols = segment.replace(" ", _SPACE)
        if len(symbols) == 1:
            return 1 if self.letter[ord(symbols)] else len(segment.encode())
        return len(symbols) - self.merges(symbols)

    def counts(self, segments: pa.Array) -> np.ndarray:
        """Tokens of distinct segments."""
        out = np.zeros(len(segments), np.int64)
        kept = self.kept
        for k, segment in enumerate(segments.to_pylist()):
            n = kept.get(segment)
            if n is None:
                n = self.count(segment)
                size = _ENTRY + len(segment)
                if self.kept_bytes + size > KEPT_BYTES:
                    kept.clear()
                    self.kept_bytes = 0
                if size <= KEPT_BYTES:
                    kept[segment] = n
                    self.kept_bytes += size
            out[k] = n
        return out

    def tokens(self, column: pa.Array) -> np.ndarray:
        """Tokens of every text; no text is null."""
        size = pc.binary_length(column).to_numpy(zero_copy_only=False)
        # Every text gets the space in front; the tokens of empty texts are none.
        texts = pc.binary_join_element_wise(pa.scalar("", pa.large_string()), column, pa.scalar(" ", pa.large_string()))
        data, first = text_bytes(texts)
        points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
        letters = self.letter[points]
        # Places of the characters in the bytes.
        width = 1 + (points > 0x7F).astype(np.int8) + (points > 0x7FF) + (points > 0xFFFF)
        place = np.zeros(len(points) + 1, np.int64)
        np.cumsum(width, out=place[1:])
        cut = np.ones(len(points), bool)
        cut[1:] = ~self.joins[letters[:-1], letters[1:]]
        cut[np.searchsorted(place, first[:-1])] = True
        bounds = np.append(place[:-1][cut], place[-1])
        segments = pa.LargeStringArray.from_buffers(
            len(bounds) - 1, pa.py_buffer(bounds), pa.py_buffer(data)
        ).dictionary_encode()
        number = self.counts(segments.dictionary)[segments.indices.to_numpy()]
        total = np.append(0, np.cumsum(number))
        at = np.searchsorted(bounds, first)
        return np.where(size > 0, total[at[1:]] - total[at[:-1]], 0)


@lru_cache(1)
def merger(path: str) -> Merger:
    return Merger(path)


def count_tokens(
    docs: DataFrame, path: str, limit: int = LIMIT, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Of every row ``doc_id``, ``n_bytes``, ``n_tokens``, and whether these are more than ``limit``."""

    def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            column = filled(batch.column("text"))
            tokens = merger(path).tokens(column)
            yield pa.record_batch(
                [
                    batch.column("doc_id"),
                    pc.binary_length(column).cast(pa.int64()),
                    pa.array(tokens),
                    pa.array(tokens > limit),
                ],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(counted, "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean")
