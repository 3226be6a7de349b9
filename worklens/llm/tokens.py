"""Whole texts to token ids, encoding each distinct word once per worker.

A text is cut in front of white space that follows something else than white
space, and in front of a punctuation mark that follows a letter of ASCII. Both
public BPE tokenizers used here split a text at such places before they merge,
and none of their special tokens has such a place inside, so the ids of the
pieces in a row are the ids of the text. A Python worker keeps the ids of pieces
it has met, up to ``KEPT_PIECES``.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import byte_set, give_back, text_bytes

#: Text bytes encoded at once.
ENCODE_BYTES = 4_000_000
#: Pieces handed to the tokenizer at once.
ENCODE_PIECES = 10_000
#: Pieces whose ids a worker keeps; beyond, it starts anew.
KEPT_PIECES = 1_000_000

_MARK = byte_set(*b".,;:!?()[]{}\"'*$%&#-/")
_CUT = byte_set(0x20, 0x0A) | _MARK
_ALPHA = byte_set(*range(65, 91), *range(97, 123))
_BLANK = byte_set(0x20, *range(0x09, 0x0E), *range(0x1C, 0x20))
#: First bytes of the three-byte characters among which Unicode's white space is.
_WIDE = byte_set(0xE1, 0xE2, 0xE3)
_AFTER_C2 = byte_set(0x85, 0xA0)


def blank_before(data: np.ndarray, spot: np.ndarray) -> np.ndarray:
    """Whether white space may stand before each ``spot``; true also for a few other characters."""
    before, two, three = data[spot - 1], data[np.maximum(spot - 2, 0)], data[np.maximum(spot - 3, 0)]
    return _BLANK[before] | (_AFTER_C2[before] & (two == 0xC2)) | _WIDE[three]


def piece_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where the pieces of all texts begin, and an empty piece at each text's end; ascending."""
    spot = np.flatnonzero(_CUT[data])
    spot = spot[spot > 0]
    spot = spot[np.where(_MARK[data[spot]], _ALPHA[data[spot - 1]], ~blank_before(data, spot))]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    texts = np.concatenate([offsets[:-1][offsets[:-1] < offsets[1:]], offsets[1:]])
    return np.sort(np.concatenate([spot[~edge[spot]], np.sort(texts)]), kind="stable")


def spread(first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers ``first .. first + size - 1`` of each run, end to end."""
    at = np.cumsum(sizes)
    return np.repeat(first - (at - sizes), sizes) + np.arange(at[-1] if len(at) else 0)


class Encoder:
    """Ids of pieces, each encoded once."""

    def __init__(self, path: str, end_id: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task per core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        give_back()  # the parsed file is several times the vocabulary's size
        self.end_id = end_id
        self.forget()

    def forget(self) -> None:
        # The empty piece stands for the end of a text.
        self.known = pa.array([""], pa.large_string())
        self.ids = np.array([self.end_id], np.uint32)
        self.ends = np.array([0, 1], np.int64)

    def learn(self, pieces: pa.Array) -> np.ndarray:
        """Places of the distinct ``pieces`` among the known ones."""
        if len(self.known) + len(pieces) > KEPT_PIECES + 1:
            self.forget()
        place = pc.index_in(pieces, value_set=self.known)
        if place.null_count:
            new = pieces.filter(pc.is_null(place))
            sizes, more = self._encoded(new)
            fresh = np.arange(len(self.known), len(self.known) + len(new))
            self.known = pa.concat_arrays([self.known, new])
            self.ids = np.concatenate([self.ids, more])
            self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(sizes)])
            at = pc.fill_null(place, -1).to_numpy().astype(np.int64)
            at[at < 0] = fresh
            return at
        return place.to_numpy().astype(np.int64)

    def _encoded(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of ids, and the ids end to end; some pieces at a time, as their encodings are large."""
        sizes, flat = [], []
        for k in range(0, len(pieces), ENCODE_PIECES):
            part = pieces.slice(k, ENCODE_PIECES).to_pylist()
            ids = [e.ids for e in self.tokenizer.encode_batch_fast(part, add_special_tokens=False)]
            sizes.append(np.fromiter(map(len, ids), np.int64, len(ids)))
            flat.append(np.fromiter((i for x in ids for i in x), np.uint32, int(sizes[-1].sum())))
        return np.concatenate(sizes), np.concatenate(flat)

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        data, offsets = text_bytes(column)
        starts = piece_starts(data, offsets)
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(1, np.int64)
        bounds = np.append(starts, len(data))
        texts = pa.LargeStringArray.from_buffers(
            len(starts), pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(data))
        ).dictionary_encode()
        codes = self.learn(texts.dictionary)[texts.indices.to_numpy()]
        first, sizes = self.ends[codes], self.ends[codes + 1] - self.ends[codes]
        # a text ends where its empty piece does
        closing = np.flatnonzero(bounds[:-1] == bounds[1:])
        return self.ids[spread(first, sizes)], np.append(0, np.cumsum(sizes)[closing])


_ENCODERS: dict[tuple[str, int], Encoder] = {}


def encode(column: pa.Array, path: str, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all rows end to end, each row's closed by ``end_id``, and the rows' offsets.

    Null and empty text give the end id alone.
    """
    if (path, end_id) not in _ENCODERS:
        _ENCODERS[path, end_id] = Encoder(path, end_id)
    return _ENCODERS[path, end_id].encode(column)
