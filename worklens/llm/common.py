"""Shared helpers: tables in the shared folder, Arrow text as numpy arrays, hashing.

Tables that cut a lineage are written to the folder the session names in
``spark.checkpoint.dir``; only a local session without one gets a temporary
folder. ``drop`` removes a table once nothing reads it; those that a lazy result
still needs are removed when the program ends.
"""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import tempfile
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

#: Text bytes worked on at once in a task; bounds the memory of the numpy arrays.
SLICE_BYTES = 2_000_000

_LEFT: list[tuple[SparkSession, str]] = []


# --- tables in the shared folder -------------------------------------------------


def shared_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``; a temporary one in local tests."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="worklens-llm-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/worklens-llm/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str, keep: bool = True) -> DataFrame:
    """Write ``df`` to the shared folder and go on from its files.

    ``keep`` leaves the table to the end of the program, for lazy results;
    otherwise the caller drops it.
    """
    spark, path = df.sparkSession, fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    if keep:
        _LEFT.append((spark, path))
    back = spark.read.schema(df.schema).parquet(path)
    back._worklens_path = path
    return back


def drop(df: DataFrame) -> None:
    """Remove a table made by ``saved(.., keep=False)``."""
    remove(df.sparkSession, df._worklens_path)


def remove(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


@atexit.register
def _drop_left() -> None:
    for spark, path in _LEFT:
        try:
            remove(spark, path)
        except Exception:  # the session is gone, and its folder is the owner's
            return


# --- Arrow text as arrays --------------------------------------------------------


def filled(column: pa.Array) -> pa.Array:
    """The column as large strings, nulls as empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.fill_null(column.cast(pa.large_string()), "")


def give_back() -> None:
    """Return freed memory to the system: Python workers live on from one stage to the next.

    The tables of powers, as long as the longest text so far, go too and are made anew when needed.
    """
    _powers[:] = _NO_POWERS
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only glibc has it
        ctypes.CDLL(None).malloc_trim(0)


def slices(batches: Iterable[pa.RecordBatch], text: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches into runs of rows with about ``most`` bytes of text, one row at least.

    At the end of the batches, memory that the task no longer uses is given back; at their
    beginning, what the worker's task before left.
    """
    give_back()
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        total = np.cumsum(size)
        at = 0
        while at < batch.num_rows:
            base = total[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(total, base + most, "right")))
            yield batch.slice(at, end - at)
            at = end
    give_back()


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All UTF-8 bytes of a string column in one array, and each row's offsets in it."""
    column = filled(column)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or at[-1] == at[0]:
        return np.zeros(0, np.uint8), np.zeros(len(at), np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def byte_set(*chars: int) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(chars)] = True
    return table


#: The bytes 09-0D and 20.
SPACE = byte_set(0x20, *range(0x09, 0x0E))
#: Everything in ASCII but letters and digits; bytes of longer characters belong to words.
NOT_ALNUM = byte_set(
    *(c for c in range(128) if not (48 <= c < 58 or 65 <= c < 91 or 97 <= c < 123))
)
#: Lower-cases A-Z only.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def words(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray = SPACE):
    """Starts and ends of the words in the bytes, and each row's range of words."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = ~separators[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True  # a row's end ends a word
    first = inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:n]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | edge[1:n]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets)


# --- hashing ---------------------------------------------------------------------

_BASE = 0x9E3779B97F4A7C15
_NO_POWERS = (np.ones(1, np.uint64), np.ones(1, np.uint64))
_powers = list(_NO_POWERS)


def powers(n: int) -> list[np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64, ``n`` at least."""
    if len(_powers[0]) < n:
        size = max(n + n // 8, 1 << 16)  # the next text may be a little longer
        for i, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            _powers[i] = np.cumprod(table, dtype=np.uint64)
    return _powers


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers; one-to-one."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Sums from which ``span_hashes`` takes the hash of any byte range."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(len(data))[0][: len(data)], out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte ranges, equal for equal bytes wherever they stand."""
    inverse = powers(len(sums))[1]
    h = (sums[ends] - sums[starts]) * inverse[starts]
    return mixed(h + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return span_hashes(prefix_sums(data), starts, ends)


def signed(h: np.ndarray) -> np.ndarray:
    """As the signed 64-bit numbers of a Spark long."""
    return h.view(np.int64)


def lists(values: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column from flat values."""
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))
