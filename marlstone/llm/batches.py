"""Arrow batches of texts: bounded slices, byte classes, words and their hashes."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from contextlib import suppress
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Text bytes worked on at once. One longer text is a slice of its own.
SLICE_BYTES = 1 << 19
#: What separates words: the space and 0x09 to 0x0D.
WHITE = b" \t\n\x0b\x0c\r"

_IS_WHITE = np.zeros(256, bool)
_IS_WHITE[list(WHITE)] = True
_MULTIPLIER = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def as_utf8(column: pa.Array) -> pa.Array:
    """A text column as large_string; null stays null."""
    return column if pa.types.is_large_string(column.type) else column.cast(pa.large_string())


def slices(batch: pa.RecordBatch, text: str) -> Iterator[pa.RecordBatch]:
    """Consecutive slices with at most SLICE_BYTES of text, one row at least."""
    if batch.num_rows == 0:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(text))), 0).to_numpy(zero_copy_only=False)
    offsets = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    at = 0
    while at < batch.num_rows:
        upto = int(np.searchsorted(offsets, offsets[at] + SLICE_BYTES, side="right")) - 1
        upto = min(max(upto, at + 1), batch.num_rows)
        yield batch.slice(at, upto - at)
        at = upto


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column end to end, and the n + 1 offsets; null counts as empty."""
    if column.null_count:
        column = column.fill_null("")
    column = as_utf8(column)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    base = int(offsets[0])
    size = int(offsets[-1]) - base
    bytes_ = np.frombuffer(data, np.uint8)[base : base + size] if size else np.zeros(0, np.uint8)
    return bytes_, offsets - base


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and for each text the index of its first word (n + 1)."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = ~_IS_WHITE[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:]
    cuts = offsets[1:-1]  # a text's first byte starts a word, even after another text's word
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    begins[cuts] |= inside[cuts]
    closes[cuts - 1] |= inside[cuts - 1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(closes) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(29))


def powers(n: int, base: int = _MULTIPLIER) -> np.ndarray:
    """base**0 .. base**(n-1), modulo 2**64."""
    out = np.full(max(n, 1), base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)[:n]


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    sizes = ends - starts
    flat = np.arange(int(sizes.sum()), dtype=np.int64)
    heads = np.cumsum(sizes) - sizes
    inner = flat - np.repeat(heads, sizes)
    taken = data[inner + np.repeat(starts, sizes)].astype(np.uint64) + np.uint64(1)
    taken *= powers(int(sizes.max()))[inner]
    return mix(np.add.reduceat(taken, heads) + sizes.astype(np.uint64))


def inverse(base: int = _MULTIPLIER) -> int:
    return pow(base, -1, 1 << 64)


def window_hashes(h: np.ndarray, width: int) -> np.ndarray:
    """The hash of h[i : i + width] for every i where it fits, else of what is left; callers mask those."""
    n = len(h)
    if not n:
        return np.zeros(0, np.uint64)
    scaled = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * powers(n), dtype=np.uint64)])
    upto = np.minimum(np.arange(n) + width, n)
    return mix((scaled[upto] - scaled[:-1]) * powers(n, inverse()))


def replace_columns(df: DataFrame, new: list[T.StructField]) -> T.StructType:
    """The schema of ``df`` with ``new`` at its end; a column of the same name gives way."""
    taken = {f.name.lower() for f in new}
    return T.StructType([f for f in df.schema if f.name.lower() not in taken] + new)


def give_back() -> None:
    """Freed memory goes back to the system, so that idle workers stay small."""
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):  # only the GNU C library has it
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def map_texts(df: DataFrame, text: str, new: list[T.StructField], make: Callable[[], Callable[[pa.RecordBatch], dict[str, Any]]], keep: Callable[[dict[str, Any]], Any] | None = None, without: tuple[str, ...] = ()) -> DataFrame:
    """Append columns computed from whole texts, row by row, in bounded slices.

    ``make`` runs once a task and gives a function from a slice to arrays by name; columns
    of ``new`` replace those of the same name. ``keep`` gives a mask of the rows to keep.
    Columns ``without`` are read but not given back.
    """
    schema = T.StructType([f for f in replace_columns(df, new) if f.name not in without])
    names = [f.name for f in schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for part in slices(batch, text):
                made = work(part)
                out = pa.RecordBatch.from_arrays([made[n] if n in made else part.column(part.schema.get_field_index(n)) for n in names], names=names)
                yield out if keep is None else out.filter(pa.array(keep(made)))
            give_back()

    return df.mapInArrow(run, schema)
