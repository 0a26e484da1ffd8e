"""Views of Arrow text columns as bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all values, one after the other, and where each value begins and the last one ends; null is empty."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    begin = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[begin[0] : begin[-1]], begin - begin[0]


def values(column: pa.Array) -> Iterator[bytes]:
    """Each value's bytes."""
    data, begin = utf8(column)
    view = data.tobytes()
    for low, high in zip(begin[:-1].tolist(), begin[1:].tolist()):
        yield view[low:high]


def slices(batch: pa.RecordBatch, column: str, most_bytes: int) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows whose texts hold `most_bytes` at most, or of one row."""
    _, begin = utf8(batch.column(column))
    low, rows = 0, batch.num_rows
    while low < rows:
        high = max(low + 1, int(np.searchsorted(begin, begin[low] + most_bytes, "right")) - 1)
        yield batch.slice(low, high - low)
        low = high


_STEP = np.uint64(0x9E3779B97F4A7C15)


def mixed(h: np.ndarray) -> np.ndarray:
    """Hashes whose bits all depend on all bits of these."""
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def word_hashes(words: pa.Array) -> np.ndarray:
    """A 64-bit hash of each value; the empty one has its own."""
    data, begin = utf8(words)
    size = np.diff(begin)
    powers = np.cumprod(np.full(int(size.max(initial=0)) + 1, _STEP))
    place = np.arange(len(data)) - np.repeat(begin[:-1], size)
    out = np.zeros(len(size), np.uint64)
    if len(data):
        out[size > 0] = np.add.reduceat((data.astype(np.uint64) + np.uint64(1)) * powers[place], begin[:-1][size > 0])
    return mixed(out + size.astype(np.uint64))
