"""Arrow text as numpy code-point arrays and back, without a string object per row."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that are worked on at once; a longer single text is a piece of its own, whole.
PIECE_BYTES = 2 << 20
#: All code points that are assigned or may become so, without the private planes.
ASSIGNED = (*range(0x33480), *range(0xE0000, 0xE01F0))


def column(array: pa.Array | pa.ChunkedArray) -> pa.Array:
    """One contiguous large_string array."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks() if array.num_chunks != 1 else array.chunk(0)
    return array.cast(pa.large_string())


def pieces(array: pa.Array, size: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``size`` bytes of text; each has at least one row."""
    ends = offsets(array)
    start = 0
    while start < len(array):
        stop = int(np.searchsorted(ends, ends[start] + size, side="right")) - 1
        stop = min(max(stop, start + 1), len(array))
        yield start, stop
        start = stop


def offsets(array: pa.Array) -> np.ndarray:
    return np.frombuffer(array.buffers()[1], np.int64)[array.offset : array.offset + len(array) + 1] if len(array) else np.zeros(1, np.int64)


def explode(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(code points, row starts): the text of all rows end to end; a null row is empty."""
    ends = offsets(array)
    data = array.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data is not None else np.zeros(0, np.uint8)
    points = np.frombuffer(raw.tobytes().decode("utf-8", "replace").encode("utf-32-le", "surrogatepass"), np.uint32)
    before = np.zeros(len(raw) + 1, np.int64)
    np.cumsum((raw & 0xC0) != 0x80, out=before[1:])
    return points, before[ends - ends[0]]


def implode(points: np.ndarray, starts: np.ndarray, nulls: np.ndarray | None = None) -> pa.Array:
    """The reverse: a large_string array; nulls is a mask of rows, or None."""
    data = points.astype("<u4").tobytes().decode("utf-32-le").encode("utf-8")
    width = 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)
    at = np.zeros(len(points) + 1, np.int64)
    np.cumsum(width, out=at[1:])
    valid = None if nulls is None or not nulls.any() else pa.py_buffer(np.packbits(~nulls, bitorder="little").tobytes())
    return pa.LargeStringArray.from_buffers(len(starts) - 1, pa.py_buffer(at[starts].tobytes()), pa.py_buffer(data), valid)


def rows_of(starts: np.ndarray) -> np.ndarray:
    """The row of each code point."""
    return np.repeat(np.arange(len(starts) - 1), np.diff(starts))


def any_in_row(mask: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Whether a code point of the row is marked."""
    total = np.zeros(len(mask) + 1, np.int64)
    np.cumsum(mask, out=total[1:])
    return total[starts[1:]] > total[starts[:-1]]
