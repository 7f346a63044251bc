"""Text columns of Arrow batches as numpy arrays: slices, words, code points.

A null text counts as an empty one throughout. Sizes are bounded by ``SLICE_BYTES``,
or by one text where a single text is longer; texts are never cut.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 21

_ASCII_SPACE = [0x20, *range(0x09, 0x0E)]


def _byte_set(outside: list[int]) -> np.ndarray:
    inside = np.ones(256, dtype=bool)
    inside[outside] = False
    return inside


#: Bytes of words `[^\x20\x09-\x0D]+`.
SPACED = _byte_set(_ASCII_SPACE)
#: Bytes of words `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` (after lower-casing).
ALPHANUMERIC = _byte_set([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])
#: A-Z to a-z, other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def slices(batches: Iterator[pa.RecordBatch], text: int, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the texts of a slice hold ``size`` bytes at most, or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = np.cumsum(lengths(batch.column(text)))
        begin = 0
        while begin < batch.num_rows:
            before = ends[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(ends, before + size, side="right")))
            yield batch.slice(begin, end - begin)
            begin = end


def _offsets(column: pa.Array) -> np.ndarray:
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    raw = np.frombuffer(column.buffers()[1], dtype=kind) if column.buffers()[1] else np.zeros(1, kind)
    return raw[column.offset : column.offset + len(column) + 1].astype(np.int64)


def lengths(column: pa.Array) -> np.ndarray:
    """UTF-8 bytes of each text."""
    if not len(column):
        return np.zeros(0, np.int64)
    if column.null_count:
        column = column.fill_null("")
    return np.diff(_offsets(column))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts end to end as bytes, and where each begins (one more entry: the end)."""
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    if column.null_count:
        column = column.fill_null("")
    offsets = _offsets(column)
    buffer = column.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer is not None and buffer.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def begins(offsets: np.ndarray, size: int) -> np.ndarray:
    """Flags of the bytes at which a text begins."""
    flags = np.zeros(size, dtype=bool)
    flags[offsets[:-1][offsets[:-1] < size]] = True
    return flags


def words(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of each word in ``data``, and of each text's words in those."""
    mask = inside[data]
    first = begins(offsets, data.size)
    start = mask.copy()
    start[1:] &= ~mask[:-1] | first[1:]
    stop = mask.copy()
    stop[:-1] &= ~mask[1:] | first[1:]
    start, stop = np.flatnonzero(start), np.flatnonzero(stop) + 1
    return start, stop, np.searchsorted(start, offsets)


def ragged_index(begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Indices begin[i] .. begin[i] + length[i] - 1 of all i, end to end."""
    total = int(length.sum())
    shift = np.repeat(begin - (np.cumsum(length) - length), length)
    return shift + np.arange(total)


def strings(data: np.ndarray, start: np.ndarray, stop: np.ndarray, kind: pa.DataType = pa.binary()) -> pa.Array:
    """Disjoint pieces of ``data`` in order, as an Arrow array."""
    size = stop - start
    if size.sum() == data.size:
        chars = np.ascontiguousarray(data)
    else:
        edge = np.zeros(data.size + 1, np.int8)
        edge[start] += 1
        np.subtract.at(edge, stop, 1)
        chars = data[np.cumsum(edge[:-1], dtype=np.int8).view(bool)]
    ends = np.zeros(size.size + 1, np.int64)
    np.cumsum(size, out=ends[1:])
    if ends[-1] >= 1 << 31:
        wide = pa.large_string() if kind == pa.string() else pa.large_binary()
        return pa.Array.from_buffers(wide, size.size, [None, pa.py_buffer(ends), pa.py_buffer(chars)])
    return pa.Array.from_buffers(kind, size.size, [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(chars)])


def sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of values[bounds[i]:bounds[i + 1]] for each i; 0 for an empty range."""
    total = np.zeros(values.size + 1, dtype=np.result_type(values.dtype, np.int64))
    np.cumsum(values, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]
