"""SimHash fingerprints of word shingles, one Arrow batch at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from tunefeed.llm.arrow_text import LOWER, SPACED, slices, text_bytes, words

SHINGLE = 3
SEED = 42


def _shingles(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """Words joined by single spaces, begin and end of each shingle, and shingles per text."""
    data = LOWER[data]
    start, stop, bounds = words(data, offsets, SPACED)
    length = stop - start
    chars = data[SPACED[data]]
    joined = np.full(chars.size + length.size, 0x20, np.uint8)
    joined[np.arange(chars.size) + np.repeat(np.arange(length.size), length)] = chars
    begin = np.cumsum(length + 1) - length - 1
    end = begin + length
    n = np.diff(bounds)
    count = np.where(n >= size, n - size + 1, np.minimum(n, 1))
    first = np.repeat(bounds[:-1] - (np.cumsum(count) - count), count) + np.arange(count.sum())
    last = first + np.repeat(np.minimum(n, size) - 1, count)
    return joined.tobytes(), begin[first], end[last], count


def fingerprints(data: np.ndarray, offsets: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """64 bits per text, as unsigned numbers; 0 for a text without words."""
    joined, begin, end, count = _shingles(data, offsets, size)
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(begin.tolist(), end.tolist(), strict=True)), np.uint64, begin.size)
    out = np.zeros(count.size, np.uint64)
    ends = np.cumsum(count)
    step = 1 << 16  # shingles whose bits are spread out at once
    votes = np.zeros((count.size, 64), np.int64)
    for low in range(0, hashes.size, step):
        part = hashes[low : low + step]
        bits = np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        first, last = np.searchsorted(ends, low, side="right"), np.searchsorted(ends, low + part.size - 1, side="right")
        texts = first + np.flatnonzero(count[first : last + 1])
        cuts = np.maximum(ends[texts] - count[texts] - low, 0)
        votes[texts] += np.add.reduceat(bits, cuts, axis=0, dtype=np.int32)
    for bit in range(64):
        out |= (2 * votes[:, bit] > count).astype(np.uint64) << np.uint64(bit)
    return out


def with_fingerprint(df: DataFrame, *, key: str = "doc_id", text: str = "text", size: int = SHINGLE) -> DataFrame:
    """``key`` and its fingerprint ``fp`` (the 64 bits as a signed long)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 1):
            found = fingerprints(*text_bytes(part.column(1)), size).view(np.int64)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found)], ["key", "fp"])

    return df.select(key, text).mapInArrow(run, f"key {df.schema[key].dataType.simpleString()}, fp long")
