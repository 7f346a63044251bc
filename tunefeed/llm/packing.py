"""Sequence packing by Karmarkar-Karp multiway differencing.

Each document becomes its token ids and an end id. Full stretches of ``capacity`` ids are
sequences by themselves. What remains of a document, cut into a few pieces, is packed with
the remains of its neighbours by balanced differencing: partial partitions of k windows
begin with the k largest pieces, the next k, and so on; the two with the largest imbalance
are merged, the fullest windows of one with the emptiest of the other, until one is left,
with near-equal sums. If its largest window exceeds the capacity, k rises and it is done
again. Every fourth document is cut more finely, which gives differencing the small pieces
it needs to level the windows; then about 1 % of a block is padding.

A block of documents is packed in the task that tokenized it: no shuffle, and memory for
one block. Sequence ids are the task's partition and a counter, so a task that runs again
gives the same ids as long as its input partition holds the same rows.

Null text: empty, so one end id. Empty table: no rows. Repeated rows: each is packed.
A text with special strings goes to the library whole. Only the named columns are read.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator
from itertools import accumulate, pairwise

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tunefeed.llm.arrow_text import ragged_index, slices, sums, text_bytes
from tunefeed.llm.pretokens import load

#: Remains of this many documents are packed together.
BLOCK = 768
#: One document in so many is cut finely.
FINE = 4


def _difference(sizes: np.ndarray, k: int) -> tuple[np.ndarray, list[list[int]]]:
    """Sums of k windows, and the pieces in each, after all merges."""
    # A partial partition: k sums in falling order, and for each window a node of the
    # merge tree (-1: empty). Nodes below sizes.size are pieces, the others joined pairs.
    pairs: list[np.ndarray] = []
    made = sizes.size
    heap: list[tuple[int, int, np.ndarray, np.ndarray]] = []
    order = np.argsort(-sizes, kind="stable")
    # Balanced start: the k largest pieces are one partial partition, the next k another.
    for begin in range(0, sizes.size, k):
        taken = order[begin : begin + k]
        total, nodes = np.zeros(k, np.int64), np.full(k, -1, np.int64)
        total[: taken.size], nodes[: taken.size] = sizes[taken], taken
        heap.append((int(total[-1] - total[0]), begin, total, nodes))
    heapq.heapify(heap)
    count = sizes.size
    while len(heap) > 1:
        _, _, total, nodes = heapq.heappop(heap)
        _, _, other, other_nodes = heapq.heappop(heap)
        total, other_nodes = total + other[::-1], other_nodes[::-1]
        both = np.flatnonzero((nodes >= 0) & (other_nodes >= 0))
        joined = np.maximum(nodes, other_nodes)
        if both.size:
            pairs.append(np.stack([nodes[both], other_nodes[both]], axis=1))
            joined[both] = made + np.arange(both.size)
            made += both.size
        by = np.argsort(-total, kind="stable")
        total = total[by]
        total -= total[-1]  # only differences count from here on
        heapq.heappush(heap, (-int(total[0]), count, total, joined[by]))
        count += 1
    below = np.concatenate(pairs) if pairs else np.zeros((0, 2), np.int64)
    window = np.full(made, -1, np.int64)
    nodes = heap[0][3]
    window[nodes[nodes >= 0]] = np.flatnonzero(nodes >= 0)
    for i in range(len(below) - 1, -1, -1):
        window[below[i]] = window[sizes.size + i]
    window = window[: sizes.size]
    order = np.argsort(window, kind="stable")
    sums_ = np.bincount(window, weights=sizes, minlength=k).astype(np.int64)
    return sums_, [p.tolist() for p in np.split(order, np.cumsum(np.bincount(window, minlength=k))[:-1])]


def _cuts(rest: int, capacity: int, fine: bool) -> list[int]:
    """Sizes of the pieces of ``rest`` ids: halves of halves, or even parts."""
    if fine:
        halves = [rest >> i for i in range(6)]
        return [a - b for a, b in zip(halves, [*halves[1:], 0], strict=True) if a > b]
    parts = -(-rest // (capacity // 2))
    return [rest * (i + 1) // parts - rest * i // parts for i in range(parts)]


def pack_pieces(sizes: np.ndarray, capacity: int) -> list[list[int]]:
    """Pieces of each window; none is above ``capacity``, which no piece may exceed."""
    if not sizes.size:
        return []
    k = max(1, -(-int(sizes.sum()) // capacity))
    while True:
        total, windows = _difference(sizes, k)
        if total.max() <= capacity:
            return [w for w in windows if w]
        k += 1


def _token_ids(tokenizer, data: np.ndarray, offsets: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts with an end id after each, and each text's range of them."""
    start, bounds = tokenizer.pretokens(data, offsets)
    distinct, codes = tokenizer.coded(data, start)
    flat, begin, size = tokenizer.ids(distinct.to_pylist())
    n = size[codes]
    ids = flat[ragged_index(begin[codes], n)]
    count = sums(n, bounds)
    special = [i for i in range(count.size) if tokenizer.has_special(data[offsets[i] : offsets[i + 1]])] if tokenizer.has_special(data) else []
    texts = np.split(ids, np.cumsum(count)[:-1]) if special else []
    for i in special:
        texts[i] = np.array(tokenizer.encode([data[offsets[i] : offsets[i + 1]].tobytes().decode()])[0], np.uint32)
        count[i] = texts[i].size
    if special:
        ids = np.concatenate(texts)
    ends = np.cumsum(count + 1)
    out = np.full(int(ends[-1]), end, np.uint32)
    keep = np.ones(out.size, bool)
    keep[ends - 1] = False
    out[keep] = ids
    return out, np.concatenate([[0], ends])


def pack_documents(
    df: DataFrame,
    tokenizer: str,
    *,
    key: str = "doc_id",
    text: str = "text",
    capacity: int = 1024,
    end: int = 0,
    emit_ids: bool = False,
) -> DataFrame:
    """One row per piece: key, start, length, ids_crc32, doc_tokens, sequence_id, offset (ids)."""
    names = ["key", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", *(["ids"] if emit_ids else [])]
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = load(tokenizer)
        base, sequence = TaskContext.get().partitionId() << 33, 0
        block: list[tuple] = []  # (key, start, length, crc, doc_tokens, ids) of the remains
        documents = 0

        def packed() -> list[tuple]:
            nonlocal sequence
            rows = []
            for window in pack_pieces(np.array([p[2] for p in block], np.int64), capacity):
                at = 0
                for i in window:
                    rows.append((*block[i][:5], base + sequence, at, block[i][5]))
                    at += block[i][2]
                sequence += 1
            block.clear()
            return rows

        def batch(rows: list[tuple], key_type: pa.DataType) -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True))
            arrays = [pa.array(columns[0], key_type), *(pa.array(c, pa.int64()) for c in columns[1:7])]
            if emit_ids:
                arrays.append(pa.array([np.frombuffer(c, np.uint32).astype(np.int32) for c in columns[7]], pa.list_(pa.int32())))
            return pa.RecordBatch.from_arrays(arrays, names)

        key_type = None
        for part in slices(batches, 1):
            key_type = part.column(0).type
            ids, bounds = _token_ids(tokens, *text_bytes(part.column(1)), end)
            raw = memoryview(ids.astype("<u4", copy=False).view(np.uint8))
            rows = []
            for doc, low, high in zip(part.column(0).to_pylist(), bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                total = high - low
                full = total // capacity * capacity
                pieces = [capacity] * (full // capacity) + _cuts(total - full, capacity, documents % FINE == 0)
                for a, b in pairwise([0, *accumulate(pieces)]):
                    chars = raw[(low + a) * 4 : (low + b) * 4]
                    piece = (doc, a, b - a, zlib.crc32(chars), total)
                    own = bytes(chars) if emit_ids else b""
                    if b - a == capacity:
                        rows.append((*piece, base + sequence, 0, own))
                        sequence += 1
                    else:
                        block.append((*piece, own))
                documents += 1
                if documents % BLOCK == 0:
                    rows += packed()
            if rows:
                yield batch(rows, key_type)
        if block:
            yield batch(packed(), key_type)

    schema = f"key {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    schema += ", ids array<int>" if emit_ids else ""
    return df.select(key, text).mapInArrow(run, schema).withColumnRenamed("key", key)
