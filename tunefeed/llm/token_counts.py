"""Token counts by a whole-token shortcut.

Offline, the library encodes each string of the vocabulary alone; those that come back as
that one token are proven. A pre-token that is a proven string counts 1 without merging.
Only the other distinct pre-tokens go through the merges.

Null text: empty, so 0 tokens. Empty table: no rows. Repeated rows: each counts by itself.
A text with one of the tokenizer's special strings goes to the library whole. Only the
named columns are read, so others may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from tunefeed.llm.arrow_text import lengths, slices, sums, text_bytes
from tunefeed.llm.pretokens import load


@lru_cache(maxsize=4)
def proven_tokens(path: str) -> pa.Array:
    """Vocabulary strings that encode alone as one token; at most the vocabulary's size."""
    tokenizer = load(path)
    library = tokenizer.library
    special = {s.decode() for s in tokenizer.special}
    ids = [i for t, i in sorted(library.get_vocab(with_added_tokens=False).items()) if t not in special]
    texts = [library.decode([i], skip_special_tokens=False) for i in ids]
    proven = {t for i, t, got in zip(ids, texts, tokenizer.encode(texts), strict=True) if got == [i]}
    return pa.array(sorted(t.encode() for t in proven), pa.binary())


def _count(path: str, proven: pa.Array, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    tokenizer = load(path)
    start, bounds = tokenizer.pretokens(data, offsets)
    distinct, codes = tokenizer.coded(data, start)
    counts = np.ones(len(distinct), np.int64)
    rest = np.flatnonzero(pc.is_null(pc.index_in(distinct, value_set=proven)).to_numpy(zero_copy_only=False))
    if rest.size:
        counts[rest] = tokenizer.ids(distinct.take(pa.array(rest)).to_pylist())[2]
    total = sums(counts[codes], bounds)
    if tokenizer.has_special(data):
        for i in range(total.size):
            text = data[offsets[i] : offsets[i + 1]]
            if tokenizer.has_special(text):
                total[i] = len(tokenizer.encode([text.tobytes().decode()])[0])
    return total


def count_tokens(df: DataFrame, tokenizer: str, *, key: str = "doc_id", text: str = "text", limit: int = 512) -> DataFrame:
    """``key``, n_bytes, n_tokens and over_limit (more than ``limit`` tokens) of each row."""
    spark = df.sparkSession
    proven = spark.sparkContext.broadcast(proven_tokens(tokenizer).to_pylist())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = None
        for part in slices(batches, 1):
            known = pa.array(proven.value, pa.binary()) if known is None else known
            column = part.column(1)
            n = _count(tokenizer, known, *text_bytes(column))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(lengths(column)), pa.array(n), pa.array(n > limit)],
                ["key", "n_bytes", "n_tokens", "over_limit"],
            )

    kind = df.schema[key].dataType.simpleString()
    schema = f"key {kind}, n_bytes long, n_tokens long, over_limit boolean"
    return df.select(key, text).mapInArrow(run, schema).withColumnRenamed("key", key)
