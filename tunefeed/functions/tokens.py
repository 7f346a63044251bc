"""Token counts and the space tokenizer that stands in for a model's own."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# The ASCII white space both regex dialects agree on.
_SPACE = r" \t\n\r\f"
TOKEN_WITH_LEADING_SPACE = f"[{_SPACE}]*[^{_SPACE}]+"


def space_pieces(text: Column) -> Column:
    """Tokens with the white space before each: joined they give the text back,
    but for white space at its very end."""
    return F.regexp_extract_all(
        F.coalesce(text, F.lit("")), F.lit(TOKEN_WITH_LEADING_SPACE), F.lit(0)
    )


def space_token_count(text: Column) -> Column:
    """Number of space-separated tokens; ``""`` and NULL have none."""
    return F.size(space_pieces(text)).cast("bigint")


def first_space_tokens(text: Column, n: int) -> Column:
    """The text up to the end of its n-th token, inner white space as it was."""
    return F.array_join(F.slice(space_pieces(text), 1, n), "")


def arrow_tokenizer(make_encode: Callable[[], Callable[[list[str]], list[list[int]]]]) -> Callable:
    """A column function (text, max_length) -> ``n_tokens`` and the first
    ``max_length`` ``input_ids``, around a tokenizer the caller brings.

    ``make_encode`` runs once per task and returns a function that encodes a list
    of texts, such as a library's batch call; it is called once per Arrow batch.
    NULL counts as "". Ids past ``max_length`` are counted and not sent back.
    """

    def encoded(text: Column, max_length: int) -> Column:
        @F.pandas_udf("n_tokens long, input_ids array<long>")
        def encode_column(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            encode = make_encode()
            for batch in batches:
                ids = encode(["" if s is None else s for s in batch])
                if len(ids) != len(batch):
                    raise ValueError(f"tokenizer gave {len(ids)} lists for {len(batch)} texts")
                yield pd.DataFrame(
                    {"n_tokens": [len(i) for i in ids], "input_ids": [list(i[:max_length]) for i in ids]}
                )

        return encode_column(text)

    return encoded
