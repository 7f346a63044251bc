"""The whole way from source rows to a feed, as one call."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T

from tunefeed.functions.chat import DEFAULT_TEMPLATE, Template
from tunefeed.operators.batching import BatchPlan, cap_tokens, plan_batches
from tunefeed.operators.training_text import project_text
from tunefeed.sources.datasets import resolve_source
from tunefeed.sources.feed import read_training_feed, write_training_feed


def prepare_feed(
    spark: SparkSession,
    output: str,
    keys: list[str] | None = None,
    base: str = "",
    dataset: str = "",
    jsonl_path: str = "",
    split: str | None = "train",
    schema: T.StructType | None = None,
    plan: BatchPlan = BatchPlan(),
    template: Template = DEFAULT_TEMPLATE,
    tokenizer: Callable[[Column, int], Column] | None = None,
    max_length: int = 2048,
    shuffle: bool | None = None,
) -> DataFrame:
    """Read, plan, render and write; the feed at ``output`` is returned as read.

    ``keys`` give the order of the rows. Without them it is that of the files: by path, and in
    a file by line. Texts are capped at ``max_length`` tokens, of the tokenizer given (ids go to
    ``input_ids``) or else space-separated. Rows past the step cap are not rendered.

    JSON lines are parsed once, into a table in the shared folder (twice without a ``schema``,
    as types are inferred first). With keys, text is exchanged once, for the order; without,
    not at all. ``shuffle`` exchanges it (again); by default that is done where there would
    be too many small files without.
    """
    rows = resolve_source(spark, base, dataset, jsonl_path, split, schema)
    planned = plan_batches(rows, keys, plan)
    feed = project_text(planned, template, keep=(*(keys or ()), "p", "rank", "step", "micro"))
    feed = cap_tokens(feed, max_length, tokenizer=tokenizer)
    write_training_feed(feed, output, plan.world_size, shuffle=shuffle)
    return read_training_feed(spark, output)
