"""Batch planning: which rank and optimizer step sees which row.

The data order inside a trainer is the trainer's own affair. The rule here:
rows in key order, dealt to ``world_size`` ranks in turn; an optimizer step
takes ``world_size * per_device_batch * accumulation`` rows; the last step may
be short; one epoch; no row is dropped or repeated.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tunefeed.functions.tokens import first_space_tokens, space_token_count
from tunefeed.operators.ordered import ROWS_PER_BUCKET, number_file_rows, number_rows
from tunefeed.session import shared_path


@dataclass(frozen=True)
class BatchPlan:
    """Settings of a training run, with the defaults of the training jobs."""

    world_size: int = 1
    per_device_batch: int = 1
    accumulation: int = 8
    max_steps: int = -1

    @classmethod
    def on_nodes(cls, nodes: int, gpus_per_node: int, **settings: int) -> BatchPlan:
        """One rank per GPU."""
        return cls(world_size=nodes * gpus_per_node, **settings)

    @property
    def rows_per_step(self) -> int:
        return self.world_size * self.per_device_batch * self.accumulation

    @property
    def row_limit(self) -> int | None:
        """Rows the step cap leaves; None for a whole epoch (cap of 0 or less)."""
        return self.max_steps * self.rows_per_step if self.max_steps > 0 else None


def assign_rank(df: DataFrame, world_size: int, position: str = "p") -> DataFrame:
    return df.withColumn("rank", F.pmod(F.col(position), F.lit(world_size)).cast("bigint"))


def assign_step(df: DataFrame, plan: BatchPlan, position: str = "p") -> DataFrame:
    """Add ``step`` (from 1) and ``micro``, the micro-batch inside the step."""
    p, size = F.col(position), plan.rows_per_step
    micro_size = plan.world_size * plan.per_device_batch
    return df.withColumn("step", _div(p, size) + 1).withColumn(
        "micro", _div(F.pmod(p, F.lit(size)), micro_size)
    )


def step_cap(df: DataFrame, max_steps: int, step: str = "step") -> DataFrame:
    """Keep the first ``max_steps`` steps; 0 or less keeps the whole epoch."""
    return df.filter(F.col(step) <= max_steps) if max_steps > 0 else df


def plan_batches(
    df: DataFrame,
    keys: list[str] | None,
    plan: BatchPlan,
    rows_per_bucket: int = ROWS_PER_BUCKET,
    stored: bool = False,
) -> DataFrame:
    """Number the rows and add ``rank``, ``step`` and ``micro``.

    Rows are in key order; without keys, in that of the files ``df`` was read from. The step
    cap acts here, on key ranges or files, so call this before rendering: rows past the cap
    are neither shuffled nor rendered.
    """
    if keys:
        numbered = number_rows(df, keys, "p", rows_per_bucket, plan.row_limit, stored)
    else:
        numbered = number_file_rows(df, "p", plan.row_limit)
    return assign_step(assign_rank(numbered, plan.world_size), plan)


def batch_summary(df: DataFrame, tokens: str = "n_tok") -> DataFrame:
    """Rows and tokens per step and rank, to check that the split is even."""
    return df.groupBy("step", "rank").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(tokens).alias("sum_tokens"),
        F.max(tokens).alias("max_tokens"),
    )


def cap_tokens(
    df: DataFrame,
    max_length: int = 2048,
    text: str = "text",
    tokenizer: Callable[[Column, int], Column] | None = None,
) -> DataFrame:
    """Add ``n_tokens`` (before the cut) and keep the first ``max_length`` tokens.

    Without a tokenizer, tokens are space-separated words and ``text`` itself is
    cut. With one (see ``arrow_tokenizer``) the ids go to ``input_ids``.
    """
    if tokenizer is None:
        counted = df.withColumn("n_tokens", space_token_count(F.col(text)))
        cut = F.when(
            F.col("n_tokens") > max_length, first_space_tokens(F.col(text), max_length)
        ).otherwise(F.col(text))
        return counted.withColumn(text, cut)
    encoded = df.withColumn("__encoded", tokenizer(F.col(text), max_length))
    return encoded.select(
        *df.columns, F.col("__encoded.input_ids"), F.col("__encoded.n_tokens")
    )


def pack_sequences(
    df: DataFrame,
    max_length: int = 2048,
    position: str = "p",
    tokens: str = "n_tok",
    rank: str = "rank",
    rows_per_cell: int = ROWS_PER_BUCKET,
    stored: bool = False,
) -> DataFrame:
    """Lay the rows of each rank end to end and cut into blocks of ``max_length``.

    A row that crosses a block border gives one piece per block: ``block``,
    ``block_pos`` (where the piece starts in it), ``token_from`` (where it
    starts in the row) and ``piece_tokens``. Each block but a rank's last is
    full. A row of 0 tokens gives one empty piece.

    A NULL count is 0. Running sums are taken inside cells of ``rows_per_cell``
    positions; a cell starts from the total of those before it, so no task holds a
    whole rank. Positions are dense, hence cells are of one size. The rows are
    written to the shared folder, as they are read for both; ``stored`` says that they
    cost no more than a scan, as after ``plan_batches``, and need no copy.
    """
    known = df.withColumn(tokens, F.coalesce(F.col(tokens).cast("bigint"), F.lit(0).cast("bigint")))
    rows = known.withColumn("__cell", _div(F.col(position), rows_per_cell))
    if not stored:
        path = shared_path(df.sparkSession, "cells")
        rows.write.parquet(path)
        rows = df.sparkSession.read.parquet(path)
    cells = rows.groupBy(rank, "__cell").agg(F.sum(tokens).alias("n"))
    before_cell = Window.partitionBy(rank).orderBy("__cell")
    starts = cells.select(
        rank,
        "__cell",
        F.sum("n")
        .over(before_cell.rowsBetween(Window.unboundedPreceding, -1))
        .alias("__cell_start"),
    )
    before_row = Window.partitionBy(rank, "__cell").orderBy(position)
    placed = rows.withColumn(
        "__in_cell",
        F.sum(tokens).over(before_row.rowsBetween(Window.unboundedPreceding, -1)),
    ).join(starts, [rank, "__cell"])
    zero = F.lit(0).cast("bigint")
    start = F.coalesce("__cell_start", zero) + F.coalesce("__in_cell", zero)
    size = F.lit(max_length).cast("bigint")
    last = F.col("__start") + F.greatest(F.col(tokens), F.lit(1)) - 1
    pieces = placed.withColumn("__start", start).withColumn(
        "block", F.explode(F.sequence(_div(F.col("__start"), max_length), _div(last, max_length)))
    )
    token_from = F.greatest(F.col("block") * size - F.col("__start"), zero)
    token_to = F.least((F.col("block") + 1) * size - F.col("__start"), F.col(tokens))
    return (
        pieces.withColumn("token_from", token_from)
        .withColumn("piece_tokens", token_to - F.col("token_from"))
        .withColumn("block_pos", F.col("__start") + F.col("token_from") - F.col("block") * size)
        .drop("__cell", "__cell_start", "__in_cell", "__start")
    )


def _div(number: Column, by: int) -> Column:
    return F.call_function("div", number, F.lit(by)).cast("bigint")
