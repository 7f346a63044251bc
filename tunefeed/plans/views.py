"""The shapes the operators work on, derived from the driver tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tunefeed.functions.messages import MESSAGES
from tunefeed.operators.metrics import LOG_EVERY
from tunefeed.operators.ordered import number_within
from tunefeed.operators.training_text import turns_to_conversations
from tunefeed.sources.datasets import load_split


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return load_split(spark, sf_dir, f"{name}.parquet")


def conversation_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``conv_id``, ``conversations``."""
    return turns_to_conversations(table(spark, sf_dir, "conversations"))


def _padded(conv_id: Column, user: Column, system: Column, assistant: Column) -> dict[str, Column]:
    """Triple columns with white space around, blank and NULL values among them."""
    blank_or_null = F.when(conv_id % 3 == 0, F.lit(" 　"))
    return {
        "instruction": F.concat(F.lit("　"), user, F.lit(" \n")),
        "input": F.when(
            system.isNotNull(), F.concat(F.lit("\t"), system, F.lit(" "))
        ).otherwise(blank_or_null),
        "output": assistant,
    }


def triple_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``conv_id``, ``instruction``, ``input``, ``output``.

    First text of each role by turn: a fixed-size state per conversation, merged
    on the map side, so the length of a conversation does not matter.
    """
    turns = table(spark, sf_dir, "conversations")

    def first_text(role: str) -> Column:
        own = F.col("role") == role
        return F.min_by(F.when(own, F.col("text")), F.when(own, F.col("turn"))).alias(role)

    firsts = turns.groupBy("conv_id").agg(
        first_text("user"), first_text("system"), first_text("assistant")
    )
    cols = _padded(F.col("conv_id"), F.col("user"), F.col("system"), F.col("assistant"))
    return firsts.select("conv_id", *[c.alias(n) for n, c in cols.items()])


def mixed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both shapes in one table, by ``conv_id % 4``: 0 both, 1 triple and empty
    list, 2 conversation only, 3 triple and NULL list.

    The triple is taken from the gathered turns, so there is one shuffle.
    """
    conv, quarter = F.col("conversations"), F.col("conv_id") % 4

    def first_text(role: str) -> Column:
        return F.get(F.filter(conv, lambda t: t["role"] == role), F.lit(0))["content"]

    cols = _padded(
        F.col("conv_id"), first_text("user"), first_text("system"), first_text("assistant")
    )
    empty = F.array().cast(MESSAGES)
    return conversation_rows(spark, sf_dir).select(
        "conv_id",
        *[F.when(quarter != 2, c).alias(n) for n, c in cols.items()],
        F.when(F.col("conv_id") % 2 == 0, conv).when(quarter == 1, empty).alias("conversations"),
    )


def log_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trainer-style log records out of the event table."""
    events = table(spark, sf_dir, "events")
    numbered = number_within(events, ["user_id"], ["ts", "event_id"], "nth")
    entries = F.struct(
        F.col("value").alias("loss"),
        F.get_json_object("props", "$.k").cast("bigint").alias("k"),
        F.lit(True).alias("ok"),
        F.col("event_type").alias("note"),
        F.lit("1.5").alias("numstr"),
    )
    return numbered.select(
        "event_id",
        F.col("user_id").alias("run_id"),
        F.col("ts").alias("logged_at"),
        (F.lit(LOG_EVERY) * F.col("nth")).cast("bigint").alias("step"),
        (F.col("event_id") % 8).alias("global_rank"),
        F.when(F.col("event_type") == "signup", "eval").otherwise("train").alias("kind"),
        F.to_json(entries).alias("logs"),
    )


def damaged_log_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log records of which some are cut off, no object, or hold NaN."""
    logs, residue = F.col("logs"), F.col("event_id") % 50
    damaged = (
        F.when(residue == 0, F.expr("substring(logs, 1, length(logs) - 1)"))
        .when(residue == 1, F.concat(F.lit("["), logs, F.lit("]")))
        .when(residue == 2, F.lit('{"loss": NaN}'))
        .when(residue == 3, F.lit("{}"))
        .when(residue == 4, F.lit(None))
        .otherwise(logs)
    )
    return log_rows(spark, sf_dir).withColumn("logs", damaged)
