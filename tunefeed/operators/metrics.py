"""Trainer log records -> metric rows.

A log record is a row with ``run_id``, ``step``, ``logged_at``, ``global_rank``,
``kind`` (``train`` / ``eval`` / ``final``) and ``logs``, a JSON object.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunefeed.operators.ordered import ROWS_PER_BUCKET, previous_within

# Cadence of the training jobs, in optimizer steps.
LOG_EVERY = 10
SAVE_EVERY = 200
UPLOAD_EVERY = 100

# Fixed value: prefix of evaluation metrics.
EVAL_PREFIX = "eval_"

# Variant types that are numbers to Python; one test, so one look at the type.
_NUMERIC = r"^(BIGINT|DOUBLE|FLOAT|BOOLEAN|DECIMAL\(\d+,\d+\))$"

_STRICT_JSON = {"allowSingleQuotes": "false"}


def _record(logs: str) -> Column:
    """The JSON object in ``logs`` as a map of variants (a key twice is there twice);
    NULL when the text is anything but one object.

    NaN and Infinity, which Python writes unquoted, are read as such. Spark's reader
    stops where its value ends, so the text stands in an object of two fields; the
    second is named by a hash of the text, which the text cannot hold. More or fewer
    fields show that it is not one value.
    """
    text = F.col(logs)
    end = F.concat(F.lit("end"), F.hex(F.xxhash64(text)))
    wrapped = F.concat(F.lit('{"record":'), text, F.lit(',"'), end, F.lit('":{}}'))
    read = F.from_json(wrapped, "map<string,map<string,variant>>", _STRICT_JSON)
    # A filter keeps its argument in one place, so the text is parsed once.
    one = F.filter(F.array(read), lambda m: (F.size(m) == 2) & F.map_contains_key(m, end))
    return F.get(one, F.lit(0))["record"]


def _entries(df: DataFrame, keep: tuple[str, ...], logs: str) -> DataFrame:
    """``keep``, ``key``, ``value`` and ``reason`` (NULL: good) of the numeric entries."""
    keys = F.map_keys("__record")
    twice = F.when(
        F.size(F.array_distinct(keys)) < F.size(keys),
        F.filter(keys, lambda k: F.size(F.filter(keys, lambda other: other == k)) > 1),
    )
    # explode_outer, because explode would have the optimizer parse each record
    # a second time to test that the map is not empty.
    read = df.select(*keep, F.col(logs).alias("__logs"), F.explode_outer(F.array(_record(logs))).alias("__record"))
    rows = read.select(*keep, "__logs", twice.alias("__twice"), F.explode_outer("__record").alias("key", "entry"))
    numeric = F.schema_of_variant("entry").rlike(_NUMERIC)
    value = F.try_variant_get("entry", "$", "double")
    # An integer beyond a double is read as infinite; 309 digits or more show which.
    named = F.concat(F.lit('"\\Q'), "key", F.lit('\\E"'))
    long = r"\s*:\s*-?[0-9]{309,}\s*[,}]"
    own = F.rlike("__logs", F.concat(named, F.lit(long))) | ~F.rlike("__logs", named)
    too_large = F.when(F.abs(value) == float("inf"), F.col("__logs").rlike(long) & own)
    reason = F.when(F.array_contains("__twice", F.col("key")), F.lit("duplicate key")).when(
        too_large, F.lit("out of range")
    )
    return rows.filter(F.col("key").isNotNull() & numeric).select(
        *keep, "key", value.alias("value"), reason.alias("reason")
    )


def explode_metrics(
    df: DataFrame, keep: tuple[str, ...] = ("run_id", "step"), logs: str = "logs"
) -> DataFrame:
    """One row (``key``, ``value`` DOUBLE) per numeric entry of each record.

    Numbers and booleans count; strings (``"1.5"`` too), lists, objects and
    nulls do not. Broken records give no row here, see ``metric_rejects``; nor do
    keys that ``metric_key_rejects`` has. Stateless, so it serves batch and stream.
    """
    return _entries(df, keep, logs).filter("reason IS NULL").drop("reason")


def metric_key_rejects(
    df: DataFrame, keep: tuple[str, ...] = ("run_id", "step"), logs: str = "logs"
) -> DataFrame:
    """Numeric entries (``key``, ``reason``) that are no metric, though their record can
    be read: a key that stands there twice (one row each time), and an integer beyond
    what a double holds. The record's other keys are not affected.
    """
    return _entries(df, keep, logs).filter("reason IS NOT NULL").drop("value")


def metric_rejects(df: DataFrame, logs: str = "logs") -> DataFrame:
    """Records that cannot be read, with the reason; no other record is affected.

    A missing record (NULL or JSON ``null``) is empty, not broken. Text after the
    object makes the record broken.
    """
    text = F.col(logs)
    absent = text.isNull() | (F.trim(text) == "null")
    other = ~F.ltrim(text).startswith("{") & F.try_parse_json(text).isNotNull()
    reason = F.when(other, F.lit("not a JSON object")).otherwise(F.lit("not JSON"))
    return df.filter(~absent & _record(logs).isNull()).withColumn("reason", reason)


def rank0_only(df: DataFrame, rank: str = "global_rank") -> DataFrame:
    """One writer per job: records of the process with global rank 0."""
    return df.filter(F.col(rank) == 0)


def eval_metrics(df: DataFrame, keep: tuple[str, ...] = ("run_id", "step")) -> DataFrame:
    """Metrics of evaluation records, each key with the prefix ``eval_``."""
    return explode_metrics(df.filter(F.col("kind") == "eval"), keep).withColumn(
        "key", F.concat(F.lit(EVAL_PREFIX), F.col("key"))
    )


def final_metrics(df: DataFrame, keep: tuple[str, ...] = ("run_id",)) -> DataFrame:
    """Metrics of the records of kind ``final``, the end of a run: they have no step."""
    return explode_metrics(df.filter(F.col("kind") == "final"), keep).withColumn("step", F.lit(None).cast("bigint"))


def time_per_step(
    df: DataFrame,
    logging_steps: int = LOG_EVERY,
    max_run_rows: int = ROWS_PER_BUCKET,
    tie_break: str = "step",
) -> DataFrame:
    """Add ``time_per_step``: seconds since the run's previous record, over
    ``logging_steps`` (at least 1). NULL on the first record of a run. Records of
    one time are in order of ``tie_break``. Records without a run are one run.

    A run of more than ``max_run_rows`` records is looked at in time slices.
    """
    before = previous_within(
        df, ["run_id"], ["logged_at", tie_break], "logged_at", "__previous", max_run_rows
    )
    seconds = seconds_per_step(F.col("__previous"), F.col("logged_at"), logging_steps)
    return before.withColumn("time_per_step", seconds).drop("__previous")


def seconds_per_step(previous: Column, logged_at: Column, logging_steps: int) -> Column:
    """Seconds between two records over the steps between them (at least 1)."""
    micros = F.timestamp_diff("MICROSECOND", previous, logged_at)
    return micros / F.lit(1e6) / F.lit(max(logging_steps, 1))


def time_per_step_metric(timed: DataFrame, keep: tuple[str, ...] = ("run_id", "step")) -> DataFrame:
    """The output of ``time_per_step`` as metric rows, to union with the others."""
    return timed.filter(F.col("time_per_step").isNotNull()).select(
        *keep, F.lit("time_per_step").alias("key"), F.col("time_per_step").alias("value")
    )


def cadence(
    df: DataFrame,
    step: str = "step",
    log_every: int = LOG_EVERY,
    save_every: int = SAVE_EVERY,
    upload_every: int = UPLOAD_EVERY,
) -> DataFrame:
    """Add what is due at each step: ``log_due``, ``save_due``, ``upload_due``.

    An interval below 1 counts as 1.
    """
    due = {"log_due": log_every, "save_due": save_every, "upload_due": upload_every}
    return df.withColumns({name: F.col(step) % max(every, 1) == 0 for name, every in due.items()})
