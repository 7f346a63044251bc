"""Log records that keep arriving as JSON-lines files -> metric table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tunefeed.operators.metrics import explode_metrics, metric_key_rejects, metric_rejects

LOG_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("step", T.LongType()),
        T.StructField("logged_at", T.TimestampNTZType()),
        T.StructField("global_rank", T.LongType()),
        T.StructField("kind", T.StringType()),
        T.StructField("logs", T.StringType()),
    ]
)
# Holds a line that is no record of the schema; NULL for others.
BROKEN_LINE = "_corrupt_record"


def read_log_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType = LOG_SCHEMA,
    max_files_per_trigger: int = 1000,
) -> DataFrame:
    """Files as they land; a burst is taken in batches of bounded size.

    Lines that do not fit the schema come with the whole line in ``_corrupt_record``.
    """
    fields = [f for f in schema.fields if f.name != BROKEN_LINE]
    return (
        spark.readStream.schema(T.StructType([*fields, T.StructField(BROKEN_LINE, T.StringType())]))
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .option("columnNameOfCorruptRecord", BROKEN_LINE)
        .json(path)
    )


def write_metric_stream(
    logs: DataFrame,
    table_path: str,
    checkpoint_path: str,
    keep: tuple[str, ...] = ("run_id", "step"),
    every: str | None = None,
) -> StreamingQuery:
    """Append the metrics of all records present, then stop; with ``every``
    (such as ``"1 minute"``) go on until stopped.

    Without state. The checkpoint and the file sink's own log give each metric
    once, also after a restart or on a second start.
    """
    whole = logs.filter(F.col(BROKEN_LINE).isNull()) if BROKEN_LINE in logs.columns else logs
    return _append(explode_metrics(whole, keep), table_path, checkpoint_path, every)


def write_reject_stream(
    logs: DataFrame,
    table_path: str,
    checkpoint_path: str,
    keep: tuple[str, ...] = ("run_id", "step"),
    every: str | None = None,
) -> StreamingQuery:
    """Append what ``write_metric_stream`` leaves out, with a checkpoint of its own:
    lines, records and keys (NULL but for a key), each with ``reason`` and ``text``.
    """
    line, no_key = F.col(BROKEN_LINE), F.lit(None).cast("string").alias("key")
    lines = logs.filter(line.isNotNull()).select(*keep, no_key, F.lit("broken line").alias("reason"), line.alias("text"))
    whole = logs.filter(line.isNull())
    records = metric_rejects(whole).select(*keep, no_key, "reason", F.col("logs").alias("text"))
    keys = metric_key_rejects(whole, (*keep, "logs")).select(*keep, "key", "reason", F.col("logs").alias("text"))
    return _append(lines.unionAll(records).unionAll(keys), table_path, checkpoint_path, every)


def _append(rows: DataFrame, path: str, checkpoint: str, every: str | None) -> StreamingQuery:
    return (
        rows.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**({"processingTime": every} if every else {"availableNow": True}))
        .start(path)
    )
