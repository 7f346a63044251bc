"""Run registry: checkpoints, experiments, tags and parameters as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tunefeed.functions.paths import checkpoint_path
from tunefeed.operators.metrics import SAVE_EVERY
from tunefeed.sources.versioned import BUCKETS, VersionedTable

# Fixed value: checkpoints a run keeps.
SAVE_TOTAL_LIMIT = 2


def checkpoints(logs: DataFrame, output_dir: Column, save_every: int = SAVE_EVERY) -> DataFrame:
    """Manifest (``run_id``, ``step``, ``path``) of the checkpoints runs wrote.

    None is written before the first step; an interval below 1 counts as 1.
    """
    due = (F.col("step") > 0) & (F.col("step") % max(save_every, 1) == 0)
    return logs.filter(due).select(
        "run_id", "step", checkpoint_path(output_dir, F.col("step")).alias("path")
    )


def checkpoint_retention(manifest: DataFrame, limit: int = SAVE_TOTAL_LIMIT) -> DataFrame:
    """The newest ``limit`` checkpoints of each run.

    Spark limits each run's rows before the shuffle as well as after it
    (WindowGroupLimit), so a run with very many checkpoints sends few rows.
    """
    newest = Window.partitionBy("run_id").orderBy(F.col("step").desc())
    return manifest.withColumn("__n", F.row_number().over(newest)).filter(
        F.col("__n") <= limit
    ).drop("__n")


def missing_experiments(requested: DataFrame, existing: DataFrame) -> DataFrame:
    """Names that are asked for and not there yet, each once; NULL is no name."""
    return requested.select("name").filter("name IS NOT NULL").distinct().join(existing.select("name"), "name", "left_anti")


def get_or_create_experiments(requested: DataFrame, existing: DataFrame, path: str) -> DataFrame:
    """Append the missing names to the parquet table at ``path``; return the
    table as it is then.

    ``existing`` is that table as read before. One writer at a time.
    """
    missing_experiments(requested, existing).write.mode("append").parquet(path)
    return requested.sparkSession.read.parquet(path)


def experiment_table(spark: SparkSession, path: str, buckets: int = BUCKETS) -> VersionedTable:
    return VersionedTable(spark, path, "name string", ["name"], buckets)


def get_or_create(
    table: VersionedTable, requested: DataFrame, stream: str | None = None, batch: int | None = None
) -> DataFrame:
    """Add the names that are not in an experiment table yet; return it as it is then.

    For any number of writers, and safe to play again; NULL is no name.
    """
    named = requested.select("name").filter("name IS NOT NULL")
    return table.read(table.upsert(named, ["name"], stream, batch, first_wins=True))


def tag_table(
    spark: SparkSession, path: str, run_id: str = "string", seq: str = "bigint", buckets: int = BUCKETS
) -> VersionedTable:
    """Tags, or parameters, of runs; the types of run ids and sequence numbers are the caller's."""
    schema = f"run_id {run_id}, key string, value string, seq {seq}"
    return VersionedTable(spark, path, schema, ["run_id", "key"], buckets)


def upsert_tags(
    table: VersionedTable, settings: DataFrame, stream: str | None = None, batch: int | None = None
) -> DataFrame:
    """Bring a batch of settings into a tag table; return ``run_tags`` of all batches so far.

    The greatest ``seq`` of a run and key stays, in whatever batch it came.
    """
    return table.read(table.upsert(settings, ["seq"], stream, batch)).drop("seq")


def upsert_params(
    table: VersionedTable, params: DataFrame, stream: str | None = None, batch: int | None = None
) -> DataFrame:
    """Bring rows of ``run_params`` into a tag table, where a parameter keeps its first value."""
    kind = table.schema["seq"].dataType
    rows = params.withColumn("seq", F.lit(None).cast(kind))
    return table.read(table.upsert(rows, ["value"], stream, batch, first_wins=True)).drop("seq")


def run_tags(settings: DataFrame) -> DataFrame:
    """Rows (``run_id``, ``key``, ``value``, ``seq``) -> latest value per run and key."""
    return settings.groupBy("run_id", "key").agg(F.max_by("value", "seq").alias("value"))


def run_params(runs: DataFrame, params: list[str], run_id: str = "run_id") -> DataFrame:
    """One row (``run_id``, ``key``, ``value`` STRING) per parameter of each run.

    Values are written as Python's ``str`` does; a missing one is ``None``.
    """
    pairs = F.array(
        *[F.struct(F.lit(p).alias("key"), python_str(runs, p).alias("value")) for p in params]
    )
    return runs.select(F.col(run_id).alias("run_id"), F.inline(pairs))


def python_str(df: DataFrame, column: str) -> Column:
    """A column as Python's ``str`` writes it (integers, booleans, floats, text)."""
    col, kind = F.col(column), df.schema[column].dataType
    text = col.cast("string")
    if isinstance(kind, T.BooleanType):
        text = F.initcap(text)
    elif isinstance(kind, (T.DoubleType, T.FloatType)):
        text = _float_str(col.cast("double"), text)
    return F.coalesce(text, F.lit("None"))


def _float_str(value: Column, java: Column) -> Column:
    """Java writes 2.0E-4 where Python writes 0.0002, and so on."""
    mantissa = F.regexp_replace(F.substring_index(java, "E", 1), r"\.0$", "")
    exponent = F.substring_index(java, "E", -1).try_cast("int")
    sign = F.when(exponent < 0, F.lit("e-")).otherwise(F.lit("e+"))
    places = F.abs(exponent).cast("string")
    padded = F.when(F.length(places) < 2, F.concat(F.lit("0"), places)).otherwise(places)
    scientific = F.concat(mantissa, sign, padded)
    plain = F.regexp_replace(java.try_cast("decimal(38,21)").cast("string"), r"0+$", "")
    plain = F.when(plain.endswith("."), F.concat(plain, F.lit("0"))).otherwise(plain)
    return (
        F.when(F.isnan(value), F.lit("nan"))
        .when(value == float("inf"), F.lit("inf"))
        .when(value == float("-inf"), F.lit("-inf"))
        .when(~java.contains("E"), java)
        .when((exponent >= -4) & (exponent < 16), plain)
        .otherwise(scientific)
    )
