"""Training feed: one directory per rank, so a rank reads its own rows only.

Beside the rows stands an index, ``_steps``: of each file, its rank and its first and last step.
A run that goes on from a checkpoint reads the files that have steps after it, and no other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROWS_PER_SHARD = 500_000
FILES_PER_SHARD = 4
FEW_FILES = 1000
INDEX = "_steps"


def write_training_feed(
    df: DataFrame,
    path: str,
    world_size: int,
    rows_per_shard: int = ROWS_PER_SHARD,
    shuffle: bool | None = None,
) -> None:
    """Write rows with ``p`` (dense position) and ``rank`` as parquet.

    A rank is written by many tasks: shards are runs of ``rows_per_shard`` rows
    of one rank, equal in size as positions are dense, and each is one task's and one file.
    Rows in a file are in order of ``p``. ``shuffle=False`` saves that shuffle: tasks keep the
    rows they have, and each writes one file per rank. By default it is saved while that makes at
    most ``FILES_PER_SHARD`` times the files that shards would be, or ``FEW_FILES`` of them.
    """
    # The greatest position is read from one column.
    last = None if shuffle is False else df.agg(F.max("p")).first()[0]
    per_rank = -(-((last or 0) + 1) // (world_size * rows_per_shard))
    if shuffle is None:
        files = df.rdd.getNumPartitions() * world_size
        shuffle = files > max(FILES_PER_SHARD * world_size * per_rank, FEW_FILES)
    shard = F.call_function("div", F.call_function("div", F.col("p"), F.lit(world_size)), F.lit(rows_per_shard))
    rows = df
    if shuffle:
        number = F.pmod(F.col("rank"), F.lit(world_size)) * per_rank + shard
        rows = df.repartitionById(world_size * per_rank, number.cast("int"))
    rows.sortWithinPartitions("rank", "p").write.mode("overwrite").partitionBy("rank").parquet(path)
    if "step" in df.columns:
        _write_index(df.sparkSession, path)


def _write_index(spark: SparkSession, path: str) -> None:
    """One row per file; only the column ``step`` is read. Names that begin with ``_`` are no data."""
    files = read_training_feed(spark, path).groupBy(F.col("_metadata.file_path").alias("file"))
    ends = files.agg(
        F.first("rank").alias("rank"), F.min("step").alias("first_step"), F.max("step").alias("last_step"), F.count(F.lit(1)).alias("n_rows")
    )
    ends.write.mode("overwrite").parquet(f"{path.rstrip('/')}/{INDEX}")


def read_training_feed(spark: SparkSession, path: str, rank: int | None = None) -> DataFrame:
    """The whole feed, or one rank's directory of it."""
    feed = spark.read.parquet(path).withColumn("rank", F.col("rank").cast("bigint"))
    return feed if rank is None else feed.filter(F.col("rank") == rank)


def read_feed_index(spark: SparkSession, path: str) -> DataFrame:
    """``file``, ``rank``, ``first_step``, ``last_step`` and ``n_rows`` of the files of a feed."""
    return spark.read.parquet(f"{path.rstrip('/')}/{INDEX}")


def feed_from_step(
    spark: SparkSession, path: str, step: int, rank: int | None = None, end_step: int | None = None
) -> DataFrame:
    """The rows of a feed from ``step`` on (below ``end_step``), of all ranks or one.

    Files are chosen by the index, so a feed's earlier steps are neither listed nor opened; the driver
    holds the names of those that are read. Rows of steps before, in the first of them, are left out.
    """
    wanted = F.col("last_step") >= step
    if rank is not None:
        wanted &= F.col("rank") == rank
    if end_step is not None:
        wanted &= F.col("first_step") < end_step
    files = [r["file"] for r in read_feed_index(spark, path).filter(wanted).select("file").collect()]
    whole = read_training_feed(spark, path)
    if not files:
        return spark.createDataFrame([], whole.schema)
    rows = spark.read.option("basePath", path).schema(whole.schema).parquet(*[_decoded(f) for f in files])
    rows = rows.withColumn("rank", F.col("rank").cast("bigint")).filter(F.col("step") >= step)
    return rows if end_step is None else rows.filter(F.col("step") < end_step)


def _decoded(file: str) -> str:
    """A file's URI, as Spark gives it, as a path, as Spark takes it; a feed's names hold no globs."""
    from urllib.parse import unquote

    return unquote(file)


def feed_after_checkpoint(
    spark: SparkSession, path: str, manifest: DataFrame, run_id: object, rank: int | None = None
) -> DataFrame:
    """What a run has still to read: the feed after the newest checkpoint that it has in a manifest
    (``run_id``, ``step``), or all of it. Steps up to a checkpoint's are done.
    """
    done = manifest.filter(F.col("run_id") == run_id).agg(F.max("step")).first()[0]
    if done is None:
        return read_training_feed(spark, path, rank)
    return feed_from_step(spark, path, done + 1, rank)
