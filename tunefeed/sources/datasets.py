"""Named datasets and JSON-lines files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tunefeed.functions.messages import MESSAGES

# Columns an instruction dataset may have; give your own schema for more.
EXAMPLE_SCHEMA = T.StructType(
    [
        T.StructField("instruction", T.StringType()),
        T.StructField("input", T.StringType()),
        T.StructField("output", T.StringType()),
        T.StructField("conversations", MESSAGES),
    ]
)


def load_split(
    spark: SparkSession, base: str, dataset: str, split: str | None = None
) -> DataFrame:
    """Parquet dataset ``base/dataset``; a split is a ``split=`` directory of it.

    The filter on the directory name prunes the listing: other splits are not
    read. A data set without such directories is one split, whatever its name.
    """
    df = spark.read.parquet(f"{base.rstrip('/')}/{dataset}")
    if split is None or "split" not in df.columns:
        return df
    return df.filter(F.col("split") == split).drop("split")


def read_jsonl(
    spark: SparkSession, path: str | list[str], schema: T.StructType | None = None
) -> DataFrame:
    """JSON lines with all their columns; a broken line stops the job.

    Without a schema the types are inferred over all lines, which reads the file
    once more; ``EXAMPLE_SCHEMA``'s columns are always there, with its types. A
    field that is absent is NULL.
    """
    reader = spark.read.option("mode", "FAILFAST")
    if schema is None:
        known = {f.name for f in EXAMPLE_SCHEMA}
        others = [f for f in reader.json(path).schema if f.name not in known]
        schema = T.StructType([*others, *EXAMPLE_SCHEMA])
    return reader.schema(schema).json(path)


def write_jsonl(df: DataFrame, path: str) -> None:
    """A directory of JSON-lines files: raw UTF-8, NULL written as ``null``."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def resolve_source(
    spark: SparkSession,
    base: str,
    dataset: str,
    jsonl_path: str = "",
    split: str | None = "train",
    schema: T.StructType | None = None,
) -> DataFrame:
    """The JSON-lines path when given, else the named dataset."""
    if jsonl_path:
        return read_jsonl(spark, jsonl_path, schema)
    return load_split(spark, base, dataset, split)
