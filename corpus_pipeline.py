"""From raw documents to training sequences.

``STAGES`` run in order; each takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next one's ``docs``. All but the last return the
columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tunefeed.llm.language_id import identify, train
from tunefeed.llm.packing import pack_documents
from tunefeed.llm.personal_data import mask_personal_data
from tunefeed.llm.pigeonring import keep_one
from tunefeed.llm.positional_index import drop_contaminated
from tunefeed.session import shared_path, ship_package


#: Columns that stages read.
USED = ("doc_id", "text", "lang", "n_chars")


def _aside(docs: DataFrame) -> DataFrame:
    """Other columns under names that no operator gives to columns of its own."""
    return docs.toDF(*[c if c in USED else f"extra_{i}" for i, c in enumerate(docs.columns)])


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the classifier, trained on their labels, does not reject."""
    ship_package(spark)
    plain = _aside(docs)
    return identify(plain, train(plain)).filter("NOT rejected").select(plain.columns).toDF(*docs.columns)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates, the document with the smallest id."""
    ship_package(spark)
    return keep_one(_aside(docs)).toDF(*docs.columns)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item stands."""
    ship_package(spark)
    return drop_contaminated(_aside(docs), spark.read.parquet(f"{sf_dir}/benchmark.parquet")).toDF(*docs.columns)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind; n_chars follows the text."""
    ship_package(spark)
    masked = mask_personal_data(docs)
    return masked.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), "n_chars")).select(docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' token sequences in windows of 1024."""
    ship_package(spark)
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("language_id", known_language),
    ("near_dedup", without_near_copies),
    ("decontamination", without_benchmark),
    ("personal_data", without_personal_data),
    ("packing", packed),
]

#: SQL has neither tokenizers nor trained models.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the table ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = shared_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
