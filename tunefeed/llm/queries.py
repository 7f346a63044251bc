"""One query per operator, over whole tables; SQL where it can say the same."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tunefeed.llm.collocations import collocations
from tunefeed.llm.kmeans_tree import nearest
from tunefeed.llm.language_id import languages
from tunefeed.llm.license_notices import find_notices, notice_summary
from tunefeed.llm.lm_scoring import score_documents
from tunefeed.llm.packing import pack_documents
from tunefeed.llm.personal_data import find_personal_data
from tunefeed.llm.pigeonring import near_duplicates
from tunefeed.llm.positional_index import build_index, contamination
from tunefeed.llm.secret_scan import scan
from tunefeed.llm.sharding import shard_rows
from tunefeed.llm.token_counts import count_tokens
from tunefeed.llm.whitening import whiten
from tunefeed.session import ship_package


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.coalesce("text", F.lit(""))
    rows = _table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(raw) + 1).cast("long").alias("size"), F.crc32(raw.cast("binary")).alias("text_crc32")
    )
    law, grown = F.lit("rows").alias("law"), F.lit(None).cast("int").alias("grown_shard")
    return shard_rows(rows, 8).select("doc_id", "size", "text_crc32", law, "shard", "slot", grown)


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(_table(spark, sf_dir, "documents"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(_table(spark, sf_dir, "documents"))
    length = F.length("secret").cast("long").alias("length")
    return found.select("doc_id", "nth", length, F.sha2("secret", 256).alias("secret_sha256"), "probability")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languages(_table(spark, sf_dir, "documents"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(build_index(_table(spark, sf_dir, "documents")), _table(spark, sf_dir, "benchmark"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op8_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(_table(spark, sf_dir, "embeddings"))


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_personal_data(_table(spark, sf_dir, "documents"))


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"))


def op11_license_notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return notice_summary(find_notices(_table(spark, sf_dir, "documents")))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    white = whiten(_table(spark, sf_dir, "embeddings"))
    return white.withColumn("deviation", F.expr("try_cast(deviation AS bigint)"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(_table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_sharding": op1_sharding,
    "op2_lm_scoring": op2_lm_scoring,
    "op3_secret_scan": op3_secret_scan,
    "op4_language_id": op4_language_id,
    "op5_decontamination": op5_decontamination,
    "op6_packing": op6_packing,
    "op7_token_counts": op7_token_counts,
    "op8_nearest_neighbours": op8_nearest_neighbours,
    "op9_personal_data": op9_personal_data,
    "op10_near_duplicates": op10_near_duplicates,
    "op11_license_notices": op11_license_notices,
    "op12_whitening": op12_whitening,
    "op13_collocations": op13_collocations,
}

#: The other queries are random, trained, tokenized, iterative or fuzzy, which SQL is not.
ORACLES: dict[str, str] = {
    "op13_collocations": r"""
WITH texts AS (
  SELECT coalesce(lang, 'und') AS lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents),
pieces AS (SELECT lang, unnest(regexp_extract_all(text, '[^.,;:!?\x0A-\x0D]+')) AS piece FROM texts),
listed AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM pieces),
totals AS (SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM listed GROUP BY lang),
placed AS (SELECT lang, ws, size, unnest(range(1, len(ws) - size + 2)) AS i FROM listed, range(1, 6) AS s(size)),
counted AS (SELECT lang, ws[i : i + size - 1] AS ws, count(*) AS f FROM placed GROUP BY ALL HAVING count(*) >= 100),
candidates AS (SELECT lang, ws, f AS a FROM counted WHERE len(ws) > 1),
parts AS (
  SELECT lang, a, ws, size, unnest(range(1, len(ws) - size + 2)) AS i
  FROM candidates, range(2, 5) AS s(size) WHERE size < len(ws)),
held AS (SELECT lang, ws[i : i + size - 1] AS ws, max(a) AS most FROM parts GROUP BY ALL),
kept AS (
  SELECT c.* FROM candidates c LEFT JOIN held h ON c.lang = h.lang AND c.ws = h.ws
  WHERE h.most IS NULL OR 100 * h.most < 100 * c.a),
cuts AS (SELECT lang, ws, a, unnest(range(1, len(ws))) AS k FROM kept),
scored AS (
  SELECT c.*, p.f AS l, q.f AS r, n, (1000 * a::HUGEINT * n) // (p.f::HUGEINT * q.f) AS score
  FROM cuts c JOIN counted p ON p.lang = c.lang AND p.ws = c.ws[1 : k]
  JOIN counted q ON q.lang = c.lang AND q.ws = c.ws[k + 1 :] JOIN totals t ON t.lang = c.lang),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, ws ORDER BY score, k) = 1),
ranked AS (
  SELECT lang, array_to_string(ws, ' ') AS phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM lowest)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
       phrase, a, l, r, n, score FROM ranked QUALIFY rank <= 2000""",
}
