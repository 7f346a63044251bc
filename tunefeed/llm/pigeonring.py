"""SimHash near-duplicates: all links of at most three bits, found by pigeonring filtering.

The 64 bits lie on a ring of four segments of 16. If two fingerprints differ in at most
three bits, some segment begins a chain in which one segment differs in no bit, two
consecutive ones in at most one, three in at most two (each length stays within its share
of the budget, 3/4 bit per segment, rounded down). So for each of the four beginnings,
fingerprints meet on the first 32 bits of the ring read from there, one side also with any
one bit of the second segment turned over. Pairs that meet are held to the chain of three,
then to the full Hamming distance. No link is lost, and a key has 32 bits, not 16.

A key that more than ``HOT`` fingerprints share is refined by the chain of three: 48 bits,
with the turns that the budget leaves. At most 2^16 distinct fingerprints share such a key,
however many documents there are. Equal fingerprints are one node from the start, so copies
are never paired.

Null text: empty; no words: fingerprint 0, linked like any other. Null ids: part of their
group, but never its name; the name is null where all ids are. Empty table: no rows.
Repeated rows come back once each. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunefeed.llm.arrow_text import slices, text_bytes
from tunefeed.llm.components import components
from tunefeed.llm.fingerprints import SHINGLE, fingerprints, with_fingerprint
from tunefeed.session import shared_path

#: Most bits in which linked fingerprints differ.
DISTANCE = 3
#: Distinct fingerprints on a 32-bit key from which on it is refined.
HOT = 2_000

_SEGMENT = 16


def _ring(fp: Column, begin: int) -> Column:
    """The ring read from segment ``begin`` on."""
    if not begin:
        return fp
    shift = _SEGMENT * begin
    return F.shiftleft(fp, shift).bitwiseOR(F.shiftrightunsigned(fp, 64 - shift))


def _turns(most: int) -> list[int]:
    """Masks of a segment with up to ``most`` bits set."""
    one = [1 << i for i in range(_SEGMENT)]
    two = [a | b for a in one for b in one if a < b]
    return [0, *(one if most >= 1 else []), *(two if most >= 2 else [])]


def _keys(begin: int, ring: Column, masks: list[int], segments: int) -> Column:
    """Keys of the first ``segments`` of the ring, under each mask, marked with ``begin``."""
    bits = _SEGMENT * segments
    head = F.shiftrightunsigned(ring, 64 - bits)
    values = F.array(*[F.lit(m).cast("long") for m in masks])
    return F.transform(values, lambda m: F.struct(F.lit(begin).alias("begin"), head.bitwiseXOR(m).alias("head")))


def _explode(nodes: DataFrame, masks: list[int], segments: int) -> DataFrame:
    keys = F.flatten(F.array(*[_keys(i, _ring(F.col("fp"), i), masks, segments) for i in range(4)]))
    return nodes.select("fp", F.explode(keys).alias("key")).select("fp", "key.begin", "key.head")


def _linked(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Pairs on a key that keep to the chain of three and to the distance."""
    pairs = left.join(right.withColumnRenamed("fp", "other"), on)
    differing = F.col("fp").bitwiseXOR(F.col("other"))
    chain = F.lit(64)
    for begin in range(4):
        three = F.bit_count(F.shiftrightunsigned(_ring(differing, begin), _SEGMENT))
        chain = F.when(F.col("begin") == begin, three).otherwise(chain)
    return pairs.filter((F.col("fp") < F.col("other")) & (chain <= 2) & (F.bit_count(differing) <= DISTANCE)).selectExpr("fp AS u", "other AS v")


def links(nodes: DataFrame) -> DataFrame:
    """Pairs u < v of distinct fingerprints (column fp) at ``DISTANCE`` bits or fewer.

    A pair comes back once for each beginning at which its chain holds.
    """
    spark = nodes.sparkSession
    index, probes = _explode(nodes, [0], 2), _explode(nodes, _turns(1), 2)
    path = shared_path(spark, "hot-keys")
    index.groupBy("begin", "head").count().filter(F.col("count") > HOT).select("begin", "head").write.parquet(path)
    hot = spark.read.parquet(path)
    on = ["begin", "head"]
    if hot.isEmpty():
        return _linked(probes, index, on)
    cool = _linked(probes, index.join(hot, on, "left_anti"), on)
    longer = F.struct("begin", F.shiftrightunsigned(F.col("ring"), 16).alias("head"))
    ring = F.lit(None).cast("long")
    for begin in range(4):
        ring = F.when(F.col("begin") == begin, _ring(F.col("fp"), begin)).otherwise(ring)
    third = index.join(hot, on, "left_semi").withColumn("ring", ring).select("fp", longer.alias("key")).select("fp", "key.*")
    asked = probes.join(hot, on, "left_semi").withColumn("ring", ring)
    # Where the second segment was turned already, one bit less is left for the third.
    turned = F.col("head") != F.shiftrightunsigned(F.col("ring"), 32)
    segment = F.col("ring").bitwiseAND(F.lit(0xFFFF0000).cast("long"))
    masks = [F.array(*[F.lit(m).cast("long") for m in _turns(n)]) for n in (1, 2)]
    heads = F.transform(
        F.when(turned, masks[0]).otherwise(masks[1]),
        lambda m: F.shiftleft("head", 16).bitwiseOR(F.shiftrightunsigned(segment, 16).bitwiseXOR(m)),
    )
    asked = asked.select("fp", "begin", F.explode(heads).alias("head"))
    return cool.unionAll(_linked(asked, third, on))


def near_duplicates(df: DataFrame, *, key: str = "doc_id", text: str = "text", size: int = SHINGLE) -> DataFrame:
    """``key``, fingerprint (16 hex digits) and component_id of each row."""
    spark = df.sparkSession
    path = shared_path(spark, "fingerprints")
    with_fingerprint(df, key=key, text=text, size=size).write.parquet(path)
    rows = spark.read.parquet(path)
    names = component_names(rows)
    return rows.join(names, "fp", "left").select(F.col("key").alias(key), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(df: DataFrame, *, key: str = "doc_id", text: str = "text", size: int = SHINGLE) -> DataFrame:
    """One row of ``df`` per group of near-duplicates: that with the smallest key (null last).

    Rows are written with their fingerprint and a number first, so that one row is kept even
    where keys repeat or are null.
    """
    spark = df.sparkSession
    path, columns = shared_path(spark, "numbered"), df.columns
    at = columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, at):
            found = pa.array(fingerprints(*text_bytes(part.column(at)), size).view(np.int64))
            yield pa.RecordBatch.from_arrays([*part.columns, found], [*columns, "__fp"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    df.mapInArrow(run, f"{fields}, __fp long").withColumn("__row", F.monotonically_increasing_id()).write.parquet(path)
    rows = spark.read.parquet(path)
    narrow = rows.select(F.col(key).alias("key"), F.col("__fp").alias("fp"), "__row")
    roots = component_names(narrow.select("key", "fp")).select("fp", "root")
    first = F.min(F.struct(F.col("key").isNull(), "key", "__row"))
    kept = narrow.join(roots, "fp").groupBy("root").agg(first.alias("first")).select("first.__row")
    return rows.join(kept, "__row", "left_semi").select(columns)


def component_names(rows: DataFrame) -> DataFrame:
    """fp, root and component_id (smallest key reachable) of each distinct fp of (key, fp)."""
    spark = rows.sparkSession
    path = shared_path(spark, "nodes")
    rows.groupBy("fp").agg(F.min("key").alias("least")).write.parquet(path)
    nodes = spark.read.parquet(path)
    roots = components(links(nodes.select("fp"))).withColumnRenamed("node", "fp")
    rooted = nodes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rooted.select("fp", "root").join(named, "root")
