"""Uniform shuffle into shards of exact sizes by a hypergeometric communication matrix.

1. Rows are permuted within their partitions and written with their places.
2. From the partitions' row counts the driver draws how many rows each partition sends to
   each shard, so that the matrix is distributed as under a uniform permutation of all
   rows: hypergeometric, one partition after the other, with exact row and column sums.
3. A partition's first rows go to shard 0, the next to shard 1, ...; rows are exchanged.
4. Each shard is permuted again: its rows fall into ranges of a random key, are numbered
   within a range, and ranges are added up. Slots 0, 1, 2, ... leave no gap.

All row work is built-in expressions. The driver holds one number per partition and shard,
at most ``BLOCKS`` partitions. The written table makes every later step, and a task that
runs again, see the same partitions. Random numbers are hashes of the seed and the place.

Shard sizes differ by one row at most (the first shards get one more). Any values, nulls
and repeated rows are rows like others; an empty table gives none. Columns named ``shard``
or ``slot`` are replaced; other names may be anything.
"""

from __future__ import annotations

import json
import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tunefeed.session import shared_path

#: Partitions that the rows are dealt from, at most.
BLOCKS = 10_000
#: Rows of a shard that are numbered in one range, about.
RANGE_ROWS = 50_000


def _hypergeometric(rng: np.random.Generator, good: int, bad: int, draws: int) -> int:
    """How many of ``draws`` from good + bad are good; exact to rounding for any size.

    Inversion over the support within 40 standard deviations of the mean.
    """
    low, high = max(0, draws - bad), min(draws, good)
    if low == high:
        return low
    total = good + bad
    mean = draws * (good / total)
    spread = math.sqrt(mean * (bad / total) * ((total - draws) / max(total - 1, 1))) * 40 + 40
    low, high = max(low, math.floor(mean - spread)), min(high, math.ceil(mean + spread))
    x = np.arange(low, high, dtype=np.float64)
    step = np.log(good - x) + np.log(draws - x) - np.log(x + 1) - np.log(bad - draws + x + 1)
    log_mass = np.concatenate([[0.0], np.cumsum(step)])
    mass = np.cumsum(np.exp(log_mass - log_mass.max()))
    return low + int(np.searchsorted(mass, rng.random() * mass[-1], side="right"))


def communication_matrix(rows: list[int], shards: int, seed: int) -> list[list[int]]:
    """Rows that each partition sends to each shard."""
    rng = np.random.Generator(np.random.PCG64(seed))
    total = sum(rows)
    room = [total // shards + (i < total % shards) for i in range(shards)]
    matrix = []
    for n in rows:
        left, line = sum(room), []
        for i, free in enumerate(room):
            left -= free
            taken = _hypergeometric(rng, free, left, n)
            line.append(taken)
            room[i] -= taken
            n -= taken
        matrix.append(line)
    return matrix


def shard_rows(df: DataFrame, shards: int = 8, *, seed: int = 17) -> DataFrame:
    """The columns of ``df`` with shard (int) and slot (long)."""
    spark = df.sparkSession
    path = shared_path(spark, "permuted")
    kept = [c for c in df.columns if c not in ("shard", "slot")]
    draw = F.xxhash64(F.lit(seed), F.monotonically_increasing_id())
    permuted = df.coalesce(BLOCKS).select(F.struct(*kept).alias("row"), draw.alias("draw")).sortWithinPartitions("draw")
    permuted.select("row", F.monotonically_increasing_id().alias("place")).write.parquet(path)

    # The place's upper bits are the partition, the lower 33 the position in it.
    placed = spark.read.parquet(path).withColumns({"block": F.shiftright("place", 33), "at": F.col("place").bitwiseAND((1 << 33) - 1)})
    counts = sorted((r.block, r["count"]) for r in placed.groupBy("block").count().collect())
    matrix = communication_matrix([n for _, n in counts], shards, seed)
    bounds = [{"block": b, "upto": np.cumsum(line).tolist()} for (b, _), line in zip(counts, matrix, strict=True)]
    sent = spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(bounds)), "array<struct<block:bigint,upto:array<bigint>>>")))
    shard = F.size(F.filter("upto", lambda bound: bound <= F.col("at")))
    # At most BLOCKS rows of one number per shard.
    dealt = placed.join(F.broadcast(sent), "block").select("row", "place", shard.alias("shard"))

    total = sum(n for _, n in counts)
    bits = max(0, math.ceil(math.log2(max(1, total / shards / RANGE_ROWS))))
    dealt = dealt.withColumn("draw", F.xxhash64(F.lit(seed + 1), "place"))
    dealt = dealt.withColumn("range", F.shiftrightunsigned("draw", 63 - bits).bitwiseAND((1 << bits) - 1))
    sizes = dealt.groupBy("shard", "range").count()
    before = F.sum("count").over(Window.partitionBy("shard").orderBy("range")) - F.col("count")
    starts = sizes.select("shard", "range", before.alias("start"))
    number = F.row_number().over(Window.partitionBy("shard", "range").orderBy("draw", "place")) - 1
    numbered = dealt.select("row", "shard", "range", number.alias("number"))
    slot = (F.col("start") + F.col("number")).alias("slot")
    return numbered.join(starts, ["shard", "range"]).select("row.*", "shard", slot)
