"""Connected components of a graph held as edges, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunefeed.session import shared_path


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the smallest node reachable) for each node of an edge.

    ``edges``: columns u and v of one orderable type; directions, repeats and loops do not
    matter. Each round hangs neighbours on the smallest node nearby, first the larger ones,
    then the smaller ones; the number of rounds grows with the logarithm of a component's
    size. A node with any number of neighbours is summed up with partial aggregation, and no
    group is gathered. Rounds are written to the shared folder.
    """
    state, table = None, _stored(edges.filter("u <> v").selectExpr("greatest(u, v) AS u", "least(u, v) AS v").distinct())
    while True:
        now = table.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
        table = _stored(_small_star(_large_star(table)))
    roots = table.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return table.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(roots)


def _stored(edges: DataFrame) -> DataFrame:
    path = shared_path(edges.sparkSession, "edges")
    edges.write.parquet(path)
    return edges.sparkSession.read.parquet(path)


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionAll(edges.selectExpr("v AS u", "u AS v"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).selectExpr("u", "least(u, m) AS m")
    return both.join(least, "u").filter("v > u").selectExpr("v AS u", "m AS v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    others = edges.join(least, "u").filter("v <> m").selectExpr("v AS u", "m AS v")
    return others.unionAll(least.selectExpr("u", "m AS v")).distinct()
