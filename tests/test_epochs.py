"""The order of rows per epoch: a bijection, for any number of rows, and its inverse."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tunefeed.operators import epochs
from tunefeed.operators.batching import BatchPlan
from tunefeed.operators.epochs import epoch_order, grid, longest_walk, permuted, plan_epoch, round_keys


def in_memory(n, keys):
    at = permuted(np.arange(n, dtype=np.int64), n, keys)
    for _ in range(longest_walk(n, keys)):
        at = np.where(at >= n, permuted(at, n, keys), at)
    return at


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 7, 13, 97, 100, 7919, 999_983, 10**6])
@pytest.mark.parametrize("epoch", [0, 5])
def test_bijective(n, epoch):
    at = in_memory(n, round_keys(1, epoch))
    assert at.min() == 0 and at.max() == n - 1 and np.unique(at).size == n


def test_looks_random():
    at = in_memory(99_991, round_keys(4, 2))
    assert abs(np.corrcoef(np.arange(at.size), at)[0, 1]) < 0.02
    # Neighbours do not stay neighbours, and every tenth of the rows is spread over all tenths.
    assert (np.abs(np.diff(at)) < 100).mean() < 0.01
    cells = np.histogram2d(np.arange(at.size), at, bins=10)[0]
    assert abs(cells / cells.mean() - 1).max() < 0.15
    other = in_memory(99_991, round_keys(4, 3))
    assert (at == other).mean() < 0.001


@pytest.mark.parametrize("n", [1, 2, 11, 5012])
def test_columns_equal_arrays_and_go_back(spark, n):
    df = spark.range(n).select(F.col("id").alias("p"), F.lit("x").alias("kept"))
    got = epoch_order(df, n, epoch=3, seed=9)
    back = epoch_order(got, n, epoch=3, seed=9, position="p_epoch", out="p_back", inverse=True)
    rows = sorted(back.collect())
    assert [r.p_epoch for r in rows] == in_memory(n, round_keys(9, 3)).tolist()
    assert all(r.p_back == r.p and r.kept == "x" for r in rows) and back.columns == ["p", "kept", "p_epoch", "p_back"]
    assert back.schema["p_epoch"].dataType.simpleString() == "bigint"


def test_large_positions_stay_exact(spark):
    """No table of that size is needed, as places come from positions alone."""
    n = 10**12 + 39
    some = np.random.default_rng(0).integers(0, n, 200)
    df = spark.createDataFrame([(int(p),) for p in some] + [(0,), (n - 1,)], "p long")
    there = epoch_order(df, n, epoch=1)
    back = epoch_order(there, n, epoch=1, position="p_epoch", out="p_back", inverse=True).collect()
    assert all(r.p == r.p_back and 0 <= r.p_epoch < n for r in back)
    with pytest.raises(ValueError):
        epoch_order(df, 2**61, epoch=0)


def test_no_shuffle_and_no_repeated_rounds(spark):
    ordered = epoch_order(spark.range(5012).toDF("p"), 5012, 0).filter("p_epoch % 3 = 1").selectExpr("p_epoch + 1 AS q", "p_epoch * 2 AS r")
    plan = ordered._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and len(plan) < 60_000
    a, b = grid(5012)
    assert (a - 1) * b < 5012 <= a * b


def test_walk_ends_where_places_only_lead_to_each_other(monkeypatch):
    """Rounds that keep all places: those that are no positions are cycles by themselves."""
    monkeypatch.setattr(epochs, "permuted", lambda at, n, keys, inverse=False: at)
    assert longest_walk(7, round_keys(0, 0)) == 0


def test_plan_epoch(spark):
    n, plan = 70, BatchPlan(world_size=2, per_device_batch=1, accumulation=4)
    rows = spark.range(n).toDF("p")
    both = [plan_epoch(rows, n, e, plan).collect() for e in (0, 1)]
    assert [{r.step for r in got} for got in both] == [set(range(1, 10)), set(range(10, 19))]
    for e, got in enumerate(both):
        assert sorted(r.p for r in got) == list(range(n))
        assert all(r.rank == r.p_epoch % 2 and r.step == r.p_epoch // 8 + 1 + 9 * e for r in got)
    capped = BatchPlan(world_size=2, per_device_batch=1, accumulation=4, max_steps=11)
    assert {r.step for r in plan_epoch(rows, n, 1, capped).collect()} == {10, 11}
