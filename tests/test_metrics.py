import datetime as dt
import json
import math

import pytest
from pyspark.sql import functions as F

from tunefeed.operators.metrics import (
    cadence,
    eval_metrics,
    explode_metrics,
    final_metrics,
    metric_key_rejects,
    metric_rejects,
    rank0_only,
    time_per_step,
    time_per_step_metric,
)

NAN, INF = float("nan"), float("inf")


def log_frame(spark, logs):
    return spark.createDataFrame(
        [(1, i, text) for i, text in enumerate(logs)], "run_id long, step long, logs string"
    )


def exploded(df):
    return {(r["step"], r["key"]): r["value"] for r in explode_metrics(df).collect()}


def test_only_numbers_and_booleans_count(spark):
    record = {
        "i": 1, "f": 1.5, "t": True, "n": False, "s": "1.5", "none": None, "l": [1], "d": {"a": 1},
        "small": 1e-7, "large": 1e300, "int64": 2**63, "dec": 123456.789,
    }
    got = exploded(log_frame(spark, [json.dumps(record)]))
    expected = {
        (0, k): float(v) for k, v in record.items() if isinstance(v, (int, float))
    }
    assert got == expected


def test_empty_and_missing_records_give_nothing(spark):
    df = log_frame(spark, ["{}", None, "null", " null "])
    assert exploded(df) == {}
    assert metric_rejects(df).count() == 0


def test_nonfinite_numbers_are_kept(spark):
    record = json.dumps({"a": NAN, "b": INF, "c": -INF, "note": "NaN, or so", "d": 1})
    got = exploded(log_frame(spark, [record]))
    assert math.isnan(got.pop((0, "a")))
    assert got == {(0, "b"): INF, (0, "c"): -INF, (0, "d"): 1.0}


def test_a_broken_record_is_rejected_alone(spark):
    df = log_frame(spark, ['{"loss":', '{"loss": 1}', "[1]", "3", "", '{"loss": 2', "{'a': 1}"])
    assert exploded(df) == {(1, "loss"): 1.0}
    got = {r["step"]: r["reason"] for r in metric_rejects(df).collect()}
    bad, other = "not JSON", "not a JSON object"
    assert got == {0: bad, 2: other, 3: other, 4: bad, 5: bad, 6: bad}


def test_eval_final_and_rank(spark):
    rows = [(1, 10, 0, "train", '{"loss": 1}'), (1, 10, 0, "eval", '{"loss": 2, "s": "x"}'), (1, 20, 1, "train", '{"loss": 3}'), (1, 20, 0, "final", '{"loss": 4, "t": 5}')]
    df = spark.createDataFrame(rows, "run_id long, step long, global_rank int, kind string, logs string")
    assert [tuple(r) for r in eval_metrics(df).collect()] == [(1, 10, "eval_loss", 2.0)]
    assert rank0_only(df).count() == 3
    assert {tuple(r) for r in final_metrics(df).collect()} == {(1, "loss", 4.0, None), (1, "t", 5.0, None)}


@pytest.mark.parametrize("logging_steps, divisor", [(10, 10), (1, 1), (0, 1), (-3, 1)])
@pytest.mark.parametrize("limit", [3, 10**6])
def test_time_per_step(spark, logging_steps, divisor, limit):
    start = dt.datetime(2024, 3, 10, 1, 59, 58)
    rows = [(1, i, start + dt.timedelta(milliseconds=1500 * i)) for i in range(20)]
    rows += [(2, 100 + i, start + dt.timedelta(minutes=i)) for i in range(3)]
    df = spark.createDataFrame(rows, "run_id long, step long, logged_at timestamp_ntz")
    timed = time_per_step(df, logging_steps, limit)
    got = {r["step"]: r["time_per_step"] for r in timed.collect()}
    assert got[0] is None and got[100] is None
    assert all(got[i] == 1.5 / divisor for i in range(1, 20))
    assert all(got[i] == 60.0 / divisor for i in (101, 102))
    metric = time_per_step_metric(timed, ("run_id",))
    assert metric.count() == 21 and metric.columns == ["run_id", "key", "value"]


def test_cadence(spark):
    rows = cadence(spark.range(0, 1001, 10).withColumnRenamed("id", "step")).collect()
    assert all(r["log_due"] for r in rows)
    assert [r["step"] for r in rows if r["save_due"]] == [0, 200, 400, 600, 800, 1000]
    assert [r["step"] for r in rows if r["upload_due"]] == list(range(0, 1001, 100))
    assert cadence(spark.range(25).select(F.col("id").alias("step"))).filter("log_due").count() == 3


def test_zero_cadence_counts_as_one(spark):
    row = cadence(spark.range(7, 8).withColumnRenamed("id", "step"), log_every=0, save_every=-2).first()
    assert row["log_due"] and row["save_due"]


@pytest.mark.parametrize(
    "text",
    ['{"loss": 1.0}{"loss": 2.0}', '{"loss": 1.0} garbage', '{"a": 1}, {"a": 2}', '{"a": 1}] x', '{"a": 1}]', '{"a": 1}, "end": 1', '{"a": 1}} ', '{"a": 1', '] {"a": 1}', '{"a": 1},', '{"a": 1},"x":{"b":2}'],
)
def test_text_after_the_object_is_a_reject(spark, text):
    df = log_frame(spark, [text, '{"b": 2}'])
    assert exploded(df) == {(1, "b"): 2.0}
    assert [(r["step"], r["reason"]) for r in metric_rejects(df).collect()] == [(0, "not JSON")]


def test_keys_are_rejected_alone(spark):
    df = log_frame(spark, ['{"a": 1, "b": 2, "a": 3}', '{"big": 1%s, "x": 4, "i": Infinity, "e": 1e400}' % ("0" * 400), '{"s": "t", "s": "u"}'])
    assert exploded(df) == {(0, "b"): 2.0, (1, "x"): 4.0, (1, "i"): INF, (1, "e"): INF}
    got = sorted((r["step"], r["key"], r["reason"]) for r in metric_key_rejects(df).collect())
    assert got == [(0, "a", "duplicate key")] * 2 + [(1, "big", "out of range")]
    assert metric_rejects(df).count() == 0
