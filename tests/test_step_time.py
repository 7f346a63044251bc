"""Step time on the stream: equal to the batch operator, whatever the cut into batches."""

import datetime as dt
import random

import pytest

from tunefeed.operators.metrics import time_per_step
from tunefeed.session import shared_path
from tunefeed.streaming import step_time
from tunefeed.streaming.metric_stream import LOG_SCHEMA, read_log_stream
from tunefeed.streaming.step_time import read_step_times, write_step_time_stream

START = dt.datetime(2024, 5, 1)


def record(run, step, seconds):
    at = None if seconds is None else START + dt.timedelta(seconds=seconds)
    return (run, step, at, 0, "train", "{}")


class Arrivals:
    """Log files that come one after the other, and a stream that is started for each."""

    def __init__(self, spark):
        self.spark, self.base, self.n = spark, shared_path(spark, "arrivals"), 0

    def come(self, rows, **settings):
        df = self.spark.createDataFrame(rows, LOG_SCHEMA).repartition(2)
        df.write.option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").json(f"{self.base}/logs/{self.n}")
        self.n += 1
        self.run(**settings)
        return self.times()

    def run(self, **settings):
        stream = read_log_stream(self.spark, f"{self.base}/logs/*")
        b = self.base
        write_step_time_stream(stream, f"{b}/times", f"{b}/state", f"{b}/checkpoint", **settings).awaitTermination()

    def times(self):
        rows = read_step_times(self.spark, f"{self.base}/times").collect()
        return sorted(((r.run_id or "", r.step, r.time_per_step, r.late) for r in rows), key=str)


@pytest.mark.parametrize("limit", [10**6, 5])
def test_equals_the_batch_operator(spark, limit):
    rng = random.Random(1)
    rows, at = [], 0
    for i in range(120):
        at += rng.choice([0, 0.000001, 1, 7.5])
        # One run has half of the records, and some have no run.
        rows.append(record(rng.choice(["hot", "hot", "hot", "a", "b", None]), i, at))
    batch = time_per_step(spark.createDataFrame(rows, LOG_SCHEMA)).collect()
    want = sorted(((r.run_id or "", r.step, r.time_per_step, False) for r in batch), key=str)
    arrivals = Arrivals(spark)
    for begin in range(0, 120, 40):
        got = arrivals.come(rng.sample(rows[begin : begin + 40], 40), max_run_rows=limit)
    assert got == want
    arrivals.run()  # nothing new has come
    assert arrivals.times() == want


def test_late_records_and_records_without_time(spark):
    arrivals = Arrivals(spark)
    arrivals.come([record("a", 1, 10), record("a", 2, 20), record("b", 1, 15)])
    got = arrivals.come([record("a", 3, 40), record("a", 9, 12), record("a", 8, None), record("c", 1, 1), record("b", 2, 15)], logging_steps=10)
    assert got == sorted(
        [("a", 1, None, False), ("a", 2, 1.0, False), ("b", 1, None, False), ("a", 3, 2.0, False), ("a", 9, None, True), ("a", 8, None, False), ("c", 1, None, False), ("b", 2, 0.0, False)],
        key=str,
    )
    # Neither the late record nor the one without a time is what the next one is measured from.
    assert ("a", 4, 1.5, False) in arrivals.come([record("a", 4, 55)])


def test_timeout(spark):
    arrivals, hour = Arrivals(spark), {"timeout": dt.timedelta(hours=1), "logging_steps": 1}
    arrivals.come([record("a", 1, 0), record("b", 1, 0), record("a", 2, 3600), record("a", 3, 7201)], **hour)
    # Record 3 came over an hour after record 2; b is over an hour behind and forgotten.
    assert ("a", 2, 3600.0, False) in arrivals.times() and ("a", 3, None, False) in arrivals.times()
    state = step_time.VersionedTable(spark, f"{arrivals.base}/state", "run_id string, __at timestamp_ntz, __tie bigint", ["run_id"])
    assert [r.run_id for r in state.read().collect()] == ["a"]
    got = arrivals.come([record("b", 2, 3000), record("b", 3, 4000), record("a", 4, 7301)], **hour)
    assert ("b", 2, None, True) in got and ("b", 3, None, False) in got and ("a", 4, 100.0, False) in got


@pytest.mark.parametrize("where", ["before", "after"])
def test_a_batch_that_fails_is_played_again(spark, monkeypatch, where):
    """Whether or not its state had been committed, its rows are there once and right."""
    arrivals = Arrivals(spark)
    arrivals.come([record("a", 1, 10), record("b", 1, 10)])
    upsert = step_time.VersionedTable.upsert

    def failing(self, *args, **settings):
        if where == "after":
            upsert(self, *args, **settings)
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(step_time.VersionedTable, "upsert", failing)
        with pytest.raises(Exception, match="lost"):
            arrivals.come([record("a", 2, 20), record("b", 2, 40)])
    arrivals.run()
    got = arrivals.come([record("a", 3, 50)])
    assert got == sorted([("a", 1, None, False), ("b", 1, None, False), ("a", 2, 1.0, False), ("b", 2, 3.0, False), ("a", 3, 3.0, False)], key=str)


def test_records_without_a_run_are_one_run(spark):
    arrivals = Arrivals(spark)
    arrivals.come([record(None, 1, 1)])
    arrivals.come([record(None, 2, 11), record("", 3, 12)])
    assert {t[1]: t[2] for t in arrivals.times()} == {1: None, 2: 1.0, 3: None}
