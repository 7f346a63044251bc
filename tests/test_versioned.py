"""Tables in versions: batches that come twice, writers that meet, and old versions."""

import pytest
from pyspark.sql import functions as F

from tunefeed.operators.registry import experiment_table, get_or_create, tag_table, upsert_params, upsert_tags
from tunefeed.session import shared_path
from tunefeed.sources.versioned import VersionedTable

SETTINGS = "run_id string, key string, value string, seq bigint"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture
def tags(spark):
    return tag_table(spark, shared_path(spark, "tags"), buckets=3)


def test_last_tag_wins_across_batches(spark, tags):
    batches = [
        [("a", "k", "1", 1), ("a", "k", "2", 5), ("b", "k", "x", 2), (None, "k", "n", 3)],
        [("a", "k", "late", 4), ("b", "k", None, 9), ("c", "j", "y", None)],
        [("a", "k", "equal", 5), ("c", "j", "z", 0)],
    ]
    for i, batch in enumerate(batches):
        got = rows(upsert_tags(tags, spark.createDataFrame(batch, SETTINGS), "s", i))
        # Played again, even after others, it changes nothing and makes no version.
        for j in range(i + 1):
            assert rows(upsert_tags(tags, spark.createDataFrame(batches[j], SETTINGS), "s", j)) == got
        assert len(tags.versions()) == i + 1
    assert got == rows(spark.createDataFrame([("a", "k", "equal"), ("b", "k", None), ("c", "j", "z"), (None, "k", "n")], "run_id string, key string, value string"))
    # Another stream's batch of that number is another batch.
    assert ("a", "k", "6") in rows(upsert_tags(tags, spark.createDataFrame([("a", "k", "6", 6)], SETTINGS), "t", 0))


def test_versions_stay_readable_until_vacuum(spark, tags):
    seen = []
    for i in range(4):
        upsert_tags(tags, spark.createDataFrame([("r", f"k{j}", f"{i}", i) for j in range(i + 2)], SETTINGS), "s", i)
        seen.append(rows(tags.read()))
    assert [rows(tags.read(tags.version(n))) for n in tags.versions()] == seen
    assert tags.before("s", 2).number == 1 and tags.before("s", 0).number == -1 and rows(tags.read(tags.before("s", 0))) == []
    tags.vacuum(keep=2)
    assert tags.versions() == [2, 3]
    assert [rows(tags.read(tags.version(n))) for n in (2, 3)] == seen[2:]
    tags.vacuum(keep=2)
    assert rows(tags.read()) == seen[3]


def test_only_touched_buckets_are_written(spark, tags):
    upsert_tags(tags, spark.createDataFrame([(f"r{i}", "k", "v", 1) for i in range(60)], SETTINGS))
    first = tags.latest()
    assert len(first.parts) == 3
    upsert_tags(tags, spark.createDataFrame([("r1", "k", "w", 2)], SETTINGS))
    second = tags.latest()
    changed = {k for k in first.parts if first.parts[k] != second.parts[k]}
    assert len(changed) == 1 and tags.read().count() == 60 and tags.read().filter("value = 'w'").count() == 1


def test_a_writer_that_is_overtaken_starts_from_the_new_version(spark, tags, monkeypatch):
    other = VersionedTable(spark, tags.path, tags.schema, tags.keys, tags.buckets)
    commit, overtaken = tags._commit, []

    def late(version):
        if not overtaken:
            overtaken.append(version.number)
            upsert_tags(other, spark.createDataFrame([("r", "k", "other", 2), ("r", "j", "other", 1)], SETTINGS))
        return commit(version)

    monkeypatch.setattr(tags, "_commit", late)
    got = rows(upsert_tags(tags, spark.createDataFrame([("r", "k", "own", 3), ("q", "k", "own", 1)], SETTINGS), "s", 0))
    assert got == [("q", "k", "own"), ("r", "j", "other"), ("r", "k", "own")]
    assert overtaken == [0] and tags.versions() == [0, 1]


def test_a_writer_that_dies_leaves_the_table_as_it_was(spark, tags, monkeypatch):
    upsert_tags(tags, spark.createDataFrame([("r", "k", "v", 1)], SETTINGS), "s", 0)
    more = spark.createDataFrame([("r", "k", "w", 2)], SETTINGS)
    with monkeypatch.context() as patch:
        patch.setattr(tags, "_commit", lambda version: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            upsert_tags(tags, more, "s", 1)
    assert rows(tags.read().drop("seq")) == [("r", "k", "v")]
    assert rows(upsert_tags(tags, more, "s", 1)) == [("r", "k", "w")]


def test_dropped_and_empty_rows(spark, tags):
    tags.upsert(spark.createDataFrame([("r", "k", "v", 1), ("r", "j", "v", 7)], SETTINGS), ["seq"], keep=F.col("seq") > 5)
    assert rows(tags.read().select("key")) == [("j",)]
    tags.upsert(spark.createDataFrame([("r", "j", "v", 8)], SETTINGS), ["seq"], keep=F.col("seq") > 100)
    assert rows(tags.read()) == []
    tags.upsert(spark.createDataFrame([], SETTINGS), ["seq"], "s", 4)
    assert rows(tags.read()) == [] and tags.latest().batches == {"s": 4}


def test_experiments_and_parameters(spark):
    there = experiment_table(spark, shared_path(spark, "experiments"), buckets=2)
    names = spark.createDataFrame([("a",), ("b",), ("a",), (None,)], "name string")
    assert rows(get_or_create(there, names)) == [("a",), ("b",)]
    assert rows(get_or_create(there, spark.createDataFrame([("c",), ("a",)], "name string"))) == [("a",), ("b",), ("c",)]
    params = tag_table(spark, shared_path(spark, "params"))
    kind = "run_id string, key string, value string"
    assert rows(upsert_params(params, spark.createDataFrame([("r", "lr", "0.1")], kind), "s", 0)) == [("r", "lr", "0.1")]
    # A parameter keeps the value it was given first.
    later = spark.createDataFrame([("r", "lr", "0.2"), ("r", "seed", "1")], kind)
    assert rows(upsert_params(params, later, "s", 1)) == [("r", "lr", "0.1"), ("r", "seed", "1")]
