"""Numbering and look-back against brute force, with forced small buckets."""

import datetime as dt
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tunefeed.operators import ordered
from tunefeed.operators.ordered import key_bound, number_file_rows, number_rows, number_within, previous_within
from tunefeed.session import shared_path


def rows_with_a_hot_key(n, seed):
    """A third of all rows has one leading key."""
    rng = random.Random(seed)
    rows = {(7 if i % 3 == 0 else rng.randrange(-50, 10**6), i) for i in range(n)}
    rows = list(rows)
    rng.shuffle(rows)
    return rows


def check_numbering(df, keys, out="p"):
    got = sorted(df.select(*keys, out).collect(), key=lambda r: r[out])
    assert [r[out] for r in got] == list(range(len(got)))
    values = [tuple((v is None, v) for v in r[:-1]) for r in got]
    assert values == sorted(values)
    return got


@pytest.mark.parametrize("per_bucket", [10, 1000, 10**6])
def test_number_rows_with_a_hot_key(spark, per_bucket):
    df = spark.createDataFrame(rows_with_a_hot_key(3000, 1), "a long, b long").repartition(5)
    got = number_rows(df, ["a", "b"], rows_per_bucket=per_bucket)
    assert len(check_numbering(got, ["a", "b"])) == 3000


def test_buckets_split_a_hot_key(spark):
    df = spark.createDataFrame(rows_with_a_hot_key(3000, 2), "a long, b long")
    sizes = ordered._ranged(df, ["a", "b"], 100).groupBy("__bucket").count()
    assert sizes.agg(F.max("count")).first()[0] < 400
    assert sizes.count() >= 20


def test_number_rows_with_nulls_and_extremes(spark):
    values = [None, 0, -1, 2**63 - 1, -(2**63), 5, 6, 2**62]
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "a long, b int")
    assert len(check_numbering(number_rows(df, ["a", "b"], rows_per_bucket=2), ["a", "b"])) == 8
    capped = number_rows(df, ["a", "b"], rows_per_bucket=2, keep_below=3).collect()
    assert sorted(r["a"] for r in capped) == [-(2**63), -1, 0]


def test_number_rows_by_three_wide_keys(spark):
    rng = random.Random(3)
    rows = [tuple(rng.randrange(-(2**62), 2**62) for _ in range(3)) for _ in range(500)]
    df = spark.createDataFrame(rows, "a long, b long, c long")
    assert len(check_numbering(number_rows(df, ["a", "b", "c"], rows_per_bucket=20), ["a", "b", "c"])) == 500


@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp", "date"])
def test_number_rows_by_time(spark, kind):
    start = dt.datetime(1969, 12, 1)
    rows = [(start + dt.timedelta(hours=7 * i, microseconds=i), i) for i in range(400)]
    random.Random(4).shuffle(rows)
    df = spark.createDataFrame(rows, "t timestamp_ntz, i int").withColumn("t", F.col("t").cast(kind))
    assert len(check_numbering(number_rows(df, ["t", "i"], rows_per_bucket=30), ["t", "i"])) == 400
    assert number_rows(df, ["t", "i"], rows_per_bucket=30, keep_below=77).count() == 77


def test_text_keys(spark):
    rng = random.Random(5)
    rows = [(rng.choice(["a", "b", "", None]), "x" * rng.randrange(4), i) for i in range(500)]
    df = spark.createDataFrame(rows, "s string, t string, i int").repartition(3)
    assert len(check_numbering(number_rows(df, ["s", "t", "i"], rows_per_bucket=20), ["s", "t", "i"])) == 500
    some = number_rows(df, ["s", "t", "i"], rows_per_bucket=20, keep_below=33)
    assert len(check_numbering(some, ["s", "t", "i"])) == 33


def test_equal_keys_get_positions_of_their_own(spark):
    df = spark.createDataFrame([(1, "x")] * 50 + [(None, "y")] * 50, "a long, b string")
    numbered = number_rows(df, ["a"], rows_per_bucket=10)
    assert len(check_numbering(numbered, ["a"])) == 100


@pytest.mark.parametrize("shape", ["bulk load", "hot second", "hot first and second", "text"])
def test_no_bucket_is_large_whatever_key_is_hot(spark, shape):
    """Half of the rows share a value of a key that is not the last one."""
    half = F.col("id") % 2 == 0
    wide = F.xxhash64("id")
    keys = {
        "bulk load": [F.lit(1), F.when(half, F.lit(10**15)).otherwise(wide), F.col("id")],
        "hot second": [F.col("id") % 2 * 0, F.when(half, F.lit(2**62)).otherwise(wide), F.col("id")],
        "hot first and second": [F.when(half, F.lit(2**61)).otherwise(wide), F.when(half, F.lit(-(2**61))).otherwise(wide), F.col("id")],
        "text": [F.lit("s"), F.when(half, F.lit("hot")).otherwise(F.hex(wide)), F.lpad(F.col("id").cast("string"), 9, "0")],
    }[shape]
    df = spark.range(20_000).select(*[k.alias(n) for k, n in zip(keys, "abc")])
    sizes = ordered._ranged(df, ["a", "b", "c"], 500).groupBy("__bucket").count()
    assert sizes.agg(F.max("count")).first()[0] <= 1000


def test_rows_without_a_group_are_split(spark):
    df = spark.range(3000).selectExpr("CAST(NULL AS long) AS g", "id AS i")
    cells = ordered._split_groups(df, ["g"], ["i"], 100).groupBy("g", "__bucket").count()
    assert cells.agg(F.max("count")).first()[0] <= 200
    got = number_within(df, ["g"], ["i"], "nth", max_group_rows=100)
    assert got.filter("nth = i + 1").count() == 3000


def test_empty_table(spark):
    df = spark.createDataFrame([], "a long")
    assert number_rows(df, ["a"]).count() == 0
    assert number_rows(df, ["a"], keep_below=5).count() == 0


@pytest.mark.parametrize("keep", [1, 99, 100, 3000, 5000])
def test_keep_below(spark, keep):
    df = spark.createDataFrame(rows_with_a_hot_key(3000, 6), "a long, b long")
    got = check_numbering(number_rows(df, ["a", "b"], rows_per_bucket=50, keep_below=keep), ["a", "b"])
    assert len(got) == min(keep, 3000)
    assert [tuple(r[:2]) for r in got] == sorted(rows_with_a_hot_key(3000, 6))[:keep]


def grouped_rows(seed=8):
    rng = random.Random(seed)
    rows = [(1 if i % 3 == 0 else rng.randrange(2, 40), rng.randrange(10**5), i) for i in range(2000)]
    return rows + [(None, 5, 5000), (None, 4, 5001)]


@pytest.mark.parametrize("limit", [10, 100, 10**6])
def test_within_groups_against_brute_force(spark, limit):
    rows = grouped_rows()
    df = spark.createDataFrame(rows, "g long, t long, i long").repartition(4)
    nth, before, last = {}, {}, {}
    for g, t, i in sorted(rows, key=lambda r: (r[1], r[2])):
        nth[i] = nth.get(last.get(g, (None, None))[1], 0) + 1
        before[i] = last.get(g, (None, None))[0]
        last[g] = (t, i)
    numbered = number_within(df, ["g"], ["t", "i"], "nth", max_group_rows=limit)
    assert dict(numbered.dtypes)["nth"] == "bigint"
    got = {r["i"]: r["nth"] for r in numbered.collect()}
    assert got == nth
    looked = previous_within(df, ["g"], ["t", "i"], "t", "before", max_group_rows=limit)
    assert {r["i"]: r["before"] for r in looked.collect()} == before


def test_previous_keeps_null_values(spark):
    """The preceding row counts even where its value is NULL."""
    rows = [(1, i, None if i % 4 == 1 else i * 10) for i in range(300)]
    df = spark.createDataFrame(rows, "g long, i long, v long")
    expected = {i: (None if i == 0 else rows[i - 1][2]) for i in range(300)}
    for limit in (20, 10**6):
        looked = previous_within(df, ["g"], ["i"], "v", "before", max_group_rows=limit)
        assert {r["i"]: r["before"] for r in looked.collect()} == expected


def test_rows_without_an_order_value_come_last(spark):
    rows = [(1, i, i * 2) for i in range(200)] + [(1, None, -1)]
    df = spark.createDataFrame(rows, "g long, i long, v long").repartition(3)
    for limit in (20, 10**6):
        numbered = number_within(df, ["g"], ["i"], "nth", max_group_rows=limit)
        assert numbered.filter("i IS NULL").first()["nth"] == 201
        looked = previous_within(df, ["g"], ["i"], "v", "before", max_group_rows=limit)
        assert looked.filter("i IS NULL").first()["before"] == 398


@pytest.mark.parametrize("hot", [5, 2**62 + 1, -(2**63), 2**63 - 1])
def test_a_hot_value_in_a_wide_leading_key_is_split(spark, hot):
    """The second key is needed, though the first takes nearly 64 bits."""
    rng = random.Random(12)
    near = [min(max(hot + d, -(2**63)), 2**63 - 1) for d in range(-3, 4)]
    rows = [
        (hot if i % 3 == 0 else near[i % 7] if i % 50 == 1 else rng.randrange(-(2**63), 2**63), i)
        for i in range(3000)
    ] + [(None, i) for i in range(3000, 3010)]
    df = spark.createDataFrame(rows, "a long, b long").repartition(4)
    sizes = ordered._ranged(df, ["a", "b"], 100).groupBy("__bucket").count()
    assert sizes.agg(F.max("count")).first()[0] < 400
    got = check_numbering(number_rows(df, ["a", "b"], rows_per_bucket=100), ["a", "b"])
    assert len(got) == 3010
    assert number_rows(df, ["a", "b"], rows_per_bucket=100, keep_below=1234).count() == 1234


def test_no_group_is_split_when_the_list_of_groups_would_be_too_long(spark, monkeypatch):
    monkeypatch.setattr(ordered, "MAX_BUCKETS", 10)
    df = spark.range(1000).selectExpr("id % 100 AS g", "id AS i")
    got = number_within(df, ["g"], ["i"], "nth", max_group_rows=5)
    assert got.groupBy("nth").count().filter("count = 100").count() == 10


@pytest.mark.parametrize("capped", [None, 500])
def test_input_is_computed_once(spark, capped):
    """Rows that pass a Python stage above are counted there; keys are asked for by themselves."""
    passed = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            passed.add(len(batch))
            yield batch

    df = spark.range(10_000).selectExpr("id AS a", "id % 7 AS b").mapInPandas(count, "a long, b long")
    got = number_rows(df, ["b", "a"], rows_per_bucket=1000)
    assert got.count() == 10_000 and got.agg(F.max("p")).first()[0] == 9999
    assert passed.value == 10_000


@pytest.mark.parametrize(
    ("shape", "keep"),
    [("spread", 1), ("spread", 2999), ("ties", 70), ("ties", 9999), ("one key", 70), ("hot third", 3000), ("nulls", 70), ("text", 5000)],
)
def test_key_bound(spark, monkeypatch, keep, shape):
    monkeypatch.setattr(ordered, "_SAMPLE", 40)
    monkeypatch.setattr(ordered, "_PIVOTS", 8)
    rng = random.Random(keep)
    rows = {
        "spread": [(rng.randrange(10**9), i) for i in range(10_000)],
        "ties": [(rng.randrange(3), rng.randrange(3)) for i in range(10_000)],
        "one key": [(5, 5)] * 10_000,
        "hot third": [(0 if i % 3 else rng.randrange(-9, 9), i) for i in range(10_000)],
        "nulls": [(None if i % 2 else rng.randrange(50), None if i % 5 == 0 else i) for i in range(10_000)],
        "text": [(f"{rng.random():.7f}", i) for i in range(10_000)],
    }[shape]
    kind = "string" if shape == "text" else "long"
    df = spark.createDataFrame(rows, f"a {kind}, b long").repartition(6)
    slack = 50
    bound = key_bound(df, ["a", "b"], keep, slack)
    order = sorted((tuple((v is None, v) for v in r) for r in rows))
    if bound is None:
        assert keep + slack >= 10_000 or shape == "one key" or order[keep - 1] >= order[-1 - slack]
        return
    values = [None if v is None else v if kind == "string" and i == 0 else int(v) for i, v in enumerate(bound)]
    end = tuple((v is None, v) for v in values)
    under = sum(r <= end for r in order)
    assert under >= keep
    # Beyond the slack there are only rows that share the last key.
    assert under <= keep + slack or sum(r < end for r in order) < keep
    if (shape, keep) in (("ties", 70), ("nulls", 70)):
        got = check_numbering(number_rows(df, ["a", "b"], rows_per_bucket=100, keep_below=keep), ["a", "b"])
        assert [tuple((v is None, v) for v in r[:2]) for r in got] == order[:keep]


def test_key_bound_writes_nothing(spark):
    folder = Path(shared_path(spark, "bound").removeprefix("file://").removeprefix("file:")).parent
    folder.mkdir(parents=True, exist_ok=True)
    before = set(folder.iterdir())
    df = spark.range(50_000).selectExpr("xxhash64(id) AS a", "id AS b")
    assert key_bound(df, ["a", "b"], 100, 100) is not None
    assert set(folder.iterdir()) == before


def test_file_rows_over_many_files_and_splits(spark):
    """Lines of all lengths, blank ones among them; splits end in the middle of lines."""
    rng = random.Random(7)
    path, want, n = shared_path(spark, "lines"), [], 0
    for name in ("b 2.json", "a.json", "c.json", "empty.json", "dir.json"):
        lines = []
        for i in range(0 if name.startswith("empty") else 400):
            lines.append(f'{{"f": "{name}", "i": {i}, "t": "{"x" * rng.randrange(300)}"}}')
            if rng.random() < 0.2:
                lines.append("")
        spark.createDataFrame([("\n".join(lines),)], "v string").coalesce(1).write.text(f"{path}/{name}")
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
        df = spark.read.schema("f string, i long, t string").option("recursiveFileLookup", "true").json(path)
        splits = df.select("_metadata.file_path", "_metadata.file_block_start").distinct().count()
        assert splits > 20
        rows = number_file_rows(df).collect()
        some = number_file_rows(df, keep_below=450).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    got = {r.p: (r.f, r.i) for r in rows}
    want = [(name, i) for name in ("a.json", "b 2.json", "c.json", "dir.json") for i in range(400)]
    assert got == dict(enumerate(want)) and rows[0].asDict().keys() == {"f", "i", "t", "p"}
    assert {r.p: (r.f, r.i) for r in some} == dict(enumerate(want[:450]))


@pytest.mark.parametrize("sent", [0, 10**6])
def test_file_rows_through_filters_and_formats(spark, monkeypatch, sent):
    monkeypatch.setattr(ordered, "MAX_SPLITS", sent)
    path = shared_path(spark, "parquet")
    spark.range(1000).repartitionByRange(5, "id").sortWithinPartitions("id").write.parquet(path)
    even = spark.read.parquet(path).filter("id % 2 = 0").withColumn("twice", F.col("id") * 2)
    got = number_file_rows(even, out="n").collect()
    assert sorted((r.n, r.id, r.twice) for r in got) == [(i, 2 * i, 4 * i) for i in range(500)]
    assert number_file_rows(spark.read.parquet(path).filter("id < 0")).count() == 0
