import random
import struct

from pyspark.sql import functions as F

from tunefeed.functions.paths import checkpoint_path, user_path
from tunefeed.operators.registry import (
    checkpoint_retention,
    checkpoints,
    get_or_create_experiments,
    missing_experiments,
    run_params,
    run_tags,
)


def test_newest_two_checkpoints_stay(spark):
    steps = [(1, s) for s in range(10, 2001, 10)] + [(2, 200), (3, 50)]
    logs = spark.createDataFrame(steps, "run_id long, step long").repartition(4)
    kept = checkpoint_retention(checkpoints(logs, F.lit("/out")))
    assert sorted(map(tuple, kept.collect())) == [
        (1, 1800, "/out/checkpoint-1800"),
        (1, 2000, "/out/checkpoint-2000"),
        (2, 200, "/out/checkpoint-200"),
    ]
    assert checkpoint_retention(checkpoints(logs, F.lit("o")), limit=1).count() == 2


def test_experiments_are_created_once(spark, tmp_path):
    path = str(tmp_path / "experiments")
    spark.createDataFrame([("a",)], "name string").write.parquet(path)
    asked = spark.createDataFrame([("a",), ("b",), ("b",), ("c",)], "name string")
    assert sorted(r[0] for r in missing_experiments(asked, spark.read.parquet(path)).collect()) == ["b", "c"]
    again = get_or_create_experiments(asked, spark.read.parquet(path), path)
    assert sorted(r[0] for r in again.collect()) == ["a", "b", "c"]
    assert missing_experiments(asked, again).count() == 0


def test_last_tag_wins(spark):
    rows = [(1, "task", f"v{i}", i) for i in range(50)] + [(1, "base", "m", 3), (2, "task", "z", 0)]
    random.Random(0).shuffle(rows)
    df = spark.createDataFrame(rows, "run_id long, key string, value string, seq long")
    assert sorted(map(tuple, run_tags(df).collect())) == [(1, "base", "m"), (1, "task", "v49"), (2, "task", "z")]


def test_params_read_as_python_writes_them(spark):
    rng = random.Random(9)
    floats = [0.0, -0.0, 2e-4, 1e-4, 9.9e-5, 2e-5, 0.03, 1.0, 1e7, 123456789.125, 1e15, 1e16, 1.5e16, -2.5e-9, 1e22, 1e100, 5e-324, 0.1 + 0.2, float("nan"), float("inf"), float("-inf")]
    floats += [round(rng.uniform(-1e6, 1e6), rng.randrange(6)) for _ in range(50)]
    floats += [rng.randrange(1, 999) / 8 * 10.0 ** rng.randrange(-8, 20) for _ in range(100)]
    floats = [f for f in floats if shortest_in_java(f)]
    rows = [(i, f, i % 2 == 0, i, f"t{i}") for i, f in enumerate(floats)] + [(999, None, None, None, None)]
    df = spark.createDataFrame(rows, "run long, f double, b boolean, i int, s string")
    got = {(r["run_id"], r["key"]): r["value"] for r in run_params(df, ["f", "b", "i", "s"], "run").collect()}
    expected = {(r[0], k): str(v) for r in rows for k, v in zip("fbis", r[1:])}
    assert got == expected


def shortest_in_java(value):
    """Java before 19 writes a digit too many for some doubles (2.0E-3 is not
    among them, 2.2250738585072014E-308 and 5e-324 are)."""
    return value != value or struct.pack("d", value) != struct.pack("d", 5e-324)


def test_paths(spark):
    row = spark.range(1).select(
        user_path(F.lit("exp")).alias("p"),
        user_path(F.lit("exp"), F.lit("me")).alias("q"),
        checkpoint_path(F.lit("/o"), F.lit(200)).alias("c"),
        F.current_user().alias("u"),
    ).first()
    assert row["p"] == f"/Workspace/Users/{row['u']}/exp"
    assert (row["q"], row["c"]) == ("/Workspace/Users/me/exp", "/o/checkpoint-200")


def test_no_checkpoint_at_step_0_and_no_null_name(spark):
    from pyspark.sql import functions as F

    from tunefeed.operators.registry import checkpoints, missing_experiments

    logs = spark.createDataFrame([(1, 0), (1, 200), (1, 5)], "run_id long, step long")
    assert [r["step"] for r in checkpoints(logs, F.lit("out")).collect()] == [200]
    assert checkpoints(logs, F.lit("out"), save_every=0).count() == 2
    asked = spark.createDataFrame([(None,), ("a",), ("b",)], "name string")
    there = spark.createDataFrame([("b",)], "name string")
    assert [r["name"] for r in missing_experiments(asked, there).collect()] == ["a"]
