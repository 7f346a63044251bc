import json
from collections import Counter

from pyspark.sql import types as T

from tunefeed.functions.tokens import arrow_tokenizer
from tunefeed.operators.batching import BatchPlan, plan_batches
from tunefeed.operators.training_text import project_text
from tunefeed.plans.jobs import prepare_feed
from tunefeed.plans.views import mixed_rows
from tunefeed.sources.datasets import EXAMPLE_SCHEMA, read_jsonl, write_jsonl

SF_DIR = "/root/testdata/sf0.01"
SCHEMA = T.StructType([T.StructField("conv_id", T.LongType()), *EXAMPLE_SCHEMA.fields])


def make_bytes_tokenizer():
    def make():
        return lambda texts: [list(s.encode()) for s in texts]

    return arrow_tokenizer(make)


def test_json_lines_to_feed(spark, tmp_path):
    rows = mixed_rows(spark, SF_DIR)
    source, output = str(tmp_path / "in"), str(tmp_path / "feed")
    write_jsonl(rows, source)
    feed = prepare_feed(
        spark, output, ["conv_id"], jsonl_path=source, schema=SCHEMA, plan=BatchPlan.on_nodes(2, 2)
    )
    expected = {r["conv_id"]: r["text"] for r in project_text(rows, keep=("conv_id",)).collect()}
    got = sorted(feed.collect(), key=lambda r: r["p"])
    assert {r["conv_id"]: r["text"] for r in got} == expected
    assert [r["conv_id"] for r in got] == sorted(expected)
    assert all(r["rank"] == i % 4 and r["step"] == i // 32 + 1 for i, r in enumerate(got))


def test_dataset_to_capped_and_tokenized_feed(spark, tmp_path):
    base, output = str(tmp_path / "sets"), str(tmp_path / "feed")
    rows = mixed_rows(spark, SF_DIR)
    rows.selectExpr("*", "'train' AS split").write.partitionBy("split").parquet(f"{base}/d")
    feed = prepare_feed(
        spark, output, ["conv_id"], base, "d", plan=BatchPlan(2, 1, 4, max_steps=3),
        tokenizer=make_bytes_tokenizer(), max_length=50,
    )
    got = feed.collect()
    assert len(got) == 24 and {r["step"] for r in got} == {1, 2, 3}
    for r in got:
        assert r["input_ids"] == list(r["text"].encode())[:50]
        assert r["n_tokens"] == len(r["text"].encode())


def test_default_data_set_without_key_schema_or_split(spark, tmp_path):
    """instruction / input / output and nothing else, repeated rows among them."""
    source, output = str(tmp_path / "in.jsonl"), str(tmp_path / "feed")
    lines = [{"instruction": f"q{i % 70}", "input": "", "output": f"a {i % 70} " * 3} for i in range(200)]
    with open(source, "w") as file:
        file.writelines(json.dumps(line) + "\n" for line in lines)
    feed = prepare_feed(spark, output, jsonl_path=source, plan=BatchPlan(4, 1, 2), max_length=7)
    got = sorted(feed.collect(), key=lambda r: r["p"])
    assert [r["p"] for r in got] == list(range(200))
    full = Counter(r["text"] for r in project_text(read_jsonl(spark, source)).collect())
    assert len(full) == 70
    assert all(len(r["text"].split()) <= 7 and r["n_tokens"] > 7 for r in got)
    texts = list(full.elements())
    assert all(any(t.startswith(r["text"]) for t in texts) for r in got)
    # The order is that of the file, and the plan goes on from there.
    assert [r["text"] for r in got[:130]] == [r["text"] for r in got[70:200]]
    again = prepare_feed(spark, output + "2", jsonl_path=source, plan=BatchPlan(4, 1, 2), max_length=7)
    assert {(r["p"], r["text"]) for r in again.collect()} == {(r["p"], r["text"]) for r in got}


def test_rows_are_in_the_order_of_the_files(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    for name in ("b", "a", "c"):
        lines = [json.dumps({"instruction": f"{name}{i}"}) + "\n" for i in range(50)]
        (source / f"{name}.jsonl").write_text("".join(lines))
    want = [f"{name}{i}" for name in "abc" for i in range(50)]
    for steps, n in ((-1, 150), (7, 56)):
        feed = prepare_feed(spark, str(tmp_path / f"feed{n}"), jsonl_path=str(source), plan=BatchPlan(2, 1, 4, max_steps=steps))
        got = sorted(feed.collect(), key=lambda r: r["p"])
        assert [r["text"].split("<|user|>")[1].split("<|end|>")[0] for r in got] == want[:n]
        assert [(r["p"], r["rank"], r["step"]) for r in got] == [(i, i % 2, i // 8 + 1) for i in range(n)]


def test_flat_data_set_and_default_split(spark, tmp_path):
    base, output = str(tmp_path / "sets"), str(tmp_path / "feed")
    mixed_rows(spark, SF_DIR).write.parquet(f"{base}/flat")
    feed = prepare_feed(spark, output, ["conv_id"], base, "flat")
    assert feed.count() == mixed_rows(spark, SF_DIR).count()


def test_inferred_schema_keeps_all_columns(spark, tmp_path):
    source = str(tmp_path / "in.jsonl")
    with open(source, "w") as file:
        file.write('{"id": 3, "instruction": "a"}\n{"id": 4, "output": "b", "late": [1.5]}\n')
    rows = {r["id"]: r for r in read_jsonl(spark, source).collect()}
    assert rows[4]["late"] == [1.5] and rows[3]["output"] is None and rows[3]["conversations"] is None


def test_text_is_exchanged_once(spark, tmp_path):
    rows = mixed_rows(spark, SF_DIR)
    source = str(tmp_path / "in")
    rows.write.parquet(f"{source}/d")
    planned = plan_batches(spark.read.parquet(f"{source}/d"), ["conv_id"], BatchPlan(2))
    feed = project_text(planned, keep=("p", "rank"))
    plan = feed._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange" in line and "Broadcast" not in line]
    assert exchanges == []  # the one for the order is behind the written table
