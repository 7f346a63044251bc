from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tunefeed.functions.tokens import arrow_tokenizer
from tunefeed.operators.batching import (
    BatchPlan,
    assign_step,
    batch_summary,
    cap_tokens,
    pack_sequences,
    plan_batches,
    step_cap,
)
from tunefeed.sources.feed import read_training_feed, write_training_feed


def planned(spark, n, plan, **kw):
    return plan_batches(spark.range(n).select((F.col("id") * 3).alias("k")), ["k"], plan, **kw)


@pytest.mark.parametrize("n, w, b, a", [(10, 2, 1, 2), (500, 4, 2, 3), (7, 8, 1, 8), (96, 4, 1, 8)])
def test_plan_invariants(spark, n, w, b, a):
    plan = BatchPlan(w, b, a)
    rows = planned(spark, n, plan, rows_per_bucket=40).collect()
    assert len(rows) == n and len({r["k"] for r in rows}) == n
    per_rank = Counter(r["rank"] for r in rows)
    assert max(per_rank.values()) - min(per_rank[x] for x in range(w)) <= 1
    per_step = Counter(r["step"] for r in rows)
    assert sorted(per_step) == list(range(1, -(-n // plan.rows_per_step) + 1))
    assert all(c == plan.rows_per_step for s, c in per_step.items() if s < max(per_step))
    micro = Counter((r["step"], r["micro"], r["rank"]) for r in rows)
    assert max(micro.values()) <= b and all(0 <= m < a for _, m, _ in micro)
    assert [r["rank"] for r in sorted(rows, key=lambda r: r["k"])] == [i % w for i in range(n)]


def test_last_step_is_short(spark):
    rows = planned(spark, 10, BatchPlan(2, 1, 2)).collect()
    assert Counter(r["step"] for r in rows) == {1: 4, 2: 4, 3: 2}


@pytest.mark.parametrize("cap, steps", [(-1, 13), (0, 13), (5, 5), (100, 13)])
def test_step_cap(spark, cap, steps):
    rows = planned(spark, 100, BatchPlan(1, 1, 8, cap), rows_per_bucket=9).collect()
    assert {r["step"] for r in rows} == set(range(1, steps + 1))
    after = step_cap(planned(spark, 100, BatchPlan(1, 1, 8)), cap).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, after))


def test_steps_stay_exact_at_large_positions(spark):
    p = 2**60 + 31
    row = assign_step(spark.createDataFrame([(p,)], "p long"), BatchPlan(4, 1, 8)).first()
    assert (row["step"], row["micro"]) == (p // 32 + 1, p % 32 // 4)


def test_summary(spark):
    df = planned(spark, 100, BatchPlan(4, 1, 8)).withColumn("n_tok", F.col("p") % 7)
    got = {(r["step"], r["rank"]): tuple(r)[2:] for r in batch_summary(df).collect()}
    groups = defaultdict(list)
    for p in range(100):
        groups[(p // 32 + 1, p % 4)].append(p % 7)
    assert got == {k: (len(v), sum(v), max(v)) for k, v in groups.items()}


@pytest.mark.parametrize("cell", [5, 64, 10**6])
@pytest.mark.parametrize("length", [1, 10, 64])
def test_packed_blocks(spark, cell, length):
    import random

    rng = random.Random(length)
    sizes = [rng.choice([0, 1, 3, 9, 10, 25]) for _ in range(300)]
    df = spark.createDataFrame(
        [(p, p % 3, n) for p, n in enumerate(sizes)], "p long, rank long, n_tok long"
    )
    pieces = pack_sequences(df, length, rows_per_cell=cell).collect()
    for rank in range(3):
        stream = [(p, i) for p in range(rank, 300, 3) for i in range(sizes[p])]
        packed = {}
        for r in pieces:
            if r["rank"] == rank:
                for j in range(r["piece_tokens"]):
                    at = r["block"] * length + r["block_pos"] + j
                    assert at not in packed and r["block_pos"] + j < length
                    packed[at] = (r["p"], r["token_from"] + j)
        assert [packed[i] for i in range(len(packed))] == stream
    assert {r["p"] for r in pieces} == set(range(300))


@pytest.mark.parametrize(
    "text, n, cut",
    [
        ("", 0, ""),
        (None, 0, None),
        ("  ", 0, "  "),
        ("a", 1, "a"),
        (" a  b\nc ", 3, " a  b\nc "),
        (" a  b\nc\td e ", 5, " a  b\nc"),
        ("日本 語 x y", 4, "日本 語 x"),
    ],
)
def test_cap_tokens(spark, text, n, cut):
    row = cap_tokens(spark.createDataFrame([(text,)], "text string"), 3).first()
    assert (row["n_tokens"], row["text"]) == (n, cut)


def test_cap_tokens_takes_the_callers_tokenizer(spark):
    def make_encode():
        return lambda texts: [list(s.encode()) for s in texts]

    df = spark.createDataFrame([("abcd",), ("é",), (None,)], "text string")
    rows = cap_tokens(df, 3, tokenizer=arrow_tokenizer(make_encode)).collect()
    assert [(r["n_tokens"], r["input_ids"]) for r in rows] == [
        (4, [97, 98, 99]),
        (2, [195, 169]),
        (0, []),
    ]


def test_cap_tokens_with_a_library(spark):
    tokenizers = pytest.importorskip("tokenizers")
    model = tokenizers.models.WordLevel({"a": 0, "b": 1, "?": 2}, unk_token="?")
    made = tokenizers.Tokenizer(model)
    made.pre_tokenizer = tokenizers.pre_tokenizers.Whitespace()
    saved = made.to_str()

    def make_encode():
        from tokenizers import Tokenizer

        library = Tokenizer.from_str(saved)
        return lambda texts: [e.ids for e in library.encode_batch(texts)]

    df = spark.createDataFrame([("a b c a",), (None,)], "text string")
    rows = cap_tokens(df, 3, tokenizer=arrow_tokenizer(make_encode)).collect()
    assert [(r["n_tokens"], r["input_ids"]) for r in rows] == [(4, [0, 1, 2]), (0, [])]


def test_unknown_token_counts_pack_as_empty_rows(spark):
    df = spark.createDataFrame([(0, 0, 5), (1, 0, None), (2, 0, 7)], "p long, rank long, n_tok long")
    rows = pack_sequences(df, 10).orderBy("p", "block").collect()
    assert [(r["p"], r["block"], r["block_pos"], r["piece_tokens"]) for r in rows] == [
        (0, 0, 0, 5), (1, 0, 5, 0), (2, 0, 5, 5), (2, 1, 0, 2),
    ]


@pytest.mark.parametrize("shuffle", [True, False])
def test_feed_has_one_directory_per_rank(spark, tmp_path, shuffle):
    path = str(tmp_path / "feed")
    plan = BatchPlan(3, 1, 2)
    write_training_feed(planned(spark, 200, plan), path, plan.world_size, 20, shuffle)
    for part in (tmp_path / "feed").glob("rank=*/part-*"):
        positions = [r["p"] for r in spark.read.parquet(str(part)).collect()]
        assert positions == sorted(positions)
    assert sorted(d.name for d in (tmp_path / "feed").glob("rank=*")) == [f"rank={r}" for r in range(3)]
    assert read_training_feed(spark, path).count() == 200
    one = read_training_feed(spark, path, rank=1)
    assert sorted(r["p"] for r in one.collect()) == list(range(1, 200, 3))
    plan_text = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan_text and "rank" in plan_text.split("PartitionFilters: [")[1]
