import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tunefeed.operators import inference
from tunefeed.operators.inference import (
    budget_batches,
    generate_batch,
    generate_by_length,
    prompt_messages,
    render_prompts,
)
from tunefeed.session import shared_path


def shouting_model():
    """A function made here travels to the workers by value."""

    def make():
        calls = []

        def generate(prompts, max_new_tokens):
            calls.append(len(prompts))
            return [f" {len(calls)} {p[-8:].upper()}"[:max_new_tokens] for p in prompts]

        return generate

    return make


def prompts(spark, n):
    df = spark.range(n).withColumn("messages", prompt_messages(F.concat(F.lit("q"), F.col("id"))))
    return render_prompts(df)


def test_every_prompt_gets_one_completion_with_the_prompt_in_front(spark):
    df = prompts(spark, 100)
    rows = generate_batch(df.repartition(3), shouting_model(), keep=("id",)).collect()
    assert sorted(r["id"] for r in rows) == list(range(100))
    for r in rows:
        assert r["prompt"] == (
            f"<|system|>/no_think<|end|>\n<|user|>q{r['id']}<|end|>\n<|assistant|>"
        )
        assert r["completion"].startswith(r["prompt"]) and len(r["completion"]) > len(r["prompt"])


def test_new_token_limit_reaches_the_model(spark):
    row = generate_batch(prompts(spark, 1), shouting_model(), max_new_tokens=3).first()
    assert len(row["completion"]) == len(row["prompt"]) + 3


def test_a_model_that_loses_prompts_fails(spark):
    def lossy():
        return lambda texts, n: texts[1:]

    with pytest.raises(Exception, match="texts for"):
        generate_batch(prompts(spark, 5).coalesce(1), lossy).collect()


def test_batches_are_bounded_and_null_prompts_are_not_sent(spark):
    def model():
        def generate(texts, n):
            assert len(texts) <= 3 and None not in texts
            return [f" {len(texts)}" for _ in texts]

        return generate

    df = spark.createDataFrame([(i, None if i % 4 == 0 else f"q{i}") for i in range(20)], "id long, prompt string")
    rows = generate_batch(df.coalesce(1), lambda: model(), keep=("id",), batch_size=3).collect()
    assert len(rows) == 20
    for r in rows:
        assert (r["completion"] is None) == (r["id"] % 4 == 0)
        assert r["completion"] is None or r["completion"] == f"q{r['id']} 3"


def recording_model(folder):
    """Writes what it is asked into a folder, so that a test can see it."""

    def make():
        import os
        import uuid

        def generate(prompts, max_new_tokens):
            with open(os.path.join(folder, uuid.uuid4().hex), "w") as out:
                out.write("\n".join(prompts))
            return [" ok"] * len(prompts)

        return generate

    return make


def asked(folder):
    return [f.read_text().split("\n") for f in folder.iterdir()]


def test_batches_stay_in_the_budget_and_waste_little(spark):
    rng = random.Random(1)
    rows = [(i, rng.choice([None, 0, 1, 3, 10, 11, 40, 100, 1000, 5000, rng.randrange(1, 3000)])) for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, n_tokens int").repartition(5)
    got = budget_batches(df, budget=1024, rows_per_bucket=500).collect()
    batches = defaultdict(list)
    for r in got:
        batches[r.batch].append((r.batch_pos, max(r.n_tokens or 0, 1), r.id))
    assert sorted(i for b in batches.values() for _, _, i in b) == list(range(3000))
    assert sorted(batches) == list(range(len(batches)))
    padded = used = 0
    for b in batches.values():
        b.sort()
        assert [p for p, _, _ in b] == list(range(len(b)))
        longest = max(n for _, n, _ in b)
        assert len(b) * longest <= 1024 or len(b) == 1
        padded += len(b) * longest
        used += sum(n for _, n, _ in b)
    assert used > 0.97 * padded
    # Short ones first, so what one batch holds is not longer than what the next does.
    edges = [(min(n for _, n, _ in batches[i]), max(n for _, n, _ in batches[i])) for i in sorted(batches)]
    assert all(a[1] <= b[0] for a, b in zip(edges, edges[1:]))


def test_a_killed_run_goes_on_without_asking_twice(spark, tmp_path, monkeypatch):
    texts = [None, "", "same", "same"] + [f"p{i} " + "w " * (i % 30) for i in range(200)]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, prompt string")
    path, first, second = shared_path(spark, "completions"), tmp_path / "first", tmp_path / "second"
    first.mkdir(), second.mkdir()
    run, calls = inference._by_batch, []

    def killed(*args):
        calls.append(1)
        if len(calls) > 2:
            raise KeyboardInterrupt
        return run(*args)

    with monkeypatch.context() as patch:
        patch.setattr(inference, "_by_batch", killed)
        with pytest.raises(KeyboardInterrupt):
            generate_by_length(df, recording_model(str(first)), path, budget=100, parts=5)
    done = {r.id for r in spark.read.parquet(path).collect()}
    assert 0 < len(done) < len(texts)
    rows = generate_by_length(df, recording_model(str(second)), path, budget=100, parts=5).collect()
    assert sorted(r.id for r in rows) == list(range(len(texts)))
    assert all(r.completion == (None if r.prompt is None else r.prompt + " ok") for r in rows)
    before, after = ([p for batch in asked(f) for p in batch] for f in (first, second))
    assert len(before) + len(after) == len(texts) - 1
    assert sorted(after) == sorted(t for i, t in enumerate(texts) if t is not None and i not in done)
    # Batches are whole when they reach the model.
    assert max(len(batch) for batch in asked(second)) > 10
    assert generate_by_length(df, recording_model(str(second)), path, budget=100).count() == len(texts)
    assert sum(map(len, asked(second))) == len(after)


def test_batches_across_arrow_batches(spark, tmp_path):
    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    df = spark.range(100).selectExpr("id", "'one two' AS prompt")
    try:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
        generate_by_length(df, recording_model(str(tmp_path)), shared_path(spark, "c"), budget=64, parts=2)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
    assert sorted(map(len, asked(tmp_path))) == [4, 32, 32, 32]


def test_no_prompts(spark):
    df = spark.createDataFrame([], "id long, prompt string")
    assert generate_by_length(df, shouting_model(), shared_path(spark, "c")).collect() == []
