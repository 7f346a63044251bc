"""What the physical plans must and must not hold."""

import re

import pytest
from pyspark.sql import functions as F

from tunefeed.operators.batching import BatchPlan, plan_batches
from tunefeed.operators.registry import checkpoint_retention, checkpoints
from tunefeed.operators.training_text import append_text, project_text
from tunefeed.plans.queries import QUERIES
from tunefeed.plans.views import log_rows

SF_DIR = "/root/testdata/sf0.001"
WITH_PYTHON = {"generate_batch", "generate_by_length", "artifact_manifest"}


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WITH_PYTHON))
def test_no_python_no_cross_join_no_single_task_exchange(spark, name):
    plan = physical(QUERIES[name](spark, SF_DIR))
    for word in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct",
                 "BroadcastNestedLoopJoin", "SinglePartition"):
        assert word not in plan, word


@pytest.mark.parametrize("name", ["sft_text", "sft_text_keep", "render_chat", "to_messages", "explode_metrics", "cadence"])
def test_data_is_shuffled_once(spark, name):
    plan = physical(QUERIES[name](spark, SF_DIR))
    assert len(re.findall(r"(?<!Broadcast)Exchange ", plan)) == 1


def test_time_per_step_reuses_the_grouping_of_the_steps(spark):
    plan = physical(QUERIES["time_per_step"](spark, SF_DIR))
    assert len(re.findall(r"(?<!Broadcast)Exchange ", plan)) == 1


@pytest.mark.parametrize("name", ["cap_tokens", "render_prompt", "load_split"])
def test_row_by_row_work_has_no_shuffle(spark, name):
    assert "Exchange" not in physical(QUERIES[name](spark, SF_DIR))


def test_triples_render_in_compiled_code(spark):
    df = spark.read.parquet(f"{SF_DIR}/documents.parquet").select(
        F.col("text").alias("instruction"), F.col("lang").alias("output"), "source"
    )
    plan = physical(append_text(df))
    assert "*(1) Project" in plan and "transform(" not in plan
    assert "source" not in re.findall(r"ReadSchema: (.*)", physical(project_text(df)))[0]


def test_logs_are_parsed_once(spark):
    assert physical(QUERIES["explode_metrics"](spark, SF_DIR)).count("from_json(") == 1


@pytest.mark.parametrize("stored", [True, False])
def test_step_cap_bounds_the_scan(spark, stored):
    """Looking for the bound writes nothing; what is written is read up to it only."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")
    made, plan = [], BatchPlan(1, 1, 8, max_steps=2)
    ran = written_by(spark, lambda: made.append(plan_batches(docs, ["doc_id"], plan, 10, stored)))
    assert len(ran) == (1 if stored else 2)
    assert re.search(r"PushedFilters: \[IsNotNull\(doc_id\), LessThanOrEqual\(doc_id,\d+\)", ran[0])
    assert made[0].count() == 16


def test_retention_limits_rows_before_the_shuffle(spark):
    manifest = checkpoints(log_rows(spark, SF_DIR).repartition(4, "event_id"), F.lit("o"))
    assert physical(checkpoint_retention(manifest)).count("WindowGroupLimit") == 2


def written_by(spark, call):
    """Plans of the writes that run during the call: ordered rows are written at once."""
    store = spark._jsparkSession.sharedState().statusStore()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    before = {store.executionsList().apply(i).executionId() for i in range(store.executionsList().size())}
    call()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    every = store.executionsList()
    new = [e for e in map(every.apply, range(every.size())) if e.executionId() not in before]
    plans = [e.physicalPlanDescription() for e in sorted(new, key=lambda e: e.executionId())]
    return [p for p in plans if "InsertIntoHadoopFsRelationCommand" in p]


def test_numbering_shuffles_rows_once_and_then_reads_what_it_wrote(spark):
    """The exchange is in the job that writes the ordered rows, not in the plan that comes back."""
    ran = written_by(spark, lambda: QUERIES["number_rows"](spark, SF_DIR))
    assert len(ran) == 1
    initial = ran[0].split("== Initial Plan ==")[-1]
    assert "rangepartitioning(" in initial and "hashpartitioning(" not in ran[0]
    assert not re.findall(r"(?<!Broadcast)Exchange ", physical(QUERIES["number_rows"](spark, SF_DIR)))
