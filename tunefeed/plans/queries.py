"""Registered queries: each runs one operator over whole driver tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tunefeed.functions.chat import render_chat
from tunefeed.functions.chat import render_prompt as prompt_text
from tunefeed.functions.messages import (
    detect_shape,
    ensure_system_turn,
    to_messages,
    triple_to_messages,
)
from tunefeed.functions.paths import user_path
from tunefeed.functions.template import compile_template
from tunefeed.functions.text import build_user_text, clean_text
from tunefeed.operators import batching, metrics, registry
from tunefeed.operators.batching import BatchPlan
from tunefeed.operators.inference import generate_batch, generate_by_length, prompt_messages, render_prompts
from tunefeed.operators.epochs import epoch_order as in_epoch
from tunefeed.operators.ordered import number_file_rows as number_in_files
from tunefeed.operators.ordered import number_rows as number
from tunefeed.operators.training_text import (
    append_text,
    project_text,
    turns_to_text,
    with_messages,
)
from tunefeed.operators.whole_packing import pack_whole as packed_whole
from tunefeed.plans.jobs import prepare_feed
from tunefeed.plans.views import (
    conversation_rows,
    damaged_log_rows,
    log_rows,
    mixed_rows,
    table,
    triple_rows,
)
from tunefeed.session import shared_path
from tunefeed.sources import artifacts, datasets, feed
from tunefeed.streaming.metric_stream import (
    read_log_stream,
    write_metric_stream,
    write_reject_stream,
)
from tunefeed.streaming.step_time import read_step_times, write_step_time_stream

Query = Callable[[SparkSession, str], DataFrame]

PLAN = BatchPlan(world_size=4, per_device_batch=1, accumulation=8)
MAX_LENGTH = 2048


# Templates of three forms: a header line per turn; the system turn inside the first user turn;
# renamed and numbered roles, with white-space control.
LINES = (
    "{% for message in messages %}"
    "{{ '<|im_start|>' + message['role'] + '\\n' + message['content'] + '<|im_end|>' + '\\n' }}"
    "{% endfor %}"
    "{% if add_generation_prompt %}{{ '<|im_start|>assistant\\n' }}{% endif %}"
)
BRACKETS = (
    "{% if messages[0]['role'] == 'system' %}"
    "{% set turns = messages[1:] %}{% set system = messages[0]['content'] %}"
    "{% else %}{% set turns = messages %}{% set system = false %}{% endif %}"
    "{% for message in turns %}"
    "{% if loop.first and system != false %}"
    "{% set content = '<<SYS>>\\n' + system + '\\n<</SYS>>\\n\\n' + message['content'] %}"
    "{% else %}{% set content = message['content'] %}{% endif %}"
    "{% if message['role'] == 'user' %}{{ bos_token + '[INST] ' + content.strip() + ' [/INST]' }}"
    "{% elif message['role'] == 'assistant' %}{{ ' ' + content.strip() + ' ' + eos_token }}{% endif %}"
    "{% endfor %}"
)
NUMBERED = """{{ bos_token }}
{%- for m in messages if m.role != 'system' %}
    {%- set role = 'model' if m.role == 'assistant' else m.role | upper %}
    {# one header per turn #}
    {{- '<' ~ role ~ ' ' ~ loop.index ~ '/' ~ loop.length ~ '>' }}
    {{- m.content | trim }}
    {%- if not loop.last or add_generation_prompt %}{{ '\\n' }}{% endif %}
{%- endfor %}
{%- if add_generation_prompt %}
    {{- '<model>' }}
{%- endif %}
"""


def _turn_rows(df: DataFrame, messages: Column) -> DataFrame:
    # A message list is never empty. The outer form keeps the optimizer from
    # computing each list once more to test that.
    turns = df.select("conv_id", F.posexplode_outer(messages).alias("pos", "m"))
    return turns.select("conv_id", F.col("pos").cast("bigint").alias("pos"), "m.role", "m.content")


# --- sources and sinks


def load_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return datasets.load_split(spark, sf_dir, "conversations.parquet")


def load_split_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = shared_path(spark, "datasets")
    split = F.when(F.col("doc_id") % 10 == 0, "test").otherwise("train").alias("split")
    table(spark, sf_dir, "documents").select("doc_id", "text", split).write.partitionBy(
        "split"
    ).parquet(f"{base}/documents")
    return datasets.load_split(spark, base, "documents", split="train")


def jsonl_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "jsonl")
    rows = triple_rows(spark, sf_dir)
    datasets.write_jsonl(rows, path)
    return datasets.resolve_source(spark, sf_dir, "none", jsonl_path=path, schema=rows.schema)


def feed_by_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "feed")
    planned = batching.plan_batches(mixed_rows(spark, sf_dir), ["conv_id"], PLAN)
    rows = project_text(planned, keep=("conv_id", "p", "rank", "step", "micro"))
    feed.write_training_feed(rows, path, PLAN.world_size, shuffle=False)
    return (
        feed.read_training_feed(spark, path)
        .groupBy("rank")
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.min("p").alias("min_p"),
            F.max("p").alias("max_p"),
            F.sum(F.length("text")).alias("n_chars"),
        )
    )


def feed_without_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole way from JSON lines that have no key column, in one call."""
    source, path = shared_path(spark, "source"), shared_path(spark, "feed")
    datasets.write_jsonl(triple_rows(spark, sf_dir).drop("conv_id"), source)
    rows = prepare_feed(spark, path, jsonl_path=source, plan=PLAN, max_length=10**9)
    # Per step, and in all: which rows share a step depends on a hash.
    return rows.rollup("step").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum((F.col("rank") == F.col("p") % PLAN.world_size).cast("bigint")).alias("n_dealt"),
        F.min("p").alias("min_p"),
        F.when(F.grouping("step") == 1, F.sum(F.length("text"))).alias("n_chars"),
    )


def artifact_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "artifacts")
    rows = table(spark, sf_dir, "documents").select("text", "lang")
    rows.write.partitionBy("lang").option("lineSep", "\n").text(path)
    files = artifacts.artifact_manifest(spark, path, with_hash=True)
    text_files = files.filter(F.col("path").endswith(".txt"))
    return text_files.groupBy(F.regexp_extract("path", "lang=([^/]+)/", 1).alias("lang")).agg(
        F.sum("length").alias("n_bytes"),
        F.bool_and(F.length("sha256") == 64).alias("hashed"),
    )


def feed_from_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a run that stopped after step 2 has still to read."""
    path = shared_path(spark, "feed")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn")
    planned = batching.plan_batches(turns, ["conv_id", "turn"], PLAN, rows_per_bucket=1000, stored=True)
    feed.write_training_feed(planned, path, PLAN.world_size)
    manifest = table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("run_id"), F.lit(2).alias("step"))
    return feed.feed_after_checkpoint(spark, path, manifest, run_id=0)


def artifact_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files of a tree; in a second one some are gone, changed or elsewhere."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", F.sha2("text", 256).alias("sha256"))
    seventh = F.col("doc_id") % 7
    path = F.concat_ws("/", F.lit("/out"), "lang", "source", F.col("doc_id").cast("string"))
    moved = F.concat_ws("/", F.lit("/out"), "lang", F.lit("moved"), F.col("doc_id").cast("string"))
    first = docs.select(path.alias("path"), "sha256")
    second = docs.filter(seventh != 0).select(
        F.when(seventh == 2, moved).otherwise(path).alias("path"),
        F.when(seventh == 1, F.sha2("sha256", 256)).otherwise(F.col("sha256")).alias("sha256"),
    )
    return artifacts.artifact_diff(artifacts.tree_digest(first, "/out"), artifacts.tree_digest(second, "/out"))


def metric_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = shared_path(spark, "stream")
    logs = log_rows(spark, sf_dir)
    logs.write.json(f"{base}/logs")
    stream = read_log_stream(spark, f"{base}/logs", logs.schema, max_files_per_trigger=4)
    keep = ("event_id", "run_id", "step")
    run = write_metric_stream(stream, f"{base}/metrics", f"{base}/checkpoint", keep)
    run.awaitTermination()
    return spark.read.parquet(f"{base}/metrics")


def stream_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damaged records as lines of which some are cut off."""
    base = shared_path(spark, "stream")
    logs = damaged_log_rows(spark, sf_dir)
    line = F.to_json(F.struct(*logs.columns), {"ignoreNullFields": "false"})
    cut = F.when(F.col("event_id") % 50 == 7, F.expr("substring(line, 1, length(line) - 5)"))
    logs.select("event_id", line.alias("line")).select(F.coalesce(cut, "line")).write.text(f"{base}/logs")
    stream = read_log_stream(spark, f"{base}/logs", logs.schema)
    run = write_reject_stream(stream, f"{base}/rejects", f"{base}/checkpoint", ("run_id", "step"))
    run.awaitTermination()
    rows = spark.read.parquet(f"{base}/rejects")
    return rows.groupBy("reason").agg(F.count(F.lit(1)).alias("n"), F.count("step").alias("n_steps"))


def time_per_step_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records that arrive in four parts; the stream ends and starts again between them."""
    base = shared_path(spark, "stream")
    own = shared_path(spark, "logs")
    metrics.rank0_only(log_rows(spark, sf_dir)).write.parquet(own)
    logs = spark.read.parquet(own)
    micros = F.unix_micros(F.col("logged_at").cast("timestamp"))
    cuts = logs.agg(F.percentile_approx(micros, [0.25, 0.5, 0.75])).first()[0] or []
    part = sum(((micros > c).cast("int") for c in cuts), F.lit(0))
    for i in range(len(cuts) + 1):
        arrived = logs.filter(part == i).write.option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
        arrived.json(f"{base}/logs/{i}")
        stream = read_log_stream(spark, f"{base}/logs/*", logs.schema)
        write_step_time_stream(
            stream, f"{base}/times", f"{base}/state", f"{base}/checkpoint", ("event_id", "run_id", "step"), tie_break="event_id"
        ).awaitTermination()
    return read_step_times(spark, f"{base}/times").drop("late")


# --- text, messages, chat


def clean_text_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = triple_rows(spark, sf_dir)
    return rows.select(
        "conv_id", *[clean_text(F.col(c)).alias(c) for c in ("instruction", "input", "output")]
    )


def build_user_text_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = build_user_text(F.col("instruction"), F.col("input"))
    return triple_rows(spark, sf_dir).select("conv_id", text.alias("user_text"))


def detect_shape_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    shape = detect_shape(F.col("conversations"))
    return mixed_rows(spark, sf_dir).select("conv_id", shape.alias("shape"))


def triple_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = triple_to_messages(F.col("instruction"), F.col("input"), F.col("output"))
    return _turn_rows(triple_rows(spark, sf_dir), messages)


def ensure_system(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _turn_rows(conversation_rows(spark, sf_dir), ensure_system_turn(F.col("conversations")))


def to_messages_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _turn_rows(with_messages(mixed_rows(spark, sf_dir)), F.col("messages"))


def render_chat_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = to_messages(*[F.col(c) for c in ("instruction", "input", "output", "conversations")])
    return mixed_rows(spark, sf_dir).select("conv_id", render_chat(messages).alias("text"))


def render_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three templates' texts over both shapes, and one of them with the prompt."""
    rows = with_messages(mixed_rows(spark, sf_dir))
    lines, numbered = compile_template(LINES), compile_template(NUMBERED, bos_token="<s>")
    brackets = compile_template(BRACKETS, bos_token="<s>", eos_token="</s>")
    return rows.select(
        "conv_id",
        render_chat(F.col("messages"), lines).alias("lines"),
        render_chat(F.col("messages"), brackets).alias("brackets"),
        render_chat(F.col("messages"), numbered).alias("numbered"),
        prompt_text(F.col("messages"), numbered).alias("prompt"),
    )


def _prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "benchmark")
    return render_prompts(items.withColumn("messages", prompt_messages(F.col("text"))))


def render_prompt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _prompts(spark, sf_dir).select("item_id", "prompt")


def sft_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: the training text of every conversation."""
    return turns_to_text(table(spark, sf_dir, "conversations"))


def sft_text_keep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return append_text(triple_rows(spark, sf_dir))


def cap_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return batching.cap_tokens(docs, MAX_LENGTH)


def user_path_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The user differs from session to session, so it is taken out again."""
    names = table(spark, sf_dir, "customer").select(F.col("c_name").alias("name"))
    path = F.split(user_path(F.col("name")), "/")
    return names.select(
        "name",
        F.concat_ws("/", F.slice(path, 1, 3)).alias("root"),
        (path[3] == F.current_user()).alias("is_user"),
        path[4].alias("leaf"),
    )


# --- batch planning


def _numbered_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn")
    return number(turns, ["conv_id", "turn"], stored=True)


def number_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _numbered_turns(spark, sf_dir)


def number_rows_by_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select("lang", "source", "doc_id")
    return number(rows, ["lang", "source", "doc_id"], stored=True)


def number_file_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of many files; the files, and the lines in them, are in key order as written."""
    path = shared_path(spark, "lines")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    ranged = turns.repartitionByRange(12, "conv_id", "turn").sortWithinPartitions("conv_id", "turn")
    ranged.write.option("ignoreNullFields", "false").json(path)
    lines = spark.read.schema(turns.schema).json(path)
    return number_in_files(lines).drop("text")


def epoch_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places of the turns in two epochs, and the position that leads to the first of them."""
    turns = _numbered_turns(spark, sf_dir)
    n = turns.count()
    first = in_epoch(turns, n, epoch=0, seed=7, out="p_0")
    second = in_epoch(first, n, epoch=1, seed=7, out="p_1")
    return in_epoch(second, n, epoch=0, seed=7, position="p_0", out="p_back", inverse=True)


def assign_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batching.assign_rank(_numbered_turns(spark, sf_dir), PLAN.world_size)


def assign_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batching.assign_step(_numbered_turns(spark, sf_dir), PLAN)


def step_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    capped = BatchPlan(PLAN.world_size, PLAN.per_device_batch, PLAN.accumulation, max_steps=5)
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn")
    return batching.plan_batches(turns, ["conv_id", "turn"], capped, stored=True)


def _planned_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with position, rank, step and the tokens left by the cap."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = batching.cap_tokens(docs, MAX_LENGTH).select(
        "doc_id", F.least("n_tokens", F.lit(MAX_LENGTH)).alias("n_tok")
    )
    return batching.plan_batches(counted, ["doc_id"], PLAN)


def batch_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batching.batch_summary(_planned_documents(spark, sf_dir))


def pack_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = batching.pack_sequences(_planned_documents(spark, sf_dir), MAX_LENGTH, stored=True)
    return packed.select("doc_id", "rank", "block", "block_pos", "token_from", "piece_tokens")


def pack_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per rank: rows and tokens, rows that do not begin where the row before them in their block
    ends, blocks that are too full, and whether their number is within 1 % (or one) of the bound."""
    packed = packed_whole(_planned_documents(spark, sf_dir), MAX_LENGTH)
    before = Window.partitionBy("rank", "block").orderBy("block_pos", "n_tok").rowsBetween(Window.unboundedPreceding, -1)
    end = F.coalesce(F.sum("n_tok").over(before), F.lit(0))
    blocks = packed.withColumn("astray", (F.col("block_pos") != end) & (F.col("n_tok") > 0)).groupBy("rank", "block").agg(
        F.count(F.lit(1)).alias("n"), F.sum("n_tok").alias("n_tok"), F.count_if("astray").alias("n_astray")
    )
    bound = F.ceil(F.sum("n_tok") / MAX_LENGTH)
    return blocks.groupBy("rank").agg(
        F.sum("n").alias("n_rows"),
        F.sum("n_tok").alias("sum_tokens"),
        F.sum("n_astray").alias("n_astray"),
        F.count_if(F.col("n_tok") > MAX_LENGTH).alias("n_too_full"),
        (F.count(F.lit(1)) <= F.greatest(bound * 1.01, bound + 1)).alias("near_bound"),
    )


# --- metrics and registry


def explode_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.explode_metrics(log_rows(spark, sf_dir), ("event_id", "run_id", "step"))


def time_per_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = metrics.rank0_only(log_rows(spark, sf_dir))
    return metrics.time_per_step(own, tie_break="event_id").select("event_id", "run_id", "step", "time_per_step")


def rank0_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.explode_metrics(
        metrics.rank0_only(log_rows(spark, sf_dir)), ("event_id", "run_id", "step")
    )


def eval_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.eval_metrics(log_rows(spark, sf_dir), ("event_id", "run_id", "step"))


def final_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last record of each run stands for its end-of-run metrics."""
    logs = log_rows(spark, sf_dir)
    last = logs.groupBy("run_id").agg(F.max_by("logs", "step").alias("logs"))
    final = last.withColumn("kind", F.lit("final"))
    return metrics.final_metrics(logs.select("run_id", "logs", "kind").unionAll(final))


def cadence(spark: SparkSession, sf_dir: str) -> DataFrame:
    steps = log_rows(spark, sf_dir).select("event_id", "run_id", "step")
    return metrics.cadence(steps)


def metric_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejects = metrics.metric_rejects(damaged_log_rows(spark, sf_dir))
    return rejects.select("event_id", "run_id", "step", "reason")


def metrics_past_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = metrics.explode_metrics(
        damaged_log_rows(spark, sf_dir), ("event_id", "run_id", "step")
    )
    return kept.withColumn("value", F.nanvl("value", F.lit(-1.0)))


def metric_key_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records in which a key stands twice, or a number has 400 digits."""
    residue = F.col("event_id") % 40
    more = F.when(residue == 3, F.lit(',"k":7}')).when(
        residue == 4, F.concat(F.lit(',"big":1'), F.repeat(F.lit("0"), F.lit(400)), F.lit("}"))
    )
    base = F.expr("substring(logs, 1, length(logs) - 1)")
    logs = log_rows(spark, sf_dir)
    damaged = logs.withColumn("logs", F.coalesce(F.concat(base, more), "logs"))
    return metrics.metric_key_rejects(damaged, ("event_id", "run_id", "step"))


def ckpt_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = registry.checkpoints(log_rows(spark, sf_dir), F.lit("out"))
    return registry.checkpoint_retention(manifest)


def experiment_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event asks for its user's name; suppliers' names are there."""
    asked = table(spark, sf_dir, "events").select(F.col("user_id").alias("key"))
    there = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("key"))
    name = F.concat(F.lit("run-"), F.col("key")).alias("name")
    return registry.missing_experiments(asked.select(name), there.select(name))


def run_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    settings = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("run_id"),
        F.col("event_type").alias("key"),
        F.col("props").alias("value"),
        F.col("event_id").alias("seq"),
    )
    return registry.run_tags(settings)


def tags_in_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``run_tags`` over settings that come in three batches, of which two come twice."""
    tags = registry.tag_table(spark, shared_path(spark, "tags"), run_id="bigint", buckets=4)
    settings = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("run_id"),
        F.col("event_type").alias("key"),
        F.col("props").alias("value"),
        F.col("event_id").alias("seq"),
    )
    out = None
    for batch in (0, 1, 1, 2, 0):
        out = registry.upsert_tags(tags, settings.filter(F.col("seq") % 3 == batch), "settings", batch)
    return out


def experiments_in_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The names of suppliers, then those that events ask for, twice."""
    there = registry.experiment_table(spark, shared_path(spark, "experiments"), buckets=4)
    name = F.concat(F.lit("run-"), F.col("key")).alias("name")
    registry.get_or_create(there, table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("key")).select(name))
    asked = table(spark, sf_dir, "events").select(F.col("user_id").alias("key")).select(name)
    registry.get_or_create(there, asked, "events", 0)
    return registry.get_or_create(there, asked, "events", 0)


def run_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per run: a count, a flag, a text, and floats large and small."""
    runs = (
        table(spark, sf_dir, "events")
        .groupBy(F.col("user_id").alias("run_id"))
        .agg(
            F.count(F.lit(1)).alias("n_logs"),
            F.max("value").alias("max_value"),
            F.min("event_type").alias("first_kind"),
            F.bool_or(F.col("value") > 250).alias("spiked"),
        )
        .withColumn("lr", F.col("max_value") / 1e7)
        .withColumn("tokens", F.col("max_value") * 1e6)
    )
    return registry.run_params(
        runs, ["n_logs", "max_value", "first_kind", "spiked", "lr", "tokens"]
    )


# --- inference


def _first_words_model():
    """The model repeats the first words of the last turn. It is defined in
    here, so it travels to the workers by value."""

    def first_words_model():
        def generate(prompts: list[str], max_new_tokens: int) -> list[str]:
            last = [p.rsplit("<|user|>", 1)[1].split("<|end|>", 1)[0] for p in prompts]
            return [" ".join(t.split()[:max_new_tokens]) for t in last]

        return generate

    return first_words_model


def generate(spark: SparkSession, sf_dir: str) -> DataFrame:
    prompts = _prompts(spark, sf_dir)
    return generate_batch(prompts, _first_words_model(), max_new_tokens=20, keep=("item_id",))


def generate_in_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same in batches by length; half of the prompts have been asked before."""
    path, prompts = shared_path(spark, "completions"), _prompts(spark, sf_dir)
    settings = {"key": "item_id", "max_new_tokens": 20, "budget": 512, "parts": 3}
    half = prompts.filter(F.xxhash64("item_id") % 2 == 0)
    generate_by_length(half, _first_words_model(), path, **settings)
    return generate_by_length(prompts, _first_words_model(), path, **settings)


QUERIES: dict[str, Query] = {
    "load_split": load_split,
    "load_split_pruned": load_split_pruned,
    "jsonl_roundtrip": jsonl_roundtrip,
    "feed_by_rank": feed_by_rank,
    "feed_without_key": feed_without_key,
    "feed_from_step": feed_from_step,
    "artifact_manifest": artifact_manifest,
    "artifact_diff": artifact_diff,
    "metric_stream": metric_stream,
    "stream_rejects": stream_rejects,
    "time_per_step_stream": time_per_step_stream,
    "clean_text": clean_text_query,
    "build_user_text": build_user_text_query,
    "detect_shape": detect_shape_query,
    "triple_messages": triple_messages,
    "ensure_system": ensure_system,
    "to_messages": to_messages_query,
    "render_chat": render_chat_query,
    "render_prompt": render_prompt,
    "render_template": render_template,
    "sft_text": sft_text,
    "sft_text_keep": sft_text_keep,
    "cap_tokens": cap_tokens,
    "user_path": user_path_query,
    "number_rows": number_rows,
    "number_rows_by_text": number_rows_by_text,
    "number_file_rows": number_file_rows,
    "epoch_order": epoch_order,
    "assign_rank": assign_rank,
    "assign_step": assign_step,
    "step_cap": step_cap,
    "batch_summary": batch_summary,
    "pack_blocks": pack_blocks,
    "pack_whole": pack_whole,
    "explode_metrics": explode_metrics,
    "time_per_step": time_per_step,
    "rank0_metrics": rank0_metrics,
    "eval_metrics": eval_metrics,
    "final_metrics": final_metrics,
    "cadence": cadence,
    "metric_rejects": metric_rejects,
    "metric_key_rejects": metric_key_rejects,
    "metrics_past_rejects": metrics_past_rejects,
    "ckpt_retention": ckpt_retention,
    "experiment_missing": experiment_missing,
    "run_tags": run_tags,
    "tags_in_batches": tags_in_batches,
    "experiments_in_batches": experiments_in_batches,
    "run_params": run_params,
    "generate_batch": generate,
    "generate_by_length": generate_in_budget,
}
