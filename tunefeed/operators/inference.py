"""Bulk prompts through a model the caller supplies. No model ships here."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tunefeed.functions.chat import DEFAULT_TEMPLATE, Template, render_prompt
from tunefeed.functions.messages import system_turn, turn
from tunefeed.functions.tokens import space_token_count
from tunefeed.operators.ordered import ROWS_PER_BUCKET, number_rows

# Fixed value: new tokens a completion may have.
MAX_NEW_TOKENS = 100

# Prompts that the model gets at once.
BATCH_SIZE = 8

# Tokens, with padding, that it gets at once where batches are made by length.
TOKEN_BUDGET = 16_384

Generate = Callable[[list[str], int], list[str]]


def prompt_messages(user: F.Column) -> F.Column:
    """The system turn and one user turn."""
    return F.array(system_turn(), turn("user", user))


def render_prompts(
    df: DataFrame, messages: str = "messages", template: Template = DEFAULT_TEMPLATE
) -> DataFrame:
    return df.withColumn("prompt", render_prompt(F.col(messages), template))


def generate_batch(
    prompts: DataFrame,
    make_model: Callable[[], Generate],
    max_new_tokens: int = MAX_NEW_TOKENS,
    keep: tuple[str, ...] = (),
    batch_size: int = BATCH_SIZE,
) -> DataFrame:
    """``prompt`` -> ``completion``, the decoded text with the prompt in front.

    ``make_model`` runs once per task and returns ``generate(prompts,
    max_new_tokens) -> continuations``; it is called with ``batch_size`` prompts
    at most. A NULL prompt is not sent and has a NULL completion.
    """
    source = prompts.select(*keep, "prompt")
    schema = T.StructType([*source.schema.fields, T.StructField("completion", T.StringType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        generate = make_model()
        for batch in batches:
            done: list[str | None] = [None] * len(batch)
            asked = [(i, p) for i, p in enumerate(batch["prompt"]) if p is not None]
            for first in range(0, len(asked), max(batch_size, 1)):
                part = asked[first : first + max(batch_size, 1)]
                new = generate([p for _, p in part], max_new_tokens)
                if len(new) != len(part):
                    raise ValueError(f"model gave {len(new)} texts for {len(part)} prompts")
                for (i, p), c in zip(part, new):
                    done[i] = p + c
            yield batch.assign(completion=pd.Series(done, index=batch.index, dtype=object))

    return source.mapInPandas(run, schema)


def budget_batches(
    prompts: DataFrame,
    budget: int = TOKEN_BUDGET,
    tokens: str = "n_tokens",
    key: str = "id",
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Add ``batch`` and ``batch_pos``: prompts of similar length, of which a batch holds as many as
    fit into ``budget`` tokens when all are padded to the longest.

    Rows are numbered by length (ties: by ``key``). In runs of equal batch size, a batch is a
    stretch of that many positions: the size is the budget over a length, rounded down to a power of two, so
    a batch's rows differ in length by less than a factor of two but where one is over the budget by
    itself, or the size changes. No task walks over rows: sizes and stretches are arithmetic on positions.
    A NULL count is 0, and like any below 1 padded to 1.
    """
    length = F.greatest(F.coalesce(F.col(tokens).cast("bigint"), F.lit(0)), F.lit(1))
    sized = prompts.withColumn("__length", length)
    fit = F.greatest(F.call_function("div", F.lit(budget).cast("bigint"), F.col("__length")), F.lit(1))
    # The greatest power of two that is not above; at most 2^40.
    power = F.floor(F.log2(fit.cast("double"))).cast("int")
    numbered = number_rows(sized.withColumn("__power", power), ["__length", key], "__p", rows_per_bucket)
    # Rows of one size are one run of positions, as sizes fall while lengths rise; at most 41 runs.
    runs = numbered.groupBy("__power").agg(F.min("__p").alias("first"), F.count(F.lit(1)).alias("n")).orderBy(F.desc("__power")).collect()
    before, first_batch, first_row = 0, F.lit(0).cast("bigint"), F.lit(0).cast("bigint")
    for r in runs:
        own = F.col("__power") == r["__power"]
        first_batch = F.when(own, F.lit(before).cast("bigint")).otherwise(first_batch)
        first_row = F.when(own, F.lit(r["first"]).cast("bigint")).otherwise(first_row)
        before += -(-r["n"] >> r["__power"])
    within = F.col("__p") - first_row
    size = F.expr("shiftleft(1L, __power)")
    return numbered.select(
        *prompts.columns,
        (first_batch + F.call_function("div", within, size)).alias("batch"),
        F.pmod(within, size).alias("batch_pos"),
    )


def generate_by_length(
    prompts: DataFrame,
    make_model: Callable[[], Generate],
    path: str,
    key: str = "id",
    max_new_tokens: int = MAX_NEW_TOKENS,
    budget: int = TOKEN_BUDGET,
    parts: int = 16,
    count: Callable[[F.Column], F.Column] = space_token_count,
) -> DataFrame:
    """``key``, ``prompt``, ``completion`` of all prompts, written to ``path`` in ``parts`` jobs.

    What a part has written is there for good. A run that was killed is started again with the
    same call: prompts whose ``key`` (unique) has a completion are left out, so none of them is
    asked twice, and the others are planned anew. Batches go to the model whole, shortest first,
    of up to ``budget`` tokens with padding. A NULL prompt is not sent and has a NULL completion.
    """
    spark = prompts.sparkSession
    own = prompts.select(key, "prompt")
    schema = T.StructType([*own.schema.fields, T.StructField("completion", T.StringType())])
    done = _completions(spark, path, schema)
    rest = own.join(done.select(key), key, "left_anti").withColumn("n_tokens", count(F.col("prompt")))
    batches = budget_batches(rest, budget, key=key)
    last = batches.agg(F.max("batch")).first()[0]
    for part in range(0 if last is None else min(parts, last + 1)):
        mine = batches.filter(F.col("batch") % parts == part)
        whole = mine.repartition("batch").sortWithinPartitions("batch", "batch_pos")
        whole.mapInPandas(_by_batch(make_model, max_new_tokens, key), schema).write.mode("append").parquet(path)
    return _completions(spark, path, schema)


def _completions(spark, path: str, schema: T.StructType) -> DataFrame:
    """What parts have written; a part that failed has left nothing that is read."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def _by_batch(make_model: Callable[[], Generate], max_new_tokens: int, key: str):
    """Rows come sorted by batch; a batch may begin in one Arrow batch and end in the next."""

    def run(chunks: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        generate, held = None, None

        def answered(batch: pd.DataFrame) -> pd.DataFrame:
            nonlocal generate
            generate = generate or make_model()
            asked = batch["prompt"].notna()
            texts = batch.loc[asked, "prompt"].tolist()
            new = generate(texts, max_new_tokens) if texts else []
            if len(new) != len(texts):
                raise ValueError(f"model gave {len(new)} texts for {len(texts)} prompts")
            completion = pd.Series(None, index=batch.index, dtype=object)
            completion[asked] = [p + c for p, c in zip(texts, new)]
            return pd.DataFrame({key: batch[key], "prompt": batch["prompt"], "completion": completion})

        for chunk in chunks:
            rows = chunk if held is None else pd.concat([held, chunk], ignore_index=True)
            last = rows["batch"].iloc[-1]
            for _, batch in rows[rows["batch"] != last].groupby("batch", sort=False):
                yield answered(batch)
            held = rows[rows["batch"] == last]
        if held is not None and len(held):
            yield answered(held)

    return run
