"""Training examples -> training text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunefeed.functions.chat import DEFAULT_TEMPLATE, Template, render_chat, render_triple
from tunefeed.functions.messages import (
    CONVERSATION_COLUMN,
    MESSAGES,
    SYSTEM_CONTENT,
    ensure_system_turn,
    example_columns,
    is_conversation,
    to_messages,
)
from tunefeed.functions.template import TemplateText

# A group of turns up to this size is gathered in one step.
GATHER_TURNS = 4096


def with_messages(df: DataFrame, column: str = "messages") -> DataFrame:
    """Add the message list of every row; the shape is detected row by row."""
    return df.withColumn(column, to_messages(**_arguments(df)))


def append_text(
    df: DataFrame, template: Template = DEFAULT_TEMPLATE, column: str = "text"
) -> DataFrame:
    """Add the rendered text and keep all source columns."""
    return df.withColumn(column, training_text(df, template))


def project_text(
    df: DataFrame, template: Template = DEFAULT_TEMPLATE, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Only ``text`` remains (and the key columns named in ``keep``)."""
    return df.select(*keep, training_text(df, template).alias("text"))


def training_text(df: DataFrame, template: Template = DEFAULT_TEMPLATE) -> Column:
    """Equal to ``render_chat(to_messages(...))``; triples skip the array."""
    cols = _arguments(df)
    conv = cols.pop(CONVERSATION_COLUMN)
    triple = render_triple(**cols, template=template)
    if CONVERSATION_COLUMN not in df.columns:
        return triple
    return F.when(is_conversation(conv), render_chat(ensure_system_turn(conv), template)).otherwise(
        triple
    )


def _arguments(df: DataFrame) -> dict[str, Column]:
    cols = example_columns(df)
    cols["input_"] = cols.pop("input")
    return cols


def turns_to_conversations(
    turns: DataFrame,
    key: str = "conv_id",
    order: str = "turn",
    role: str = "role",
    content: str = "text",
    gather_turns: int = GATHER_TURNS,
) -> DataFrame:
    """One row per conversation out of a table with one row per turn."""
    fields = {"role": F.col(role), "content": F.col(content)}
    gathered = _gather_turns(turns, key, order, fields, gather_turns)
    conv = F.arrays_zip(
        F.col("turns")["role"].alias("role"), F.col("turns")["content"].alias("content")
    )
    return gathered.select(key, conv.cast(MESSAGES).alias(CONVERSATION_COLUMN))


def turns_to_text(
    turns: DataFrame,
    template: Template = DEFAULT_TEMPLATE,
    key: str = "conv_id",
    order: str = "turn",
    role: str = "role",
    content: str = "text",
    gather_turns: int = GATHER_TURNS,
) -> DataFrame:
    """Equal to ``project_text(turns_to_conversations(...), keep=(key,))``.

    Each turn is rendered where it is read, in compiled code; what is gathered
    are strings to join. A template's text is rendered on the gathered turns.
    """
    if isinstance(template, TemplateText):
        whole = turns_to_conversations(turns, key, order, role, content, gather_turns)
        return project_text(whole, template, keep=(key,))
    fields = {
        "is_system": F.col(role).eqNullSafe("system"),
        "piece": template.turn(F.col(role), F.col(content)),
    }
    gathered = _gather_turns(turns, key, order, fields, gather_turns)
    pieces = F.col("turns")["piece"]
    opening = F.array(template.turn(F.lit("system"), F.lit(SYSTEM_CONTENT)))
    complete = F.when(F.get("turns", F.lit(0))["is_system"], pieces).otherwise(
        F.concat(opening, pieces)
    )
    return gathered.select(key, F.array_join(complete, template.turn_separator).alias("text"))


def _gather_turns(
    turns: DataFrame, key: str, order: str, fields: dict[str, Column], gather_turns: int
) -> DataFrame:
    """``key`` and ``turns``, the array of (``order``, fields) in order.

    ``(key, order)`` is unique and ``order`` counts from 0. The largest value
    of ``order`` (a scan of one narrow column) bounds every group: below
    ``gather_turns`` one shuffle gathers the turns. Beyond it a conversation is
    first gathered in parts of ``gather_turns`` turns, in different tasks, and
    only sorted parts meet. A conversation is one training row, so a row's size
    limits it in the end; nothing is cut. Turns without a key belong to no
    conversation and are left out.
    """
    turns = turns.filter(F.col(key).isNotNull())
    item = F.struct(F.col(order), *[c.alias(name) for name, c in fields.items()])
    sorted_turns = F.sort_array(F.collect_list(item)).alias("turns")
    last = turns.agg(F.max(order)).first()[0]
    if last is None or last < gather_turns:
        return turns.groupBy(key).agg(sorted_turns)
    part = F.call_function("div", F.col(order), F.lit(gather_turns)).alias("part")
    parts = turns.groupBy(F.col(key), part).agg(sorted_turns)
    in_order = F.sort_array(F.collect_list(F.struct("part", "turns")))
    return parts.groupBy(key).agg(F.flatten(in_order["turns"]).alias("turns"))
