"""Message lists: ``ARRAY<STRUCT<role: STRING, content: STRING>>``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tunefeed.functions.text import build_user_text, clean_text

MESSAGES = T.ArrayType(
    T.StructType([T.StructField("role", T.StringType()), T.StructField("content", T.StringType())])
)

# Fixed value: content of the system turn that is added when a row has none.
SYSTEM_CONTENT = "/no_think"

TRIPLE_COLUMNS = ("instruction", "input", "output")
CONVERSATION_COLUMN = "conversations"


def turn(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def system_turn() -> Column:
    return turn("system", F.lit(SYSTEM_CONTENT))


def example_columns(df: DataFrame) -> dict[str, Column]:
    """The four columns an example may have; an absent one is a typed NULL.

    A turn is a struct or a map and may carry more keys than role and content,
    in any order; only these two are kept, by name. An absent key is NULL.
    """
    fields = {f.name: f.dataType for f in df.schema.fields}
    cols = {
        name: df[name] if name in fields else F.lit(None).cast("string") for name in TRIPLE_COLUMNS
    }
    if CONVERSATION_COLUMN not in fields:
        cols[CONVERSATION_COLUMN] = F.lit(None).cast(MESSAGES)
        return cols
    conv, element = df[CONVERSATION_COLUMN], fields[CONVERSATION_COLUMN].elementType
    if isinstance(element, T.MapType):
        conv = F.transform(
            conv, lambda t: _turn_of(lambda k: F.try_element_at(t, F.lit(k)))
        )
    elif element.fieldNames() != ["role", "content"]:
        present = set(element.fieldNames())
        conv = F.transform(
            conv, lambda t: _turn_of(lambda k: t[k] if k in present else F.lit(None))
        )
    cols[CONVERSATION_COLUMN] = conv
    return cols


def _turn_of(value) -> Column:
    return F.struct(*[value(k).cast("string").alias(k) for k in ("role", "content")])


def is_conversation(conversations: Column) -> Column:
    """True when the list holds at least one turn (never NULL)."""
    return F.coalesce(F.size(conversations), F.lit(0)) > 0


def detect_shape(conversations: Column) -> Column:
    return F.when(is_conversation(conversations), F.lit("conversation")).otherwise(F.lit("triple"))


def triple_to_messages(instruction: Column, input_: Column, output: Column) -> Column:
    return F.array(
        system_turn(),
        turn("user", build_user_text(instruction, input_)),
        turn("assistant", clean_text(output)),
    )


def starts_with_system(conversations: Column) -> Column:
    """True when the role of the first turn is exactly ``system`` (never NULL)."""
    return F.get(conversations, F.lit(0))["role"].eqNullSafe("system")


def ensure_system_turn(conversations: Column) -> Column:
    """Put the system turn first unless the first turn already is one."""
    return F.when(
        ~starts_with_system(conversations), F.concat(F.array(system_turn()), conversations)
    ).otherwise(conversations)


def to_messages(
    instruction: Column, input_: Column, output: Column, conversations: Column
) -> Column:
    """Per row: the conversation when it has turns, else the triple."""
    return F.when(is_conversation(conversations), ensure_system_turn(conversations)).otherwise(
        triple_to_messages(instruction, input_, output)
    )
