"""Text cleaning and the user turn of a triple row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The 29 characters that Python's str.strip() removes.
PY_WS = (
    "\u0009\u000a\u000b\u000c\u000d"
    "\u001c\u001d\u001e\u001f\u0020"
    "\u0085\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Fixed value: the label between instruction and input.
INPUT_LABEL = "\n\n[入力]\n"


def clean_text(col: Column) -> Column:
    """NULL becomes ``""``; white space of any script goes from both ends."""
    return F.trim(F.coalesce(col, F.lit("")), F.lit(PY_WS))


def build_user_text(instruction: Column, input_: Column) -> Column:
    """The instruction, followed by the labelled input when that is not blank."""
    inst, inp = clean_text(instruction), clean_text(input_)
    return F.when(inp != "", F.concat(inst, F.lit(INPUT_LABEL), inp)).otherwise(inst)
