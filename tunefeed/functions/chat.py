"""Chat template: message list -> one string.

The template of a real model comes with its tokenizer, as text: ``compile_template``
makes a ``TemplateText`` of it. The default below is a plain ``<|role|>content<|end|>``
line per turn, with markers to choose.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from tunefeed.functions.messages import SYSTEM_CONTENT, triple_to_messages
from tunefeed.functions.template import TemplateText
from tunefeed.functions.text import build_user_text, clean_text


@dataclass(frozen=True)
class ChatTemplate:
    # The markers of the illustrated template.
    role_open: str = "<|"
    role_close: str = "|>"
    turn_end: str = "<|end|>"
    turn_separator: str = "\n"

    def header(self, role: Column) -> Column:
        return F.concat(F.lit(self.role_open), role, F.lit(self.role_close))

    def turn(self, role: Column, content: Column) -> Column:
        """A NULL role or content is rendered as ``""``, so the turn is not lost."""
        blank = F.lit("")
        return F.concat(
            self.header(F.coalesce(role, blank)), F.coalesce(content, blank), F.lit(self.turn_end)
        )


DEFAULT_TEMPLATE = ChatTemplate()


Template = ChatTemplate | TemplateText


def render_chat(messages: Column, template: Template = DEFAULT_TEMPLATE) -> Column:
    """All turns, no prompt for a further one."""
    if isinstance(template, TemplateText):
        return template.render(messages)
    return F.array_join(
        F.transform(messages, lambda m: template.turn(m["role"], m["content"])),
        template.turn_separator,
    )


def render_prompt(
    messages: Column, template: Template = DEFAULT_TEMPLATE, role: str = "assistant"
) -> Column:
    """All turns and the header of the turn the model is to write.

    A template's text knows by itself what that header is, and does not ask for ``role``.
    """
    if isinstance(template, TemplateText):
        return template.render(messages, add_generation_prompt=True)
    header = F.concat(F.lit(template.turn_separator), template.header(F.lit(role)))
    return F.concat(render_chat(messages, template), header)


def render_triple(
    instruction: Column,
    input_: Column,
    output: Column,
    template: Template = DEFAULT_TEMPLATE,
) -> Column:
    """``render_chat(triple_to_messages(...))`` without building the array.

    Three turns known beforehand need no array and no lambda, so the projection
    stays in whole-stage codegen. A template's text gets the array, as it may look
    at any message from any other.
    """
    if isinstance(template, TemplateText):
        return template.render(triple_to_messages(instruction, input_, output))
    return F.concat_ws(
        template.turn_separator,
        template.turn(F.lit("system"), F.lit(SYSTEM_CONTENT)),
        template.turn(F.lit("user"), build_user_text(instruction, input_)),
        template.turn(F.lit("assistant"), clean_text(output)),
    )
