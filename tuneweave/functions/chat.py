"""Chat templates as column expressions.

A template is a function of one message and its position, so a turn renders on
its own, before any shuffle, and a conversation is the pieces put in order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import capitalize, strip

# The texts the templates emit.
SYSTEM_DEFAULT = "You are a helpful assistant."
TURN_OPEN = "<|im_start|>"
TURN_CLOSE = "<|im_end|>"

Piece = Callable[[Column, Column, Column, str, str], Column]


def qwen_piece(role: Column, content: Column, position: Column, eos: str, bos: str) -> Column:
    """Roles other than user, assistant and system render to nothing."""
    content = F.coalesce(content, F.lit(""))
    block = F.concat(F.lit(TURN_OPEN), role, F.lit("\n"), strip(content), F.lit(TURN_CLOSE))
    empty_header = (role == "system") & (position == 0) & (content == "")
    body = (
        F.when(empty_header, "")
        .when(role.isin("user", "system"), F.concat(block, F.lit("\n")))
        .when(role == "assistant", F.concat(block, F.lit(eos)))
        .otherwise("")
    )
    return F.concat(F.when(position == 0, F.lit(bos)).otherwise(""), body)


def fallback_piece(role: Column, content: Column, position: Column, eos: str, bos: str) -> Column:
    """`Role: content`, parted by the end token or, without one, a newline."""
    lead = F.when(position == 0, F.lit(bos)).otherwise(F.lit(eos or "\n"))
    return F.concat(lead, capitalize(role), F.lit(": "), strip(F.coalesce(content, F.lit(""))))


TEMPLATES: dict[str, Piece] = {"qwen": qwen_piece, "fallback": fallback_piece}


def render_piece(
    template: str | Column, role: Column, content: Column, position: Column, eos: str = "", bos: str = ""
) -> Column:
    """One turn under a template name, or under a column that names one per row."""
    if isinstance(template, str):
        return TEMPLATES[template](role, content, position, eos, bos)
    chosen = F.lit(None).cast("string")
    for name, piece in TEMPLATES.items():
        chosen = F.when(template == name, piece(role, content, position, eos, bos)).otherwise(chosen)
    return chosen


def render_messages(template: str | Column, messages: Column, eos: str = "", bos: str = "") -> Column:
    """An array of `struct<role, content>` as one text; an empty array gives the start token."""
    pieces = F.transform(
        messages, lambda m, i: render_piece(template, m["role"], m["content"], i, eos, bos)
    )
    return F.when(F.size(messages) == 0, F.lit(bos)).otherwise(F.array_join(pieces, ""))


def render_turns(template: str, turns: list[tuple[str, Column]], eos: str = "", bos: str = "") -> Column:
    """A fixed list of `(role, content)` as one text, without building an array."""
    return F.concat(
        *[render_piece(template, F.lit(r), c, F.lit(i), eos, bos) for i, (r, c) in enumerate(turns)]
    )


def select_template(own: Column, class_default: Column, model_name: Column) -> Column:
    """The tokenizer's own template, else its class default, else one by model name."""
    by_name = F.when(F.lower(model_name).contains("qwen"), "qwen").otherwise("fallback")
    return F.coalesce(F.nullif(own, F.lit("")), F.nullif(class_default, F.lit("")), by_name)


def message(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def prompt_messages(instruction: Column) -> Column:
    """System default, then the instruction as the user turn."""
    return F.array(message("system", F.lit(SYSTEM_DEFAULT)), message("user", instruction))


def instruction_turns(instruction: Column, extra: Column, output: Column) -> list[tuple[str, Column]]:
    """Instruction and optional input as the user turn, output as the assistant turn."""
    return [("user", F.concat_ws("\n\n", instruction, F.nullif(extra, F.lit("")))), ("assistant", output)]


def instruction_messages(instruction: Column, extra: Column, output: Column) -> Column:
    return F.array(*[message(role, content) for role, content in instruction_turns(instruction, extra, output)])
