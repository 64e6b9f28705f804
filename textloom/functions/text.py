"""Column expressions for text: coercion, Unicode strip, chat formatting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The white-space code points that Python's str.strip() removes,
# in code-point order: U+0009-000D, U+001C-001F, U+0020, U+0085, U+00A0, U+1680,
# U+2000-200A, U+2028, U+2029, U+202F, U+205F, U+3000.
STRIP_CODE_POINTS = (
    list(range(0x09, 0x0E)) + list(range(0x1C, 0x21)) + [0x85, 0xA0, 0x1680]
    + list(range(0x2000, 0x200B)) + [0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
)
STRIP_CHARS = "".join(chr(c) for c in STRIP_CODE_POINTS)

# Chat markers and role headers of the instruction format.
IM_START = "<|im_start|>"
IM_END = "<|im_end|>"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def coerce_text(c) -> Column:
    """Null -> '', any other type -> its string form; no strip."""
    return F.coalesce(_col(c).cast("string"), F.lit(""))


def normalize_text(c) -> Column:
    """P1 plus strip of Unicode white space on both ends."""
    return F.btrim(coerce_text(c), F.lit(STRIP_CHARS))


def chat_prompt(system: Column, question: Column) -> Column:
    """P4 prompt part: optional system block, user block, assistant header, joined by newline.
    Inputs are normalised strings; an empty system prompt is left out."""
    sys_part = F.when(system != "", F.concat(F.lit(IM_START + "system\n"), system, F.lit(IM_END)))
    user_part = F.concat(F.lit(IM_START + "user\n"), question, F.lit(IM_END))
    return F.concat_ws("\n", sys_part, user_part, F.lit(IM_START + "assistant\n"))


def chat_full(prompt: Column, response: Column) -> Column:
    """P4 full text: prompt + response + end marker."""
    return F.concat(prompt, response, F.lit(IM_END))


def compute_once(df, **exprs):
    """Adds expensive columns evaluated once per row. A filter or projection above a
    plain ``withColumn`` may be rewritten to repeat the expression (filters are pushed
    below the projection with the alias substituted); a one-element ``inline``
    generator is a plan node that neither happens through."""
    s = F.struct(*[e.alias(k) for k, e in exprs.items()])
    return df.select("*", F.inline(F.array(s)))
