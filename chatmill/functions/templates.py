"""Chat-markup rendering as plain ``concat`` expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from chatmill.config import SCRATCHPAD_TEXT, SYSTEM_PROMPT
from chatmill.functions.text import _c, py_rtrim, py_trim


def render_instruction(question, context, system_prompt: str = SYSTEM_PROMPT) -> Column:
    """System turn, then the user turn holding question and passage, ending
    at the assistant marker without a newline (J3)."""
    return F.concat(
        F.lit(f"<|im_start|>system\n{system_prompt}\n<|im_end|>\n<|im_start|>user\nQuestion: "),
        py_trim(_c(question)),
        F.lit("\n\nContext:\n"),
        py_trim(_c(context)),
        F.lit("\n<|im_end|>\n<|im_start|>assistant"),
    )


def render_output(answer, scratchpad: str = SCRATCHPAD_TEXT) -> Column:
    """Scratchpad, final answer, closing marker."""
    return F.concat(
        F.lit(f"<scratchpad>{scratchpad}</scratchpad>\n<final>"),
        py_trim(_c(answer)),
        F.lit("</final>\n<|im_end|>"),
    )


def build_text(instruction="instruction", output="output") -> Column:
    """``rstrip(instr) + "\\n\\n" + rstrip(out) + "\\n"``, null as empty."""
    return F.concat(
        py_rtrim(F.coalesce(_c(instruction), F.lit(""))),
        F.lit("\n\n"),
        py_rtrim(F.coalesce(_c(output), F.lit(""))),
        F.lit("\n"),
    )
