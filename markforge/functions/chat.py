"""Chat-format rendering of training text and generation prompts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from markforge.config import IM_END, IM_START
from markforge.functions.text import _col


def _turn_header(role: str) -> str:
    return f"{IM_START}{role}\n"


def _system_block(system_prompt: str) -> str:
    if system_prompt is None:
        raise ValueError("system_prompt is required")
    return f"{_turn_header('system')}{system_prompt}{IM_END}\n"


def generation_prompt(prompt: Column | str, system_prompt: str) -> Column:
    """System + user turn, ending right after the assistant header.

    A NULL prompt renders as ``''`` (``concat`` would otherwise null the row).
    """
    return F.concat(
        F.lit(_system_block(system_prompt) + _turn_header("user")),
        F.coalesce(_col(prompt), F.lit("")),
        F.lit(f"{IM_END}\n" + _turn_header("assistant")),
    )


def training_text(prompt: Column | str, markup: Column | str, system_prompt: str) -> Column:
    """Full supervised example: generation prompt + markup + closing marker."""
    return F.concat(
        generation_prompt(prompt, system_prompt),
        F.coalesce(_col(markup), F.lit("")),
        F.lit(IM_END),
    )


def decoded_prompt(chat: Column | str) -> Column:
    """A rendered prompt as a decoder echoes it with special tokens skipped:
    the chat markers removed (``system\n…\nuser\n…\nassistant\n``)."""
    return F.replace(F.replace(_col(chat), F.lit(IM_START), F.lit("")), F.lit(IM_END), F.lit(""))


def completion_text(raw: Column | str, chat: Column | str) -> Column:
    """The part of a decoded output after the echoed prompt.

    Decoder-only models return prompt + completion; extracting from the
    whole text lets markup inside the prompt be captured. When the output
    does not start with the echoed prompt (a generator that returns the
    completion only, or a detokeniser that alters spacing) it is kept whole.
    """
    raw, echo = _col(raw), decoded_prompt(chat)
    return F.when(F.startswith(raw, echo), F.right(raw, F.length(raw) - F.length(echo))).otherwise(raw)
