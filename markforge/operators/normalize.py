"""Projection of a source to a normalised (prompt, markup) pair table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from markforge.functions.text import evaluate_once, first_non_empty, is_truthy, starts_with_ci


def to_pairs(df: DataFrame, prompt_fields: Sequence[str], markup_fields: Sequence[str],
             root_tag: str = "svg", keep: Sequence[str] = ()) -> DataFrame:
    """Project every row to ``(prompt, svg)``; all other source columns drop.

    Each side is the first non-blank candidate field. Markup that does not
    start with ``<root_tag`` (lower-cased test) blanks **both** sides, so the
    row is removed by :func:`drop_empty`. ``keep`` carries extra columns
    (e.g. an id or source name) through unchanged.
    """
    # The chosen values are computed once in their own projection; later
    # filters (gate, budgets, token limit) reference them instead of
    # repeating the strip per reference.
    chosen = df.select(
        *[F.col(k) for k in keep],
        evaluate_once(first_non_empty(df.columns, prompt_fields)).alias("_prompt"),
        evaluate_once(first_non_empty(df.columns, markup_fields)).alias("_markup"),
    )
    gate = starts_with_ci("_markup", f"<{root_tag}")
    return chosen.select(
        *[F.col(k) for k in keep],
        F.when(gate, F.col("_prompt")).otherwise(F.lit("")).alias("prompt"),
        F.when(gate, F.col("_markup")).otherwise(F.lit("")).alias("svg"),
    )


def drop_empty(df: DataFrame, cols: Sequence[str] = ("prompt", "svg")) -> DataFrame:
    """Keep rows whose given string columns are all non-empty."""
    cond = None
    for c in cols:
        cond = is_truthy(c) if cond is None else cond & is_truthy(c)
    return df.where(cond)


def normalize_pairs(df: DataFrame, prompt_fields: Sequence[str], markup_fields: Sequence[str],
                    root_tag: str = "svg", keep: Sequence[str] = ()) -> DataFrame:
    """:func:`to_pairs` followed by :func:`drop_empty`."""
    return drop_empty(to_pairs(df, prompt_fields, markup_fields, root_tag, keep))
