"""Budget filters: structural (length and element counts) and token budgets."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from markforge.config import DEFAULT_BUDGET, StructuralBudget
from markforge.functions.text import _col, count_literal, evaluate_once
from markforge.functions.tokens import count_tokens


def within_structure(c: Column | str, budget: StructuralBudget = DEFAULT_BUDGET) -> Column:
    """Predicate: length and every raw substring count within the budget.

    Length comes first so codegen short-circuits the cheap test.
    """
    c = _col(c)
    cond = F.lit(True) if budget.max_len is None else F.length(c) <= F.lit(budget.max_len)
    for sub, k in budget.max_counts:
        cond = cond & (count_literal(c, sub) <= F.lit(k))
    return cond


def structural_filter(df: DataFrame, col: str = "svg", budget: StructuralBudget = DEFAULT_BUDGET) -> DataFrame:
    """Keep rows whose markup fits the structural budget."""
    return df.where(within_structure(col, budget))


def with_token_count(df: DataFrame, text_col: str = "text", out: str = "n_tokens",
                     counter: Callable[[str], int] | None = None) -> DataFrame:
    """Add the token count of ``text_col`` (special tokens not added)."""
    return df.withColumn(out, evaluate_once(count_tokens(text_col, counter)))


def token_filter(df: DataFrame, max_tokens: int = 1700, text_col: str = "text",
                 counter: Callable[[str], int] | None = None, out: str = "n_tokens") -> DataFrame:
    """Keep rows whose text has at most ``max_tokens`` tokens."""
    return with_token_count(df, text_col, out, counter).where(F.col(out) <= F.lit(max_tokens))
