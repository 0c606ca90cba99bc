"""Counts and quality reports (small aggregations; nothing collects rows)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from markforge.functions.markup import ends_with_close_tag, is_valid_markup


def rows_per_group(df: DataFrame, col: str, out: str = "n_rows") -> DataFrame:
    """Usable rows per source (or any group): partial + final hash aggregate."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias(out))


def split_counts(df: DataFrame, split_col: str = "split", kept_col: str = "kept") -> DataFrame:
    """Rows per split entering rendering and rows kept by the token filter,
    both from one pass."""
    return df.groupBy(split_col).agg(
        F.count(F.lit(1)).alias("n_entered"),
        F.count_if(F.col(kept_col)).cast("long").alias("n_kept"),
    )


def fallback_report(result: DataFrame, flag_col: str = "used_fallback") -> DataFrame:
    """Output rows and how many of them used the fallback (one row)."""
    return result.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col(flag_col)).cast("long").alias("n_fallback"),
    )


def runtime_estimate(df: DataFrame, sample_minutes: float, sample_n: int, out: str = "est_minutes") -> DataFrame:
    """Linear run-time extrapolation ``sample_minutes / sample_n * rows``,
    rounded to two decimals (one row)."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.round(F.lit(float(sample_minutes)) / F.lit(float(sample_n)) * F.count(F.lit(1)), 2).alias(out),
    )


def require_sources(loaded: list, message: str = "No dataset loaded. Check source paths and schema fields."):
    """Guard: fail when no source could be loaded."""
    if not loaded:
        raise RuntimeError(message)
    return loaded


def output_quality(df: DataFrame, col: str = "svg", tag: str = "svg", head: int = 500, tail: int = 200,
                   validate: bool = True) -> DataFrame:
    """Per-row checks of final markup: validity, length, ends with the close
    tag, first ``head`` and last ``tail`` characters."""
    c = F.col(col)
    cols = [
        F.length(c).alias("n_chars"),
        ends_with_close_tag(c, tag).alias("ends_with_close"),
        F.substring(c, 1, head).alias("head"),
        F.right(c, F.lit(tail)).alias("tail"),
    ]
    if validate:
        cols.insert(0, is_valid_markup(c, tag).alias("valid"))
    return df.select(*[x for x in df.columns if x != col], *cols)


def quality_summary(q: DataFrame) -> DataFrame:
    """One-row shares of the per-row quality report."""
    return q.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.avg(F.col("valid").cast("double")).alias("share_valid"),
        F.avg(F.col("ends_with_close").cast("double")).alias("share_closed"),
        F.avg("n_chars").alias("mean_chars"),
    )
