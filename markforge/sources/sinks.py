"""Sinks: submission CSV and prepared corpus tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str, order_by: str | None = None, single_file: bool = False,
              mode: str = "overwrite") -> None:
    """Headed CSV readable by pandas: doubled quotes, values not trimmed.

    Spark's defaults would write ``\\"`` and trim leading/trailing blanks.
    ``order_by`` sorts globally (range-partitioned, one shuffle) so the parts
    concatenate in order; ``single_file`` is for small outputs only.
    """
    out = df.orderBy(order_by) if order_by else df
    if single_file:
        out = out.coalesce(1)
    (out.write.mode(mode).option("header", True).option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
        .csv(path))


def write_submission(result: DataFrame, path: str, order_by: str | None = "id", single_file: bool = False) -> None:
    """Submission (id, svg)."""
    write_csv(result.select("id", "svg"), path, order_by=order_by, single_file=single_file)


def write_corpus(df: DataFrame, path: str, split_col: str = "split", mode: str = "overwrite",
                 order_col: str | None = None, partitions: int | None = None, keep_col: str | None = None,
                 observation: tuple[Observation, Sequence[Column]] | None = None) -> None:
    """Prepared training text partitioned by split (train / eval folders).

    With ``order_col`` (e.g. a salted hash: a seeded shuffle) the rows are
    range-partitioned on it and sorted by (split, order) inside each task:
    that sort already satisfies the writer's ordering by the partition
    column, so no second sort is added, and each split's files, read in name
    order, hold the rows in that order. ``keep_col`` writes only the rows
    where it is true. Neither column is written.

    ``observation`` = (``Observation``, metric columns) is collected over all
    rows, kept or not, during the write itself: no extra pass for reports.
    It sits after the ordering exchange, in the write's result stage, where
    Spark applies each task's metrics once even when tasks are retried.
    """
    if order_col is not None:
        df = df.repartitionByRange(partitions, order_col) if partitions else df.repartitionByRange(order_col)
    if observation is not None:
        obs, metrics = observation
        df = df.observe(obs, *metrics)
    if order_col is not None:
        df = df.sortWithinPartitions(split_col, order_col)
    if keep_col is not None:
        df = df.where(F.col(keep_col))
    df = df.drop(*[c for c in (order_col, keep_col) if c is not None])
    df.write.mode(mode).partitionBy(split_col).parquet(path)
