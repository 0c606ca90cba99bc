"""Bag union of normalised sources."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from markforge.config import SourceSpec
from markforge.functions.text import evaluate_once, first_non_empty, is_truthy, starts_with_ci


def union_sources(named: Sequence[tuple[str, DataFrame]], source_col: str = "source_name") -> DataFrame:
    """Concatenate normalised sources (same columns by name), tagging each row
    with its source. A union is a plan node, not a shuffle: partitions are
    simply concatenated."""
    if not named:
        raise ValueError("no sources")
    tagged = [df.withColumn(source_col, F.lit(name)) for name, df in named]
    return reduce(lambda a, b: a.unionByName(b), tagged)


def shared_pairs(df: DataFrame, sources: Sequence[tuple[SourceSpec, Column | None]], keep: Sequence[str] = (),
                 root_tag: str = "svg", source_col: str = "source_name") -> DataFrame:
    """The normalised pairs of all ``sources`` that read ``df``, in one pass over it: the same rows as
    ``normalize_pairs`` of each source, united. ``sources`` gives each spec with the condition of its rows
    (``None``: all). A row carries the list of the sources it belongs to, which ``inline`` turns into rows, so one that
    belongs to several is read and normalised once. Candidate fields that sources have in common are looked up once
    and only in rows of a source that asks for them; a null condition is no membership."""
    if not sources:
        raise ValueError("no sources")
    here = [F.lit(True) if rows is None else F.coalesce(rows, F.lit(False)) for _, rows in sources]
    if all(rows is not None for _, rows in sources):
        df = df.where(reduce(Column.__or__, (rows for _, rows in sources)))  # reaches the scan
    fields = list(dict.fromkeys(f for spec, _ in sources for f in (spec.prompt_fields, spec.markup_fields)))
    asked = [reduce(Column.__or__, (h for h, (spec, _) in zip(here, sources) if f in (spec.prompt_fields, spec.markup_fields)))
             for f in fields]
    chosen = df.select(*keep, *(evaluate_once(F.when(a, first_non_empty(df.columns, f))).alias(f"_field{i}")
                                for i, (f, a) in enumerate(zip(fields, asked))),
                       *(h.alias(f"_in{i}") for i, h in enumerate(here)))

    def member(i: int, spec: SourceSpec) -> Column:
        prompt, markup = (F.col(f"_field{fields.index(f)}") for f in (spec.prompt_fields, spec.markup_fields))
        fits = F.col(f"_in{i}") & is_truthy(prompt) & is_truthy(markup) & starts_with_ci(markup, f"<{root_tag}")
        return F.when(fits, F.struct(prompt.alias("prompt"), markup.alias("svg"), F.lit(spec.name).alias(source_col)))

    members = F.array_compact(F.array(*(member(i, spec) for i, (spec, _) in enumerate(sources))))
    return chosen.select(*keep, F.inline(members))
