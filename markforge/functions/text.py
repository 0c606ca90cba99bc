"""Python string semantics as native Spark expressions (Column -> Column)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from markforge.config import PY_WHITESPACE


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def py_strip(c: Column | str) -> Column:
    """``str.strip()``: trims all 29 code points for which ``isspace()`` holds.

    ``btrim`` with an explicit set is exact and far cheaper than a regex.
    """
    return F.btrim(_col(c), F.lit(PY_WHITESPACE))


def blank_to_null(c: Column | str) -> Column:
    """Stripped value, or NULL when the value is NULL or only whitespace."""
    return F.nullif(py_strip(c), F.lit(""))


def first_non_empty(columns: Iterable[str], candidates: Iterable[str]) -> Column:
    """First candidate field that is present, non-null and non-blank after
    ``str()`` + ``strip()``; ``''`` when none qualifies.

    Candidates missing from ``columns`` are skipped (fields are optional by
    name), so one spec serves sources with differing schemas.
    """
    present = set(columns)
    parts = [blank_to_null(F.col(k).cast("string")) for k in candidates if k in present]
    return F.coalesce(*parts, F.lit("")) if parts else F.lit("")


def is_truthy(c: Column | str) -> Column:
    """Python truthiness of an optional string: non-null and non-empty."""
    c = _col(c)
    return c.isNotNull() & (c != F.lit(""))


def count_literal(c: Column | str, sub: str) -> Column:
    """``str.count(sub)``: non-overlapping, case-sensitive literal count (INT).

    Arithmetic on lengths instead of a regex: every removed occurrence
    shortens the string by exactly ``len(sub)`` code points.
    """
    if not sub:
        raise ValueError("empty substring")
    c = _col(c)
    removed = F.length(c) - F.length(F.replace(c, F.lit(sub), F.lit("")))
    return (removed / F.lit(len(sub))).cast("int")


def starts_with_ci(c: Column | str, prefix: str) -> Column:
    """``s.lower().startswith(prefix)`` for an ASCII prefix.

    Only the first ``len(prefix)`` characters are lower-cased: no non-ASCII
    character lower-cases to ASCII letters other than ``i`` and ``k``, and one
    that expands (``İ``) cannot start an ASCII match either way, so the test
    is unchanged while the rest of a large document is never copied.
    """
    p = prefix.lower()
    if not p.isascii() or "i" in p or "k" in p:
        return F.startswith(F.lower(_col(c)), F.lit(p))
    return F.lower(F.substring(_col(c), 1, len(p))) == F.lit(p)


def null_sentinels_to_null(c: Column | str, sentinels: Iterable[str]) -> Column:
    """Map CSV null spellings (exact matches) to NULL."""
    c = _col(c)
    return F.when(c.isin(list(sentinels)), F.lit(None).cast("string")).otherwise(c)


def evaluate_once(c: Column | str) -> Column:
    """``c`` unchanged, but computed in its own projection.

    Catalyst pushes a filter through a projection by substituting each
    reference with the projected expression, so a budget filter over a
    normalised column would repeat the whole normalisation once per
    reference (dozens of copies of every strip). A projection holding a
    nondeterministic expression is never pushed through; ``spark_partition_id()
    >= 0`` is always true and costs one comparison.
    """
    return F.when(F.spark_partition_id() >= F.lit(0), _col(c))
