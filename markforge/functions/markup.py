"""Markup scalars: extraction, attribute repair, fallback, XML validity."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from markforge.config import DEFAULT_RENAMES, FALLBACK_SVG, PY_WS_CLASS
from markforge.functions.text import _col, py_strip


def block_pattern(tag: str = "svg") -> str:
    """Lazy, case-insensitive, multi-line block ``<tag ...>...</tag>``.

    The word boundary after the tag name also admits ``<tag-x>``; the lazy body stops
    at the first closing tag, so a nested block is cut short.
    """
    t = re.escape(tag)
    return rf"(?i)<{t}(?![\p{{L}}\p{{N}}_])[^>]*>[\s\S]*?</{t}>"


def extract_last_block(c: Column | str, tag: str = "svg") -> Column:
    """Last ``<tag>…</tag>`` block of the text, stripped; ``''`` if none.

    ``try_element_at`` keeps an empty match list from failing the task
    under ANSI mode.
    """
    # nothing after the last close tag can match; without the cut each unclosed
    # open tag would scan to the end of the text
    closed = F.regexp_extract(_col(c), rf"(?is)\A.*</{re.escape(tag)}>", 0)
    blocks = F.regexp_extract_all(closed, F.lit(block_pattern(tag)), F.lit(0))
    return F.coalesce(py_strip(F.try_element_at(blocks, F.lit(-1))), F.lit(""))


def rename_pattern(old: str) -> str:
    """``old="v"`` (case-insensitive, double quotes, optional blanks around =)."""
    ws = PY_WS_CLASS
    return rf'(?i)(?<![\p{{L}}\p{{N}}_]){re.escape(old)}{ws}*={ws}*"([^"]*)"'


def repair_attributes(c: Column | str, renames: dict[str, str] | None = None) -> Column:
    """Rename attributes (``filling`` -> ``fill-rule`` by default), then strip.

    NULL becomes ``''`` (a non-string is unusable).
    """
    out = _col(c)
    for old, new in (DEFAULT_RENAMES if renames is None else renames).items():
        out = F.regexp_replace(out, F.lit(rename_pattern(old)), F.lit(f'{new}="$1"'))
    return F.coalesce(py_strip(out), F.lit(""))


def fallback(doc: str = FALLBACK_SVG) -> Column:
    """The constant fallback document (ignores the prompt)."""
    return F.lit(doc)


def ends_with_close_tag(c: Column | str, tag: str = "svg") -> Column:
    """``s.strip().endswith('</tag>')``."""
    return F.endswith(py_strip(c), F.lit(f"</{tag}>"))


# --------------------------------------------------------------------------
# XML validity: the one scalar native functions cannot express exactly
# (``from_xml`` is permissive, ``xpath_*`` fails the job on malformed input).
# --------------------------------------------------------------------------


class _RootName:
    """Parser target that keeps the first start tag and builds no tree."""

    name = None

    def start(self, tag, attrs):
        if self.name is None:
            self.name = tag

    def close(self):
        return self.name


# What a root name must be, by mode; names come as ``{namespace}local``.
_ROOT_TESTS = {
    "strict": lambda name, tag: name.rpartition("}")[2] == tag if name.startswith("{") else name == tag,
    "suffix": lambda name, tag: name.endswith(tag),
}


def valid_markup_py(text, tag: str = "svg", mode: str = "strict") -> bool:
    """Whether one text is well formed and its root passes the mode's test."""
    from xml.etree.ElementTree import ParseError, XMLParser

    if not isinstance(text, str):
        return False
    parser = XMLParser(target=_RootName())
    try:
        parser.feed(text)
        name = parser.close()
    except (ParseError, ValueError):
        return False
    return bool(name) and _ROOT_TESTS[mode](name, tag)


def _count(c: Column, part: str) -> Column:
    """Occurrences of ``part``, none overlapping, by the length that goes without it."""
    return (F.length(c) - F.length(F.replace(c, F.lit(part), F.lit("")))) / F.lit(len(part))


def may_be_well_formed(c: Column | str) -> Column:
    """False only for texts that cannot be well-formed XML, by counts of their marks.

    ``<`` stands raw only in tags, instructions, comments and the like. Without ``<!`` (comments,
    CDATA sections and document types may hold any marks) and ``<?`` past the start, each ``<`` thus opens a start or an end
    tag, and the start tags without an end tag are self-closing: no more of them than ``/>``, and none below zero.
    """
    c = _col(c)
    starts = _count(c, "<") - _count(c, "</") - _count(c, "<?")
    unclosed = starts - _count(c, "</")
    balanced = (starts > 0) & (unclosed >= 0) & (unclosed <= _count(c, "/>"))
    one_instruction = _count(c, "<?") <= F.startswith(c, F.lit("<?xml ")).cast("int")
    return c.isNotNull() & F.when(c.contains("<!") | ~one_instruction, c.contains("/>") | c.contains("</")).otherwise(balanced)


def may_have_root(c: Column | str, tag: str = "svg") -> Column:
    """False only for texts whose first mark is a start tag with a name that does not end with ``tag``."""
    name = F.regexp_extract(_col(c), r"^[ \t\r\n]*<([^\s/><?!]+)", 1)
    return (name == "") | F.endswith(name, F.lit(tag))


def _validity_udf(tag: str, mode: str):
    @F.pandas_udf("boolean")
    def _valid(s: pd.Series) -> pd.Series:
        return pd.Series([valid_markup_py(v, tag, mode) if v is not None else False for v in s],
                         dtype=bool)

    return _valid


def is_valid_markup(c: Column | str, tag: str = "svg", mode: str = "strict") -> Column:
    """Well-formed XML whose root's local name equals ``tag`` (``strict``) or
    whose root name merely ends with it (``suffix``).

    Native conditions (:func:`may_be_well_formed`, :func:`may_have_root`) keep most invalid texts, such
    as truncated ones, from Python: they reach the Arrow UDF as NULL and cost no parse.
    """
    if mode not in ("strict", "suffix"):
        raise ValueError(mode)
    c = _col(c)
    return _validity_udf(tag, mode)(F.when(may_be_well_formed(c) & may_have_root(c, tag), c))
