"""Property tests: native expressions against Python's own semantics on
random batches (one Spark job per drawn batch)."""

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from markforge.config import PY_WHITESPACE
from markforge.functions.markup import extract_last_block
from markforge.functions.text import count_literal, py_strip
from markforge.functions.tokens import TOKEN_PATTERN, count_tokens

ALPHABET = st.sampled_from(list("ab_Z09 <>/=\"'.,;-\n\t\r\x0b\x0céñ😀") + list(PY_WHITESPACE[:12]) + ["svg", "<svg", "</svg>", "<path"])
TEXTS = st.lists(st.lists(ALPHABET, max_size=40).map("".join), min_size=1, max_size=60)
SLOW = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def _frame(spark, texts):
    return spark.createDataFrame([(t,) for t in texts], "t string")


@SLOW
@given(texts=TEXTS)
def test_token_proxy_counts_regex_matches(spark, texts):
    got = [r[0] for r in _frame(spark, texts).select(count_tokens("t")).collect()]
    assert got == [len(re.findall(TOKEN_PATTERN, t)) for t in texts]


@SLOW
@given(texts=TEXTS)
def test_strip_and_counts(spark, texts):
    rows = _frame(spark, texts).select(py_strip("t"), count_literal("t", "<path"), count_literal("t", "sv")).collect()
    assert [tuple(r) for r in rows] == [(t.strip(), t.count("<path"), t.count("sv")) for t in texts]


# Cases are drawn together with their expected value: no pattern is stated again.
BODY = st.lists(st.sampled_from(["<path/>", "<g>", "</g>", "</svg", "svg>", " ", "\n", "x", "é😀", "<SV", '"']), max_size=6).map("".join)
CASE = st.sampled_from([("svg", "svg"), ("SVG", "svg"), ("sVg", "SVG")])
ATTRS = st.sampled_from(["", " ", ' a="1"', "\n b='<'", "\t/"])
BLOCKS = st.tuples(CASE, ATTRS, BODY).map(lambda x: f"<{x[0][0]}{x[1]}>{x[2]}</{x[0][1]}>")
FILLER = st.lists(st.sampled_from(["text ", "<p>", "</svg>", "<svgs>", "<sv g>", "\u3000", "\n", "é", ">", "<"]), max_size=5).map(
    lambda x: "".join(x).rstrip("<"))
OPEN_END = st.sampled_from(["", "<svg>", "<svg a='1'> and no end", "<svg", " "])
EXTRACTIONS = st.lists(st.tuples(st.lists(st.tuples(FILLER, BLOCKS), max_size=3), FILLER, OPEN_END), min_size=1, max_size=40)


@SLOW
@given(cases=EXTRACTIONS)
def test_the_last_complete_block_is_taken(spark, cases):
    texts = ["".join(f + b for f, b in blocks) + tail + end for blocks, tail, end in cases]
    got = [r[0] for r in _frame(spark, texts).select(extract_last_block("t")).collect()]
    assert got == [blocks[-1][1] if blocks else "" for blocks, _, _ in cases]


NAME = st.sampled_from(["filling", "FILLING", "FiLLing"])
GAP = st.sampled_from(["", " ", "\n", " \t "])
VALUE = st.sampled_from(["evenodd", "", "a b", "'", "filling=x", "é"])
# (as written, as repaired)
REPAIRED = st.tuples(NAME, GAP, GAP, VALUE).map(lambda x: (f'{x[0]}{x[1]}={x[2]}"{x[3]}"', f'fill-rule="{x[3]}"'))
KEPT = st.sampled_from(["<path", "/>", "filling='x'", 'unfilling="y"', 'fillings="z"', "filling=w", 'fill="q"', "é", "text"]).map(lambda x: (x, x))
REPAIRS = st.lists(st.lists(st.one_of(REPAIRED, KEPT), min_size=1, max_size=8), min_size=1, max_size=40)


@SLOW
@given(cases=REPAIRS)
def test_attributes_are_renamed_where_they_stand(spark, cases):
    from markforge.functions.markup import repair_attributes

    texts = ["  " + " ".join(old for old, _ in case) + "\n" for case in cases]
    got = [r[0] for r in _frame(spark, texts).select(repair_attributes("t")).collect()]
    assert got == [" ".join(new for _, new in case) for case in cases]


GATE_ALPHABET = st.sampled_from(["<", "s", "S", "v", "V", "g", "G", "ſ", "İ", "K", " ", "x", "<svg", "<SVG"])
GATE_TEXTS = st.lists(st.lists(GATE_ALPHABET, max_size=8).map("".join), min_size=1, max_size=80)


@SLOW
@given(texts=GATE_TEXTS)
def test_prefix_gate_agrees_with_python_lower(spark, texts):
    from markforge.functions.text import starts_with_ci

    got = [r[0] for r in _frame(spark, texts).select(starts_with_ci("t", "<svg")).collect()]
    assert got == [t.lower().startswith("<svg") for t in texts]


BLANK_CELL = st.sampled_from([None, "", " ", "\n\t", "\u3000"])
FULL_CELL = st.sampled_from([("a", "a"), (" b ", "b"), ("\u3000c\n", "c"), (" d e", "d e")])
LATER = st.sampled_from([None, "", "late", " later "])


@SLOW
@given(cases=st.lists(st.tuples(st.integers(0, 3), FULL_CELL, st.lists(BLANK_CELL, min_size=3, max_size=3), LATER), min_size=1, max_size=40))
def test_first_filled_field_wins(spark, cases):
    from markforge.functions.text import first_non_empty

    rows, want = [], []
    for at, (written, stripped), blanks, later in cases:  # blanks before place ``at``, anything after it
        rows.append(tuple([*blanks[:at], written, later, later][:3]))
        want.append(stripped if at < 3 else "")
    df = spark.createDataFrame(rows, "a string, b string, c string")
    assert [r[0] for r in df.select(first_non_empty(df.columns, ["missing", "a", "b", "c"])).collect()] == want


XML_PARTS = st.sampled_from(["<svg>", "</svg>", "<svg/>", "<SVG>", "</SVG>", "<g>", "</g>", "<g/>", " ", "&amp;",
                             "&nbsp;", "<?xml version=\"1.0\"?>", "<!-- c -->", "x", "<s:svg xmlns:s=\"u\">",
                             "</s:svg>", "<mysvg>", "</mysvg>", "\n"])
XML_TEXTS = st.lists(st.lists(XML_PARTS, max_size=6).map("".join), min_size=1, max_size=60)


@SLOW
@given(texts=XML_TEXTS)
def test_validity_prefilter_only_skips_invalid_rows(spark, texts):
    from markforge.functions.markup import is_valid_markup, valid_markup_py

    df = _frame(spark, texts)
    rows = df.select(is_valid_markup("t", "svg", "strict"), is_valid_markup("t", "svg", "suffix")).collect()
    assert [tuple(r) for r in rows] == [(valid_markup_py(t, "svg", "strict"), valid_markup_py(t, "svg", "suffix"))
                                        for t in texts]
