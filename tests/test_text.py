import random
import sys

from pyspark.sql import functions as F

from markforge.config import PY_WHITESPACE
from markforge.functions.text import count_literal, first_non_empty, py_strip, starts_with_ci


def test_whitespace_set_is_pythons():
    assert len(PY_WHITESPACE) == 29
    assert all(c.isspace() for c in PY_WHITESPACE)
    assert sum(chr(i).isspace() for i in range(sys.maxunicode + 1)) == 29


def test_strip_matches_python(spark):
    rnd = random.Random(7)
    alphabet = PY_WHITESPACE + "ab<>é😀 "
    vals = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 12))) for _ in range(300)]
    vals += [c + "x" + c for c in PY_WHITESPACE] + ["​x​"]  # zero-width space is not whitespace
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    got = [r[0] for r in df.select(py_strip("s")).collect()]
    assert got == [v.strip() for v in vals]


def test_first_non_empty_skips_missing_null_blank(spark):
    df = spark.createDataFrame([(None, "  ", " x "), ("\t", None, None), (" a", "b", "c")], "p string, q string, r string")
    got = [r[0] for r in df.select(first_non_empty(df.columns, ["p", "missing", "q", "r"])).collect()]
    assert got == ["x", "", "a"]


def test_first_non_empty_casts_like_str_for_ints(spark):
    df = spark.createDataFrame([(None, 12)], "p string, n bigint")
    assert df.select(first_non_empty(df.columns, ["p", "n"])).first()[0] == "12"


def test_count_literal_matches_str_count(spark):
    rnd = random.Random(3)
    vals = ["".join(rnd.choice("<pathc ") for _ in range(rnd.randint(0, 40))) for _ in range(300)]
    vals += ["<pathfoo<path", "<PATH<path", "<<path<pat", "aaaa"]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    got = df.select(count_literal("s", "<path").alias("a"), count_literal("s", "aa").alias("b")).collect()
    assert [(r.a, r.b) for r in got] == [(v.count("<path"), v.count("aa")) for v in vals]


def test_prefix_gate_is_case_insensitive(spark):
    df = spark.createDataFrame([("<SVG x>",), ("<?xml?><svg>",), ("<svgz",), (" <svg",)], "s string")
    got = [r[0] for r in df.select(starts_with_ci("s", "<svg")).collect()]
    assert got == [True, False, True, False]
    assert df.select(F.count("*")).first()[0] == 4
