from pyspark.sql import functions as F

from markforge.functions.tokens import count_tokens, generation_budget, token_ids, truncated_length
from markforge.operators.budgets import token_filter
from markforge.operators.report import output_quality, quality_summary


def test_pluggable_counter_and_factory(spark):
    df = spark.createDataFrame([("a b  c",), ("",), (None,), ("x" * 10,)], "t string")
    got = [r[0] for r in df.select(count_tokens("t", lambda s: len(s.split()))).collect()]
    assert got == [3, 0, None, 1]

    def factory():
        table = {"x": 1}
        return lambda s: sum(table.get(ch, 0) for ch in s)

    factory.is_factory = True
    got = [r[0] for r in df.select(count_tokens("t", factory)).collect()]
    assert got == [0, 0, None, 10]
    kept = token_filter(df.where("t is not null"), 2, "t", counter=lambda s: len(s.split()))
    assert sorted(r.t for r in kept.collect()) == ["", "x" * 10]


def test_token_ids_truncate(spark):
    df = spark.createDataFrame([("abc",), ("abcdef",)], "t string")
    got = [r[0] for r in df.select(token_ids("t", lambda s: [ord(ch) for ch in s], max_len=4)).collect()]
    assert got == [[97, 98, 99], [97, 98, 99, 100]]


def test_truncation_and_budget(spark):
    df = spark.createDataFrame([(10,), (2048,), (3000,), (1900,)], "n int")
    rows = df.select(truncated_length("n"), generation_budget("n", 640), generation_budget("n", 2000)).collect()
    assert [tuple(r) for r in rows] == [
        (10, 640, 1974), (2048, 128, 128), (2048, 128, 128), (1900, 128, 128)]
    assert df.select(F.count("*")).first()[0] == 4


def test_quality_summary(spark):
    df = spark.createDataFrame([(1, "<svg/>"), (2, "<svg>")], "id long, svg string")
    s = quality_summary(output_quality(df)).first()
    assert s.n_rows == 2 and s.share_valid == 0.5 and s.share_closed == 0.0
