import importlib
import math

import pytest

E = importlib.import_module("__spark_entry__")
SF = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["doc_id", "split", "text", "n_tokens"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    from markforge.plans.queries import QUERIES

    assert set(QUERIES) <= set(E.oracle_sql())


def _norm(v):
    if isinstance(v, float):
        return round(v, 9)
    return v


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    cols = df.columns
    got = sorted(tuple(_norm(r[c]) for c in sorted(cols)) for r in df.collect())
    res = duck.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(ocols) == sorted(cols)
    idx = [ocols.index(c) for c in sorted(cols)]
    exp = sorted(tuple(_norm(r[i]) for i in idx) for r in res.fetchall())
    assert len(got) == len(exp)
    assert got == exp
    assert not any(isinstance(v, float) and math.isnan(v) for row in got for v in row)
