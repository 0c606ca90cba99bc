"""The rates of source mixing against NumPy, on the test tables and on inputs that cannot be met."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from markforge.llm import op7


def frame(spark, p, n):
    rows = [(i, int(k), *map(float, x)) for i, (x, k) in enumerate(zip(p, n))]
    return spark.createDataFrame(rows, "doc_id long, n_tokens long, p_a double, p_b double, p_c double")


def optimum(p, n, t):
    """Smallest squared distance that rates of 0 and more reach: plain projected gradient, many steps."""
    a = p * n[:, None] / n.sum()
    r, step = np.ones(len(n)), 1 / np.linalg.norm(a, 2) ** 2
    for _ in range(60000):
        r = np.maximum(0, r - step * a @ (a.T @ r - t))
    return np.linalg.norm(a.T @ r - t)


@pytest.mark.parametrize("seed,targets,met", [(1, (0.85, 0.10, 0.05), True), (2, (0.2, 0.2, 0.6), True), (3, (0.98, 0.01, 0.01), False)])
def test_rates_reach_the_optimum(spark, seed, targets, met):
    rnd = np.random.default_rng(seed)
    p = rnd.dirichlet((0.5, 0.3, 0.4) if met else (4, 4, 4), 300)
    n = rnd.integers(1, 400, 300)
    n[:3] = 0
    rated, shares, found = op7.fit_rates(frame(spark, p, n), dict(zip("abc", targets)))
    rows = rated.orderBy("doc_id").collect()
    rate = np.array([r.rate for r in rows])
    reached = (p * n[:, None] * rate[:, None]).sum(axis=0) / n.sum()
    assert found is met and (rate >= 0).all() and np.allclose(reached, list(shares.values()), atol=1e-9)
    assert (rate[:3] == 1).all()
    gap = np.linalg.norm(reached - targets)
    assert gap <= 2e-3 if met else gap <= 1.05 * optimum(p, n, np.array(targets)) + 2e-3


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_shares_on_the_tables(spark, sf):
    folder = f"/root/testdata/{sf}"
    got = op7.mix_sources(spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet"))
    n = F.col("n_tokens")
    row = got.agg(F.sum(n).alias("n"), F.min("targets_met").alias("met"), *(F.sum(F.col("rate") * n * F.col(f"p_{d}")).alias(d) for d in op7.TARGETS)).first()
    assert row.met and all(abs(row[d] / row.n - t) <= 1e-3 for d, t in op7.TARGETS.items())


def test_defined_results(spark):
    rnd = random.Random(3)
    good, bad = [f"g{i}" for i in range(40)], [f"b{i}" for i in range(40)]
    rows = [(i, " ".join(rnd.choice(good if i % 3 else bad) for _ in range(30))) for i in range(600)]
    rows += [(600, None), (601, ""), (602, "g1 " * 200_000), (603, rows[1][1]), (603, rows[1][1]), (None, "g1 g2"), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "*", "1 as rate", "2 as copies", "3 as n_tokens", "4 as p_good", "'x' as domain", "5 as row_key", "6 as share_good")
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(500)] + [(None, 1, 0), (7, 0, 0)], "doc_id long, quality int, toxic int")
    targets = {"good": 0.5, "low": 0.5}
    got = op7.mix_sources(docs, labels, targets).collect()
    assert len(got) == len(rows) and all(r.targets_met for r in got)
    assert len({(r.rate, r.copies, r.p_good) for r in got if r.doc_id == 603}) == 1
    assert next(r.n_tokens for r in got if r.doc_id == 602) == 200_000
    with pytest.raises(ValueError, match="no rates"):  # one label only: every posterior is the same
        op7.mix_sources(docs, labels.filter("quality = 1"), {"good": 0.1, "low": 0.9}, strict=True)
    flagged = op7.mix_sources(docs, labels.limit(0), {"good": 0.1, "low": 0.9}).collect()
    assert len(flagged) == len(rows) and not any(r.targets_met for r in flagged)
