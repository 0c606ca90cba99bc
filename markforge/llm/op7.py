"""Mixing sources to target weights by soft membership, in DataFrame functions only.

A logistic regression, fitted by Spark on a sample of the labelled rows of
about ``SAMPLE`` rows (those with the smallest hash of their id; a quarter of them is held out and gives
its errors, which are logged), gives each
document a posterior over domains; its features are the presence of
hashed words and hashed word ends. With ``a[i,d] = posterior * words / all words``, the
rates ``r[i] >= 0`` minimise the squared distance between ``sum_i r[i] a[i,d]`` and the
target weights by projected gradient from ``r = 1``, scaled by the inverse Gram matrix of
the rows whose rate is positive. The gradient is taken per
word, so a long document is not pushed harder than a short one. An
iteration needs one aggregate over the staged posteriors (a sum per domain and per pair of domains);
a rate is a column expression of one number per domain, and nothing but the sums reaches the driver. The shares that
the rates give are part of the result, with a mark whether they meet the targets.

Defined results: a text without words has the prior as posterior, rate 1 and no
effect on the totals; repeated rows are rows of their own; labels that match no
document, null labels and null ids are not used; without labelled rows all
posteriors are equal; empty tables give empty results.
"""

from __future__ import annotations

import logging
import math
from functools import reduce

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from markforge.llm.common import checked_broadcast, staged

log = logging.getLogger(__name__)

SPACES = "[\\x20\\x09-\\x0D]+"
BUCKETS = 1 << 15
SAMPLE = 20_000
STEPS, TOLERANCE, RIDGE = 60, 1e-3, 1e-6
FIT_TASKS, LEAST_G = 4, 2.7
PRIOR, ITERATIONS = 2.0, 60  # of the classifier: its penalty is PRIOR / rows, a weight's variance of 1 / PRIOR at every size

# Domains of the labels table and the shares of words they should have.
DOMAINS = {"good": "quality = 1 and toxic = 0", "low": "quality = 0 and toxic = 0", "toxic": "toxic = 1"}
TARGETS = {"good": 0.85, "low": 0.10, "toxic": 0.05}


def words(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACES), lambda w: w != "")


def buckets_of(w: Column, buckets: int) -> tuple[Column, Column]:
    """The feature buckets of a word, from 1: its own and, in a second range, that of its last three characters."""
    return ((F.pmod(F.xxhash64(F.lower(w)), F.lit(buckets)) + 1).cast("int"),
            (F.pmod(F.xxhash64(F.right(w, F.lit(3))), F.lit(buckets)) + 1 + buckets).cast("int"))


def features(ws: Column, buckets: int) -> Column:
    """The feature buckets of a document's distinct words; some may repeat."""
    return F.concat(F.transform(ws, lambda w: buckets_of(w, buckets)[0]),
                    F.transform(ws, lambda w: buckets_of(w, buckets)[1]))


def _g_cells(a, b, n, m):
    whole, found = n + m, a + b
    return whole, ((a, found * n), (b, found * m), (n - a, (whole - found) * n), (m - b, (whole - found) * m))


def g_statistic(a: float, b: float, n: float, m: float) -> float:
    """G of the table of ``a`` of ``n`` and ``b`` of ``m`` documents; exact counts of 0 are evidence too."""
    whole, cells = _g_cells(a, b, n, m)
    return 2 * sum(x * math.log(x * whole / e) for x, e in cells if x)


def g_column(a: Column, b: Column, n: int, m: int) -> Column:
    """:func:`g_statistic` of columns of counts."""
    whole, cells = _g_cells(a, b, n, m)
    return 2 * sum((F.when(x > 0, x * F.log(x * whole / e)).otherwise(0.0) for x, e in cells), F.lit(0.0))


def fit(labelled: DataFrame, domains: list[str], buckets: int = BUCKETS, least: float = LEAST_G, prior: float = PRIOR):
    """Weights of the feature buckets and constants of the domains but the first, against the first: a
    multinomial logistic regression with a squared penalty, fitted by Spark on a bounded sample of rows ``text,
    domain``. The penalty shrinks every weight, so the sum over a long text stays calibrated. Buckets that
    hardly differ between the domains (G below ``least``) are left out before."""
    rows = staged(labelled.select("domain", F.array_distinct(features(F.array_distinct(words(F.col("text"))), buckets)).alias("found")),
                  "op7-training")
    docs = {r["domain"]: r["count"] for r in rows.groupBy("domain").count().collect()}
    present, total = [d for d in domains if docs.get(d)], sum(docs.values())
    found = rows.select("domain", F.explode("found").alias("b")).groupBy("b").agg(
        F.count(F.lit(1)).cast("double").alias("every"), *(F.count_if(F.col("domain") == d).cast("double").alias(f"n_{d}") for d in present))
    tells = [g_column(F.col(f"n_{d}"), F.col("every") - F.col(f"n_{d}"), docs[d], total - docs[d]) >= least for d in present]
    # one row of at most 2 x buckets numbers
    kept = found.filter(reduce(Column.__or__, tells, F.lit(False))).agg(F.sort_array(F.collect_list(F.col("b") - 1))).first()[0]
    # a domain without labelled rows has the weights 0 and a small constant
    weights = {d: [0.0] * (2 * buckets) for d in domains}
    constant = {d: math.log((docs.get(d, 0) + 1) / (total + len(domains))) for d in domains}
    if len(present) > 1 and kept:
        names = [str(b + 1) for b in kept]
        terms = CountVectorizerModel.from_vocabulary(names, "terms", "features").setBinary(True)
        number = F.array_position(F.array(*map(F.lit, present)), F.col("domain")) - 1
        train = terms.transform(rows.select(number.cast("double").alias("label"), F.col("found").cast("array<string>").alias("terms")))
        # an iteration is a stage that adds a gradient a task, and one that adds those of all tasks; from six tasks on
        # there is a third between them, and each stage costs the driver a broadcast of 4 MB
        fitted = LogisticRegression(family="multinomial", regParam=prior / total, maxIter=ITERATIONS, tol=1e-4,
                                    standardization=False).fit(train.coalesce(FIT_TASKS))
        matrix, constants = fitted.coefficientMatrix.toArray(), fitted.interceptVector.toArray()
        for d, row, c in zip(present, matrix, constants):
            constant[d] = float(c)
            for b, w in zip(kept, row):
                weights[d][b] = float(w)
    base = domains[0]
    return ({d: [x - y for x, y in zip(weights[d], weights[base])] for d in domains[1:]},
            {d: constant[d] - constant[base] for d in domains[1:]})


def weight_table(spark: SparkSession, model, domains: list[str], buckets: int = BUCKETS) -> DataFrame:
    """``b`` and ``w_<domain>``: a row for each feature bucket with a weight, at most 2 x buckets. A table, as
    constants of this size would be written out in every plan, its string and its events on the driver."""
    logs = model[0]
    rows = [(i + 1, *(float(f"{logs[x][i]:.9g}") for x in domains[1:])) for i in range(2 * buckets) if any(logs[x][i] for x in domains[1:])]
    return spark.createDataFrame(rows, "b int" + "".join(f", `w_{x}` double" for x in domains[1:]))


def log_odds(docs: DataFrame, model, domains: list[str], buckets: int = BUCKETS, keep=("doc_id",)) -> DataFrame:
    """``keep`` columns, ``n_tokens`` and ``s_<domain>``, the sum of the log odds of the row's features against
    the first domain. The weights are broadcast to the features of a row, which are summed where its text
    is read; what is shuffled is one row of sums a document."""
    constant = model[1]
    d = docs.select(*keep, words(F.col("text")).alias("ws"))
    d = d.select(*keep, F.size("ws").cast("long").alias("n_tokens"), F.monotonically_increasing_id().alias("__row"),
                 F.array_distinct(features(F.array_distinct("ws"), buckets)).alias("found"))
    found = d.select("*", F.explode_outer("found").alias("b")).drop("found")
    weighed = found.join(F.broadcast(weight_table(docs.sparkSession, model, domains, buckets)), "b", "left")
    n, first = F.first("n_tokens").alias("n_tokens"), F.lit(0.0).alias(f"s_{domains[0]}")
    summed = weighed.groupBy("__row", *keep).agg(n, *(F.coalesce(F.sum(f"w_{x}"), F.lit(0.0)).alias(f"w_{x}") for x in domains[1:]))
    return summed.select(*keep, "n_tokens", first, *((F.lit(constant[x]) + F.col(f"w_{x}")).alias(f"s_{x}") for x in domains[1:]))


def posteriors(docs: DataFrame, model, domains: list[str], buckets: int = BUCKETS, keep=("doc_id",)) -> DataFrame:
    """``keep`` columns, ``n_tokens`` and the posterior ``p_<domain>`` per row of ``docs``."""
    d = log_odds(docs, model, domains, buckets, keep)
    top = F.greatest(*(F.col(f"s_{x}") for x in domains)) if len(domains) > 1 else F.col(f"s_{domains[0]}")
    d = d.select(*keep, "n_tokens", *(F.exp(F.col(f"s_{x}") - top).alias(f"e_{x}") for x in domains))
    total = sum((F.col(f"e_{x}") for x in domains[1:]), F.col(f"e_{domains[0]}"))
    return d.select(*keep, "n_tokens", *((F.col(f"e_{x}") / total).alias(f"p_{x}") for x in domains))


def held_out_table(labelled: DataFrame, model, domains: list[str], buckets: int = BUCKETS) -> dict:
    """``{(label, likeliest domain): rows}`` of labelled rows (``text, domain``) that the fit has not seen."""
    rows = posteriors(labelled, model, domains, buckets, ("domain",))
    best = F.greatest(*(F.struct(F.col(f"p_{d}").alias("p"), F.lit(d).alias("d")) for d in domains))["d"]
    found = rows.groupBy("domain", best.alias("best")).count().collect()  # one row a pair of domains
    return {(r["domain"], r["best"]): r["count"] for r in found}


def _solve(matrix: list[list[float]], vector: list[float]) -> list[float]:
    """Solve a small positive definite system."""
    n = len(vector)
    rows = [[*row, v] for row, v in zip(matrix, vector)]
    for i in range(n):
        rows[i] = [x / rows[i][i] for x in rows[i]]
        for k in range(n):
            if k != i:
                rows[k] = [x - rows[k][i] * y for x, y in zip(rows[k], rows[i])]
    return [row[n] for row in rows]


def fit_rates(scored: DataFrame, targets: dict[str, float], steps: int = STEPS, tolerance: float = TOLERANCE):
    """``(scored with its rate, achieved shares, whether they meet the targets)`` for the staged posteriors.

    Projected gradient: the gradient of a row's rate, per word, is its posterior times the shares' distance from the
    targets. Steps add up in ``push``, one number a domain, and the rate is their sum projected onto rates of 0 and
    more, ``max(0, 1 - posterior . push)``. A step is scaled by the inverse Gram matrix of the posteriors
    of the rows whose rate is positive, so one that changes no row's sign meets the targets at once, and halved while it does not
    lower the convex function whose gradient it follows. ``RIDGE`` keeps that function bounded where targets cannot be met;
    the rates then give the nearest shares that rates of 0 and more can reach."""
    domains = list(targets)
    size = range(len(domains))
    p = [F.col(f"p_{d}") for d in domains]
    n, t = F.col("n_tokens").cast("double"), [targets[d] for d in domains]
    total = scored.agg(F.sum(n)).first()[0] or 0.0

    def rate(push: list[float]) -> Column:
        return F.greatest(F.lit(0.0), F.lit(1.0) - sum((F.lit(x) * c for x, c in zip(push[1:], p[1:])), F.lit(push[0]) * p[0]))

    def measured(push: list[float]):
        """Value, shares and Gram matrix of the rows in use: one aggregate."""
        r = rate(push)
        used = F.when(r > 0, n).otherwise(F.lit(0.0))
        got = scored.agg(F.sum(n * r * r), *(F.sum(n * r * c) for c in p), *(F.sum(used * p[i] * p[j]) for i in size for j in size if i <= j)).first()
        got = [(x or 0.0) / total for x in got]
        cells = iter(got[1 + len(p):])
        gram = [[0.0] * len(p) for _ in p]
        for i in size:
            for j in size:
                if i <= j:
                    gram[i][j] = gram[j][i] = next(cells)
        value = got[0] / 2 + sum(x * y + RIDGE / 2 * x * x for x, y in zip(push, t))
        return value, got[1:1 + len(p)], gram

    push, shares, taken = [0.0] * len(p), list(t), 0
    if total:
        value, shares, gram = measured(push)
    while total and taken < steps and max(abs(x - y) for x, y in zip(shares, t)) > tolerance:
        slope = [y - x + RIDGE * u for x, y, u in zip(shares, t, push)]
        if max(map(abs, slope)) <= tolerance / 100:
            break  # the nearest shares
        move = _solve([[g + (RIDGE if i == j else 0.0) for j, g in enumerate(row)] for i, row in enumerate(gram)], [-x for x in slope])
        fall, length = sum(x * y for x, y in zip(slope, move)), 1.0
        while True:
            tried = [u + length * x for u, x in zip(push, move)]
            found = measured(tried)
            taken += 1
            if found[0] <= value + 1e-4 * length * fall or taken >= steps:
                break
            length /= 2
        push, (value, shares, gram) = tried, found
    met = max((abs(x - y) for x, y in zip(shares, t)), default=0.0) <= tolerance
    return (scored.withColumn("rate", F.when(F.col("n_tokens") > 0, rate(push)).otherwise(F.lit(1.0))),
            dict(zip(domains, shares)), met)


def mix_sources(docs: DataFrame, labels: DataFrame, targets: dict[str, float] = TARGETS, domains: dict[str, str] = DOMAINS,
                buckets: int = BUCKETS, sample: int = SAMPLE, strict: bool = False) -> DataFrame:
    """Per row of ``docs``: ``doc_id, row_key, n_tokens, p_<domain>, rate``, ``copies`` (the rate, its fraction
    rounded up or down by a hash of the id), ``share_<domain>``, the share of words that the rates give each
    domain, and ``targets_met``. Targets that cannot be met are logged, and an error with ``strict``."""
    names = list(targets)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       F.xxhash64("doc_id", "text").alias("row_key"))
    domain = F.coalesce(*(F.when(F.expr(domains[x]), F.lit(x)) for x in names))
    marks = staged(labels.select(F.col("doc_id").cast("long").alias("doc_id"), domain.alias("domain"))
                   .filter("doc_id is not null and domain is not null").dropDuplicates(["doc_id"]), "op7-labels")
    # the sample is taken before the texts are joined, so the join is bounded
    share = min(1.0, sample / max(1, marks.count()))
    part = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    marks = staged(marks.filter(part < share * float(1 << 30)), "op7-sample")
    known = rows.join(checked_broadcast(marks), "doc_id").select("doc_id", "text", "domain")
    held = F.pmod(F.xxhash64("doc_id", F.lit("held")), F.lit(4)) == 0
    model = fit(known.filter(~held), names, buckets)
    log.info("mixing: held-out rows by (label, likeliest domain): %s", held_out_table(known.filter(held), model, names, buckets))
    scored = staged(posteriors(rows, model, names, buckets, ("doc_id", "row_key")), "op7-posteriors")
    scored, shares, met = fit_rates(scored, targets)
    if not met:
        message = f"mixing: no rates of 0 and more meet the targets {targets}; the nearest shares are {shares}"
        if strict:
            raise ValueError(message)
        log.warning(message)
    toss = F.pmod(F.xxhash64("doc_id", "row_key", F.lit("copies")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    copies = F.floor("rate") + F.when(toss < F.col("rate") - F.floor("rate"), 1).otherwise(0)
    return scored.select("*", copies.cast("long").alias("copies"), *(F.lit(shares[d]).alias(f"share_{d}") for d in names),
                         F.lit(met).alias("targets_met"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sources(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return mixed.drop("row_key")
