"""Toxic words are found whatever the number of labelled documents."""

import random

import pytest

from markforge.llm import op7


@pytest.mark.parametrize("toxic, slurs", [(50, 5), (2000, 100)])
def test_planted_toxic_words_are_found(spark, toxic, slurs):
    rnd = random.Random(3)
    rows = []
    for i in range(7 * toxic):
        text = [f"word{rnd.randrange(200)}" for _ in range(20)]
        if i < toxic:  # every slur in 10 or 20 toxic documents and no other
            text.insert(rnd.randrange(20), f"{i % slurs:03d}slur{i % slurs:03d}")
        rows.append((i, " ".join(text), "toxic" if i < toxic else "good"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, domain string")
    model = op7.fit(docs.select("text", "domain"), ["good", "toxic"])
    got = op7.posteriors(docs, model, ["good", "toxic"]).collect()
    found = {r.doc_id for r in got if r.p_toxic > 0.5}
    assert len(found & set(range(toxic))) == toxic
    assert len(found) <= 1.01 * toxic


def test_g_statistic():
    assert op7.g_statistic(10, 60, 50, 300) == pytest.approx(0)
    assert op7.g_statistic(0, 0, 50, 300) == pytest.approx(0)
    assert op7.g_statistic(50, 0, 50, 50) == pytest.approx(2 * 100 * 0.6931471805599453)


def test_log_odds_are_sums_over_the_distinct_features_and_the_weights_are_in_no_plan(spark):
    from pyspark.sql import functions as F

    buckets = 1 << 12
    rnd = random.Random(5)
    logs = {"low": [rnd.uniform(-1, 1) if i % 3 else 0.0 for i in range(2 * buckets)], "toxic": [rnd.uniform(-1, 1) if i % 4 else 0.0 for i in range(2 * buckets)]}
    model = logs, {"low": -1.5, "toxic": -2.5}
    texts = ["a b a word", "", None, " \t", "word " * 500, " ".join(f"w{i}" for i in range(3000)), "a b a word"]
    docs = spark.createDataFrame([(i if i else None, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = op7.log_odds(docs, model, ["good", "low", "toxic"], buckets, ("doc_id", "text"))
    found = docs.select("doc_id", "text", F.array_distinct(op7.features(F.array_distinct(op7.words(F.col("text"))), buckets)).alias("f")).collect()
    rows = {r.doc_id: r for r in got.collect()}
    assert len(rows) == got.count() == len(texts)
    for r in found:
        mine = rows[r.doc_id]
        assert mine.n_tokens == len((r.text or "").split()) and mine.s_good == 0
        for x in ("low", "toxic"):
            assert getattr(mine, f"s_{x}") == pytest.approx(model[1][x] + sum(logs[x][b - 1] for b in r.f), abs=1e-6)
    assert len(got._jdf.queryExecution().toString()) < 50_000
    twice = op7.log_odds(docs.unionAll(docs), model, ["good", "low", "toxic"], buckets)  # repeated rows stay rows of their own
    assert twice.count() == 2 * len(texts)


def test_a_step_of_the_fit_has_two_stages(spark):
    rnd = random.Random(7)
    rows = [(" ".join(f"word{rnd.randrange(60)}" for _ in range(12)) + (" bad" if i % 4 == 0 else ""), "toxic" if i % 4 == 0 else "good") for i in range(400)]
    docs = spark.createDataFrame(rows, "text string, domain string").repartition(8)
    sc, name = spark.sparkContext, "spark.sql.files.minPartitionNum"
    spark.conf.set(name, "8")  # else the few small files are read by as many tasks as there are cores
    sc.setJobGroup("op7-fit-stages", "fit")
    try:
        op7.fit(docs, ["good", "toxic"])
    finally:
        spark.conf.unset(name)
        sc.setLocalProperty("spark.jobGroup.id", None)
    tracker = sc.statusTracker()
    stages = [[x for x in map(tracker.getStageInfo, tracker.getJobInfo(job).stageIds) if x and "RDDLossFunction" in x.name]
              for job in tracker.getJobIdsForGroup("op7-fit-stages")]
    steps = [found for found in stages if found]
    assert len(steps) > 2 and all(len(found) == 2 and max(x.numTasks for x in found) > 1 for found in steps)
