"""Buckets of window hashes: their number follows the bytes of text, each is one partition, and the result does not depend on it."""

import pytest

from markforge.llm import op9
from markforge.llm.common import keyed


@pytest.fixture(scope="module")
def docs(spark):
    shared = " ".join(f"s{i}" for i in range(120))
    rows = [(i, f"own{i} {shared} tail{i} " + " ".join(f"u{i}x{j}" for j in range(60))) for i in range(40)]
    return spark.createDataFrame([*rows, (40, None), (41, ""), (None, shared)], "doc_id long, text string")


def test_buckets_follow_the_bytes(docs):
    size = sum(len(r.text or "") for r in docs.collect())
    cores = docs.sparkSession.sparkContext.defaultParallelism
    assert op9.buckets_for(docs, text=100) == max(cores, -(-size // 100))
    assert op9.buckets_for(docs) == cores
    assert op9.buckets_for(docs.limit(0)) == cores


def test_result_is_the_same_for_any_number_of_buckets(docs):
    def result(n):
        return sorted(map(str, op9.substring_dedup(docs, buckets=n).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()))

    assert result(1) == result(7) == result(301)
    removed = {r.doc_id: r.n_removed for r in op9.substring_dedup(docs).collect()}
    assert removed == {0: 0, **{i: 120 for i in range(1, 40)}, 40: 0, 41: 0, None: 0}


def test_each_bucket_is_a_partition(docs):
    plan = op9.removed_windows(keyed(docs), buckets=301)._jdf.queryExecution().executedPlan().toString()
    assert ", 301)" in plan and plan.count("REPARTITION_BY_NUM") == 1 and "hashpartitioning(bucket" not in plan
