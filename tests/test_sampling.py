import hashlib
import math

import pytest
from pyspark.sql import functions as F

from markforge.operators.sampling import (
    ORDER_KEY,
    capped_sample,
    capped_sample_by,
    file_row_id,
    exact_split,
    head_cap,
    rank_cut,
    salted_hash,
    seeded_shuffle,
    with_input_position,
    with_order_key,
)

SF = "/root/testdata/sf0.001"


def brute_order(ids, salt):
    return sorted(ids, key=lambda i: (hashlib.md5(f"{salt}{i}".encode()).hexdigest(), i))


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").select("doc_id")


@pytest.mark.parametrize("share", [0.5, 0.02, 0.37])
def test_exact_split_matches_brute_force(spark, docs, share):
    ids = [r[0] for r in docs.collect()]
    k = math.ceil(len(ids) * share)
    expected_eval = set(brute_order(ids, "split:")[:k])
    got = exact_split(docs, ["doc_id"], share, salt="split:")
    ev = {r[0] for r in got.where("split = 'eval'").collect()}
    tr = {r[0] for r in got.where("split = 'train'").collect()}
    assert ev == expected_eval
    assert ev.isdisjoint(tr) and ev | tr == set(ids)


def test_split_invariant_to_partitioning(spark, docs):
    a = exact_split(docs, ["doc_id"], 0.5, stage=False)
    b = exact_split(docs.repartition(7).orderBy(F.rand(1)), ["doc_id"], 0.5, stage=False)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_rank_cut_multi_round_narrowing(spark, docs):
    # one hex digit per round and a tiny final bucket force several rounds
    ids = [r[0] for r in docs.collect()]
    work = with_order_key(docs, salted_hash("x:", ["doc_id"]))
    for k in (1, 2, 17, 100, len(ids) - 1):
        cut = rank_cut(work, k, digits=1, max_final=3)
        got = {r[0] for r in work.where(cut.predicate).collect()}
        assert got == set(brute_order(ids, "x:")[:k])


def test_rank_cut_bounds(spark, docs):
    work = with_order_key(docs, salted_hash("x:", ["doc_id"]))
    n = docs.count()
    assert work.where(rank_cut(work, 0).predicate).count() == 0
    assert work.where(rank_cut(work, n + 5).predicate).count() == n


def test_duplicate_keys_need_row_ids(spark):
    # a third of all rows share one key: the cut still takes exactly k rows
    rows = [(i % 50 if i % 3 else 0,) for i in range(600)]
    df = spark.createDataFrame(rows, "key long")
    with pytest.raises(ValueError):
        exact_split(df, ["key"], 0.5, unique=True, stage=False)
    out = exact_split(df, ["key"], 0.5, unique=False)
    assert out.where("split = 'eval'").count() == 300
    assert out.count() == 600
    # narrowing must also get through a hot key with tiny buckets
    work = with_order_key(df, salted_hash("s:", ["key"]), unique=False)
    from markforge.session import materialize

    work = materialize(work, "t")
    cut = rank_cut(work, 250, digits=2, max_final=10)
    assert work.where(cut.predicate).count() == 250


def test_capped_sample(spark, docs):
    ids = [r[0] for r in docs.collect()]
    got = {r[0] for r in capped_sample(docs, 50, ["doc_id"], salt="cap:").collect()}
    assert got == set(brute_order(ids, "cap:")[:50])
    assert capped_sample(docs, len(ids) + 1, ["doc_id"]).count() == len(ids)


def test_head_cap_and_input_position(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    got = [r[0] for r in head_cap(d.select("doc_id"), 25, "doc_id").collect()]
    assert sorted(got) == sorted(r[0] for r in d.select("doc_id").orderBy("doc_id").limit(25).collect())
    pos = with_input_position(spark.read.parquet(f"{SF}/documents.parquet"))
    first = head_cap(pos, 10, "input_pos").select("doc_id").collect()
    assert len(first) == 10


def test_seeded_shuffle_is_a_permutation(spark, docs):
    ids = [r[0] for r in docs.collect()]
    got = dict(seeded_shuffle(docs, ["doc_id"], salt="sh:", partitions=5).select("doc_id", "shuffle_rank").collect())
    expected = {i: r + 1 for r, i in enumerate(brute_order(ids, "sh:"))}
    assert got == expected
    assert ORDER_KEY not in seeded_shuffle(docs, ["doc_id"], salt="sh:").columns


def test_seeded_shuffle_with_split_files(spark, docs):
    # several files per written task must still give a 1..n permutation
    spark.conf.set("spark.sql.files.maxRecordsPerFile", "37")
    try:
        ids = [r[0] for r in docs.collect()]
        got = dict(seeded_shuffle(docs, ["doc_id"], salt="sh:", partitions=3).select("doc_id", "shuffle_rank").collect())
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    assert got == {i: r + 1 for r, i in enumerate(brute_order(ids, "sh:"))}


def test_seeded_shuffle_query_ranks_all_rows_by_their_hash(spark):
    from markforge.plans.queries import QUERIES, SEED

    ids = [r[0] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect()]
    got = QUERIES["seeded_shuffle"](spark, SF).select("doc_id", "shuffle_rank").collect()
    assert dict(got) == {i: r + 1 for r, i in enumerate(brute_order(ids, f"shuffle:{SEED}:"))}
    assert sorted(r.shuffle_rank for r in QUERIES["keyed_permutation"](spark, SF).collect()) == list(range(1, len(ids) + 1))


@pytest.fixture(scope="module")
def hot_parquet(spark):
    """Parquet in several files where a third of all rows carry one content
    (a hot, repeating key) and the rest repeat in pairs."""
    import tempfile

    path = tempfile.mkdtemp(prefix="mf-hot-") + "/t"
    d = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    rows = d.select(F.when(F.col("doc_id") % 3 == 0, F.lit("hot")).otherwise((F.col("doc_id") % 60).cast("string"))
                    .alias("prompt"), F.lit("<svg/>").alias("svg"))
    rows.repartition(4).write.parquet(path)
    return path


def test_cap_with_file_row_ids_is_exact(spark, hot_parquet):
    from markforge.operators.sampling import content_key, file_row_id, long_order

    src = spark.read.parquet(hot_parquet)
    n = src.count()
    for k in (1, 7, n // 3, n // 2, n - 1):
        got = capped_sample(src, k, [content_key(["prompt", "svg"])], salt="cap:", unique=False,
                            tie_breaker=file_row_id(), stage=True)
        ids = got.select(F.col("_metadata.file_path").alias("f"), F.col("_metadata.row_index").alias("r"))
        ids = sorted(map(tuple, ids.collect()))
        # brute force: a plain global sort by the same total order
        order = F.concat(salted_hash("cap:", [content_key(["prompt", "svg"])]),
                         F.md5(F.col("_metadata.file_path")), long_order(F.col("_metadata.row_index")))
        want = src.select(F.col("_metadata.file_path").alias("f"), F.col("_metadata.row_index").alias("r"),
                          order.alias("o")).orderBy("o").limit(k).select("f", "r")
        assert ids == sorted(map(tuple, want.collect()))


def test_file_row_ids_ignore_split_size(spark, hot_parquet):
    from markforge.operators.sampling import content_key, file_row_id

    def kept():
        src = spark.read.parquet(hot_parquet)
        got = exact_split(src, [content_key(["prompt", "svg"])], 0.5, unique=False, tie_breaker=file_row_id())
        return sorted(map(tuple, got.select(F.col("_metadata.file_path"), F.col("_metadata.row_index"), "split")
                          .collect()))

    a = kept()
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1024")
    try:
        b = kept()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert a == b
    assert sum(1 for *_, s in a if s == "eval") == math.ceil(len(a) * 0.5)


def test_broadcast_bound_falls_back_to_shuffle_join(spark, docs):
    ids = [r[0] for r in docs.collect()]
    spark.conf.set("markforge.broadcast.maxRows", "0")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        res = seeded_shuffle(docs, ["doc_id"], salt="sh:", partitions=3)
        import contextlib
        import io

        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            res.explain()
        plan = buf.getvalue()
        got = dict(res.select("doc_id", "shuffle_rank").collect())
        pos = with_input_position(spark.read.parquet(f"{SF}/documents.parquet"))
        n_pos = pos.select("input_pos").distinct().count()
    finally:
        for k in ("markforge.broadcast.maxRows", "spark.sql.autoBroadcastJoinThreshold",
                  "spark.sql.adaptive.autoBroadcastJoinThreshold"):
            spark.conf.unset(k)
    assert "Broadcast" not in plan
    assert got == {i: r + 1 for r, i in enumerate(brute_order(ids, "sh:"))}
    assert n_pos == len(ids)


@pytest.mark.parametrize("digits,max_final", [(3, 100_000), (1, 4)])
def test_grouped_cap_equals_one_cap_per_group(spark, digits, max_final):
    df = spark.range(3000).selectExpr("id", "case when id % 3 = 0 then 'a' when id % 50 = 1 then 'b' when id % 7 = 2 then 'c' end as g")
    got = capped_sample_by(df, "g", ["a", "b", "c", "none"], 200, ["id"], digits=digits, max_final=max_final)
    expected = {(r.id, r.g) for g in "abc" for r in capped_sample(df.where(F.col("g") == g), 200, ["id"]).collect()}
    rows = [(r.id, r.g) for r in got.collect()]
    assert len(rows) == len(expected) and set(rows) == expected
    assert got.columns == ["id", "g"]


def test_grouped_cap_inside_a_repeated_key(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    languages = [r[0] for r in d.select("lang").distinct().collect() if r[0] is not None]
    sizes = dict(d.where("lang is not null").groupBy("lang").count().collect())
    got = capped_sample_by(d.select("doc_id", "lang"), "lang", languages, 3, ["lang"], tie_breaker=file_row_id())
    assert dict(got.groupBy("lang").count().collect()) == {g: min(3, c) for g, c in sizes.items()}
    with pytest.raises(ValueError):
        capped_sample_by(d.select("doc_id", "lang"), "lang", languages, 3, ["lang"])
