import tempfile

from markforge.plans import fixtures as fx
from markforge.streaming.postprocess import candidate_stream, postprocess_stream, write_stream

SF = "/root/testdata/sf0.001"


def test_stream_postprocess_equals_batch(spark):
    src = tempfile.mkdtemp(prefix="mf-stream-src-")
    out = tempfile.mkdtemp(prefix="mf-stream-out-") + "/o"
    cands = fx.candidates(spark, SF).withColumnRenamed("doc_id", "id")
    cands.repartition(3).write.mode("overwrite").parquet(src + "/in")
    q = write_stream(postprocess_stream(candidate_stream(spark, src + "/in", max_files_per_trigger=1)), out)
    q.awaitTermination(120)
    got = spark.read.parquet(out)
    assert got.count() == cands.count()
    valid = got.where("valid").count()
    n_docs = cands.select("id").distinct().count()
    expected = sum(1 for r in cands.select("id", "round").collect()
                   if (r.id + r.round) % 5 != 0 and r.id % 23 != 0)
    assert valid == expected and n_docs > 0


def test_restarted_stream_appends_only_new_files(spark):
    src, out = tempfile.mkdtemp(prefix="mf-stream-src-") + "/in", tempfile.mkdtemp(prefix="mf-stream-out-") + "/o"
    for i in (1, 2):
        spark.createDataFrame([(i, 1, "<svg/>")], "id long, round int, raw string").write.mode("append").parquet(src)
        write_stream(postprocess_stream(candidate_stream(spark, src)), out).awaitTermination(120)
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == [1, 2]
