import hashlib
import csv
import os
import tempfile

import pandas as pd
import pytest

from markforge.config import CorpusConfig, SourceSpec
from markforge.operators.normalize import normalize_pairs
from markforge.operators.report import require_sources
from markforge.sources.readers import load_sources, read_csv_text, read_pairs_csv, read_source, read_test_prompts
from markforge.sources.sinks import write_csv, write_submission

ROWS = [
    ("a red circle", '<svg><circle r="1"/></svg>'),
    ('quote "inside", comma', '<svg>\n<path d="M0 0"/>\n</svg>'),
    ("  padded  ", "  <svg/>  "),
    ("NA", "<svg/>"),
    ("", "<svg/>"),
    ("null", "n/a"),
    ("multi\nline\nprompt", '<svg a="x,y"/>'),
]


def _write_pandas_csv(rows, cols):
    d = tempfile.mkdtemp(prefix="mf-csv-")
    path = os.path.join(d, "train.csv")
    pd.DataFrame(rows, columns=cols).to_csv(path, index=False, quoting=csv.QUOTE_MINIMAL)
    return path


def test_reads_pandas_written_csv_like_pandas(spark):
    path = _write_pandas_csv(ROWS, ["prompt", "svg"])
    got = [tuple(r) for r in read_pairs_csv(spark, path).collect()]
    exp = pd.read_csv(path)
    exp = [tuple(None if pd.isna(v) else v for v in r) for r in exp.itertuples(index=False)]
    assert sorted(got, key=repr) == sorted(exp, key=repr)


def test_written_csv_round_trips_through_pandas(spark):
    df = spark.createDataFrame([(i, p, s) for i, (p, s) in enumerate(ROWS)], "id long, prompt string, svg string")
    out = tempfile.mkdtemp(prefix="mf-out-") + "/sub"
    write_submission(df.withColumnRenamed("prompt", "x"), out, order_by="id", single_file=True)
    part = [f for f in os.listdir(out) if f.endswith(".csv")][0]
    back = pd.read_csv(os.path.join(out, part), keep_default_na=False)
    assert list(back.columns) == ["id", "svg"]
    assert list(back["svg"]) == [s for _, s in ROWS]
    assert list(back["id"]) == list(range(len(ROWS)))


def test_spark_write_then_read(spark):
    df = spark.createDataFrame([(str(i), p, s) for i, (p, s) in enumerate(ROWS)], "id string, prompt string, svg string")
    out = tempfile.mkdtemp(prefix="mf-rt-") + "/t"
    write_csv(df, out)
    got = {r.id: (r.prompt, r.svg) for r in read_csv_text(spark, out, ["id", "prompt", "svg"]).collect()}
    assert {r.id: r.prompt for r in read_test_prompts(spark, out).collect()} == {k: v[0] for k, v in got.items()}
    for i, (p, s) in enumerate(ROWS):
        exp_p = None if p in ("NA", "", "null") else p
        exp_s = None if s == "n/a" else s
        assert got[str(i)] == (exp_p, exp_s)


def test_load_sources_isolates_failures(spark):
    path = _write_pandas_csv(ROWS, ["prompt", "svg"])
    cfg = CorpusConfig(system_prompt="S")
    specs = [
        SourceSpec("missing", path="/nonexistent/x.parquet"),
        SourceSpec("local_csv", path=path, format="csv", split=None),
        SourceSpec("no_path"),
    ]

    def prep(df, spec):
        return normalize_pairs(df, spec.prompt_fields, spec.markup_fields)

    loaded, skipped, counts = load_sources(spark, specs, prep, verify="count")
    assert [n for n, _ in loaded] == ["local_csv"]
    assert {n for n, _ in skipped} == {"missing", "no_path"}
    # usable rows: blank prompt, NA prompt and the non-markup row are dropped
    assert counts["local_csv"] == 4
    with pytest.raises(RuntimeError):
        require_sources([])
    assert cfg.max_per_source == 50_000


def test_read_source_split_and_table(spark):
    d = tempfile.mkdtemp(prefix="mf-src-")
    df = spark.createDataFrame([("p", "<svg/>", "train"), ("q", "<svg/>", "test")], "prompt string, svg string, split string")
    df.write.partitionBy("split").parquet(d + "/t")
    got = read_source(spark, SourceSpec("s", path=d + "/t", split="train")).collect()
    assert [r.prompt for r in got] == ["p"]


def test_write_corpus_in_seeded_order(spark):
    import glob
    import os
    import tempfile

    import pyarrow.parquet as pq
    from pyspark.sql import functions as F

    from markforge.operators.sampling import salted_hash
    from markforge.sources.sinks import write_corpus

    d = spark.range(500).select(F.col("id"), F.when(F.col("id") % 4 == 0, "eval").otherwise("train").alias("split"))
    out = tempfile.mkdtemp(prefix="mf-order-") + "/c"
    write_corpus(d.withColumn("_o", salted_hash("shuffle:", ["id"])), out, order_col="_o", partitions=5)
    for split in ("train", "eval"):
        files = sorted(glob.glob(os.path.join(out, f"split={split}", "*.parquet")))
        assert len(files) > 1
        got = [i for f in files for i in pq.read_table(f).column("id").to_pylist()]
        ids = [i for i in range(500) if (i % 4 == 0) == (split == "eval")]
        assert got == sorted(ids, key=lambda i: hashlib.md5(f"shuffle:{i}".encode()).hexdigest())
    assert "_o" not in spark.read.parquet(out).columns


def test_read_source_with_position(spark):
    from pyspark.sql import functions as F

    d = tempfile.mkdtemp(prefix="mf-pos-")
    spark.range(30).select(F.col("id").alias("k")).repartition(3).write.parquet(d + "/p")
    spark.range(3).write.json(d + "/j")
    got = read_source(spark, SourceSpec("p", path=d + "/p", split=None), with_position=True)
    rows = got.select("k", "input_pos").collect()
    assert len({r.input_pos for r in rows}) == 30
    # position order = file order, then row order within a file
    ordered = [r.k for r in sorted(rows, key=lambda r: r.input_pos)]
    files = sorted(os.listdir(d + "/p"))
    import pyarrow.parquet as pq

    expected = [k for f in files if f.endswith(".parquet") for k in pq.read_table(os.path.join(d, "p", f)).column("k").to_pylist()]
    assert ordered == expected
    with pytest.raises(ValueError):
        read_source(spark, SourceSpec("j", path=d + "/j", format="json", split=None), with_position=True)


def test_write_corpus_keep_and_observe_keep_the_order(spark):
    import glob

    import pyarrow.parquet as pq
    from pyspark.sql import Observation
    from pyspark.sql import functions as F

    from markforge.operators.sampling import salted_hash
    from markforge.sources.sinks import write_corpus

    d = spark.range(500).select(F.col("id"), F.when(F.col("id") % 4 == 0, "eval").otherwise("train").alias("split"),
                                (F.col("id") % 5 != 0).alias("kept"))
    out = tempfile.mkdtemp(prefix="mf-order-") + "/c"
    obs = Observation("t")
    write_corpus(d.withColumn("_o", salted_hash("shuffle:", ["id"])), out, order_col="_o", partitions=5,
                 keep_col="kept", observation=(obs, [F.count(F.lit(1)).alias("n"), F.count_if("kept").alias("k")]))
    assert obs.get == {"n": 500, "k": 400}
    for split in ("train", "eval"):
        files = sorted(glob.glob(os.path.join(out, f"split={split}", "*.parquet")))
        got = [i for f in files for i in pq.read_table(f).column("id").to_pylist()]
        ids = [i for i in range(500) if (i % 4 == 0) == (split == "eval") and i % 5 != 0]
        assert got == sorted(ids, key=lambda i: hashlib.md5(f"shuffle:{i}".encode()).hexdigest())
    assert set(spark.read.parquet(out).columns) == {"id", "split"}


def test_spread_leaves_large_inputs_alone(spark):
    from markforge.session import spread

    df = spark.range(1000).repartition(10)
    assert spread(df, min_partitions=40).rdd.getNumPartitions() == 40
    assert spread(df, min_partitions=40, max_input_partitions=5).rdd.getNumPartitions() == 10
    spark.conf.set("markforge.spread.maxInputPartitions", "8")
    try:
        assert spread(df, min_partitions=40).rdd.getNumPartitions() == 10
    finally:
        spark.conf.unset("markforge.spread.maxInputPartitions")
    assert spread(df, min_partitions=5).rdd.getNumPartitions() == 10


def test_csv_fields_are_found_by_header_name(spark, tmp_path):
    from markforge.sources.readers import read_pairs_csv

    (tmp_path / "a.csv").write_text("id,prompt,svg\n7,a cat,<svg/>\n")
    assert [tuple(r) for r in read_pairs_csv(spark, str(tmp_path / "a.csv")).collect()] == [("a cat", "<svg/>")]
    (tmp_path / "b.csv").write_text("x,y\n1,2\n")
    try:
        read_pairs_csv(spark, str(tmp_path / "b.csv"))
    except ValueError:
        return
    raise AssertionError("a file without a usable field was read")


def test_split_that_cannot_be_applied_is_an_error(spark):
    d = tempfile.mkdtemp(prefix="mf-split-")
    spark.createDataFrame([("a", "<svg/>")], "prompt string, svg string").write.parquet(d + "/t")
    with pytest.raises(ValueError, match="split 'validation'"):
        read_source(spark, SourceSpec("s", path=d + "/t", split="validation"))
    assert read_source(spark, SourceSpec("s", path=d + "/t", split=None)).count() == 1
    assert read_source(spark, SourceSpec("s", path=d + "/{split}", split="t")).count() == 1


def test_csv_source_without_a_usable_field_is_skipped(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,note\n1,x\n")
    (tmp_path / "b.csv").write_text("svg,id,prompt\n<svg/>,1,x\n")
    specs = [SourceSpec(n, path=str(tmp_path / f"{n}.csv"), format="csv", split=None, prompt_fields=("caption", "prompt"),
                        markup_fields=("svg",), key_fields=("id",)) for n in "ab"]
    loaded, skipped, _ = load_sources(spark, specs, lambda df, spec: normalize_pairs(df, spec.prompt_fields, spec.markup_fields))
    assert [n for n, _ in skipped] == ["a"] and "none of the fields" in skipped[0][1]
    assert [tuple(r) for r in loaded[0][1].collect()] == [("x", "<svg/>")]
