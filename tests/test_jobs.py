import csv
import math
import os
import tempfile

import pandas as pd
from pyspark.sql import functions as F

from markforge.config import CorpusConfig, SourceSpec, StructuralBudget
from markforge.plans import fixtures as fx
from markforge.plans.corpus import corpus_job, prepare_source, sft_corpus
from markforge.plans.inference import inference_job
from markforge.operators.normalize import normalize_pairs
from markforge.operators.sampling import file_row_id
from markforge.sources.readers import load_sources

SF = "/root/testdata/sf0.001"


def test_corpus_without_ids_splits_exactly(spark):
    pairs = normalize_pairs(fx.svg_pairs(spark, SF), ["caption", "name"], ["svg_code"])
    dup = pairs.unionByName(pairs)  # every pair twice: keys repeat
    cfg = CorpusConfig(system_prompt="S", budget=StructuralBudget(400), max_tokens=10**6)
    out = sft_corpus([("a", dup)], cfg)
    n = out.count()
    n_eval = out.where("split = 'eval'").count()
    assert n_eval == math.ceil(n * 0.5)
    assert out.where("kept").count() == n


def test_corpus_job_over_catalog(spark):
    d = tempfile.mkdtemp(prefix="mf-job-")
    src = fx.svg_pairs(spark, SF)
    src.select("caption", "svg_code").toPandas().rename(columns={"caption": "prompt", "svg_code": "svg"}).to_csv(
        os.path.join(d, "train.csv"), index=False, quoting=csv.QUOTE_MINIMAL)
    src.select("doc_id", "name", "svg_code").write.parquet(os.path.join(d, "wide"))
    specs = [
        SourceSpec("local_train_csv", path=os.path.join(d, "train.csv"), format="csv", split=None),
        SourceSpec("wide", path=os.path.join(d, "wide"), prompt_fields=("qwen_caption", "name"),
                   markup_fields=("svg_code",), key_fields=("doc_id",), split=None),
        SourceSpec("broken", path=os.path.join(d, "nope")),
    ]
    cfg = CorpusConfig(system_prompt="S", max_per_source=100, budget=StructuralBudget(400), max_tokens=1700)
    corpus, report = corpus_job(spark, specs, cfg, out_path=os.path.join(d, "out"))
    assert [n for n, _ in report["skipped"]] == ["broken"]
    per_source = {r.source_name: r.n_rows for r in report["per_source"].collect()}
    assert set(per_source) == {"local_train_csv", "wide"}
    entered = {r.split: r.n_entered for r in report["per_split"].collect()}
    total = sum(entered.values())
    assert entered["eval"] == math.ceil(total * 0.5)
    written = spark.read.parquet(os.path.join(d, "out"))
    assert written.count() == corpus.where("kept").count()
    assert {r.split for r in written.select("split").distinct().collect()} == {"train", "eval"}


def test_inference_job_writes_submission(spark):
    d = tempfile.mkdtemp(prefix="mf-inf-")
    test = fx.test_prompts(spark, SF).toPandas().sample(frac=1.0, random_state=3)
    test.to_csv(os.path.join(d, "test.csv"), index=False)

    def gen(pdf, spec):
        pdf = pdf.assign(id=pdf["id"].astype(int))
        return fx.stub_generator(pdf, spec)

    rep = inference_job(spark, os.path.join(d, "test.csv"), gen, "S", os.path.join(d, "sub"), single_file=True)
    part = [f for f in os.listdir(os.path.join(d, "sub")) if f.endswith(".csv")][0]
    sub = pd.read_csv(os.path.join(d, "sub", part))
    assert list(sub.columns) == ["id", "svg"]
    assert len(sub) == len(test) == rep["rows"]
    assert list(sub["id"]) == list(test["id"])  # test-file order
    assert rep["fallbacks"] == sum(1 for i in test["id"] if i % 23 == 0 or ((i + 1) % 5 == 0 and (i + 2) % 5 == 0))


def test_idless_parquet_cap_file_ids_equal_stored_ids(spark):
    # Rows tied on content are identical in every field normalisation reads,
    # so both tie-breakers must give the same multiset of pairs.
    from markforge.operators.sampling import file_row_id
    from markforge.plans.corpus import prepare_source

    d = tempfile.mkdtemp(prefix="mf-cap-")
    src = fx.svg_pairs(spark, SF)
    hot = src.where("doc_id % 3 = 0").select("caption", "svg_code").limit(1)
    copies = hot.selectExpr("caption", "svg_code", "explode(sequence(1, 100)) AS n").drop("n")
    src.select("caption", "svg_code").unionByName(copies).repartition(3).write.parquet(os.path.join(d, "p"))
    df = spark.read.parquet(os.path.join(d, "p"))
    cfg = CorpusConfig(system_prompt="S", max_per_source=120)
    a = prepare_source(df, ["caption"], ["svg_code"], cfg, tie_breaker=file_row_id())
    b = prepare_source(df, ["caption"], ["svg_code"], cfg)
    rows_a = sorted(map(tuple, a.collect()))
    assert rows_a == sorted(map(tuple, b.collect()))
    assert rows_a == sorted(map(tuple, a.collect()))  # recomputation gives the same rows


def test_corpus_job_head_cap_in_file_order(spark):
    # The earlier variant: first n rows of the file (before normalising), no
    # seeded cap, 2% eval share.
    d = tempfile.mkdtemp(prefix="mf-head-")
    src = fx.svg_pairs(spark, SF).select("caption", "svg_code").toPandas()
    src = src.rename(columns={"caption": "prompt", "svg_code": "svg"}).sample(frac=1.0, random_state=5)
    src.to_csv(os.path.join(d, "train.csv"), index=False)
    cfg = CorpusConfig(system_prompt="S", max_per_source=None, head_per_source=60, eval_share=0.02,
                       budget=StructuralBudget(max_len=None, max_counts=()), max_tokens=10**6)
    spec = SourceSpec("train_csv", path=os.path.join(d, "train.csv"), format="csv", split=None)
    corpus, _ = corpus_job(spark, [spec], cfg)
    got = sorted((r.prompt, r.svg) for r in corpus.collect())

    def norm(v):
        return "" if not isinstance(v, str) else v.strip()

    head = pd.read_csv(os.path.join(d, "train.csv")).head(60)
    exp = []
    for p, s in zip(head["prompt"], head["svg"]):
        p, s = norm(p), norm(s)
        if not s.lower().startswith("<svg"):
            p, s = "", ""
        if p and s:
            exp.append((p, s))
    assert got == sorted(exp)
    assert corpus.where("split = 'eval'").count() == math.ceil(len(exp) * 0.02)


def test_corpus_job_head_then_seeded_cap_on_parquet(spark):
    import hashlib

    d = tempfile.mkdtemp(prefix="mf-head-pq-")
    src = fx.svg_pairs(spark, SF).select("caption", "svg_code").toPandas()
    src = src.rename(columns={"caption": "prompt", "svg_code": "svg"}).sample(frac=1.0, random_state=7)
    src = pd.concat([src, src.head(10)])  # repeated contents tie in the seeded cap
    src.to_parquet(os.path.join(d, "train.parquet"), index=False)
    cfg = CorpusConfig(system_prompt="S", max_per_source=25, head_per_source=80, eval_share=0.5,
                       budget=StructuralBudget(max_len=None, max_counts=()), max_tokens=10**6)
    spec = SourceSpec("train_pq", path=os.path.join(d, "train.parquet"), split=None)
    corpus, _ = corpus_job(spark, [spec], cfg)
    got = sorted((r.prompt, r.svg) for r in corpus.collect())

    def text(v):
        return "" if v is None or (isinstance(v, float) and math.isnan(v)) else str(v)

    head = list(src.head(80).itertuples(index=False))
    content = [hashlib.md5(f"{text(r.prompt)}\x1f{text(r.svg)}".encode()).hexdigest() for r in head]
    order = sorted(range(len(head)), key=lambda i: (hashlib.md5(f"cap:{cfg.seed}:{content[i]}".encode()).hexdigest(), i))
    exp = []
    for i in order[:25]:
        p, s = text(head[i].prompt).strip(), text(head[i].svg).strip()
        if s.lower().startswith("<svg") and p:
            exp.append((p, s))
    assert got == sorted(exp)


def test_corpus_job_observed_reports_equal_lazy_ones(spark):
    from markforge.operators.report import rows_per_group, split_counts

    d = tempfile.mkdtemp(prefix="mf-obs-")
    src = fx.svg_pairs(spark, SF)
    src.select(F.col("caption").alias("prompt"), F.col("svg_code").alias("svg")).write.parquet(os.path.join(d, "a"))
    src.select("doc_id", "name", "svg_code").write.parquet(os.path.join(d, "b"))
    specs = [SourceSpec("a", path=os.path.join(d, "a"), split=None),
             SourceSpec("b", path=os.path.join(d, "b"), prompt_fields=("name",), markup_fields=("svg_code",),
                        key_fields=("doc_id",), split=None)]
    cfg = CorpusConfig(system_prompt="S", max_per_source=150, budget=StructuralBudget(400), max_tokens=1700)
    corpus, report = corpus_job(spark, specs, cfg, out_path=os.path.join(d, "out"))
    observed_src = sorted(map(tuple, report["per_source"].collect()))
    observed_split = sorted(map(tuple, report["per_split"].collect()))
    assert observed_src == sorted(map(tuple, rows_per_group(corpus, "source_name").collect()))
    assert observed_split == sorted(map(tuple, split_counts(corpus).collect()))
    kept = sum(k for _, _, k in observed_split)
    assert 0 < kept <= sum(e for _, e, _ in observed_split)
    assert spark.read.parquet(os.path.join(d, "out")).count() == kept


def test_corpus_job_usable_counts_without_extra_passes(spark):
    # observed during each source's staging write
    d = tempfile.mkdtemp(prefix="mf-usable-")
    src = fx.svg_pairs(spark, SF)
    src.select(F.col("caption").alias("prompt"), F.col("svg_code").alias("svg")).write.parquet(os.path.join(d, "a"))
    src.select("doc_id", "name", "svg_code").write.parquet(os.path.join(d, "b"))
    specs = [SourceSpec("a", path=os.path.join(d, "a"), split=None),
             SourceSpec("b", path=os.path.join(d, "b"), prompt_fields=("name",), markup_fields=("svg_code",),
                        key_fields=("doc_id",), split=None)]
    cfg = CorpusConfig(system_prompt="S", max_per_source=150, budget=StructuralBudget(400))
    _, observed = corpus_job(spark, specs, cfg)
    _, _, counted = load_sources(spark, specs, lambda df, spec: prepare_source(
        df, spec.prompt_fields, spec.markup_fields, cfg, list(spec.key_fields), tie_breaker=file_row_id()), verify="count")
    assert observed["usable_per_source"] == counted
    assert all(v > 0 for v in observed["usable_per_source"].values())


def test_seeded_order_splits_a_hot_pair_over_tasks(spark):
    d = tempfile.mkdtemp(prefix="mf-hot-")
    same = F.col("id") % 3 == 0
    spark.range(24_000).repartition(6).select(F.when(same, F.lit("hot")).otherwise(F.concat(F.lit("p"), F.col("id").cast("string"))).alias("prompt"),
                                              F.lit("<svg></svg>").alias("svg")).write.parquet(os.path.join(d, "in"))
    conf = {"spark.sql.shuffle.partitions": "8", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        corpus_job(spark, [SourceSpec("a", path=os.path.join(d, "in"), split=None)],
                   CorpusConfig(system_prompt="S", max_per_source=None), out_path=os.path.join(d, "out"))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    task = F.regexp_extract(F.col("_metadata.file_name"), r"part-(\d+)", 1)
    sizes = [r["count"] for r in spark.read.parquet(os.path.join(d, "out")).groupBy(task.alias("task")).count().collect()]
    assert sum(sizes) == 24_000 and max(sizes) <= 2 * sum(sizes) / 8


def test_corpus_job_skips_a_source_with_corrupt_content(spark, tmp_path):
    rows = pd.DataFrame({"prompt": [f"p{i}" for i in range(500)], "svg": [f"<svg>{i}</svg>" for i in range(500)]})
    for name in ("good", "corrupt"):
        (tmp_path / name).mkdir()
        rows.to_parquet(tmp_path / name / "a.parquet", compression="snappy", use_dictionary=False)
    f = tmp_path / "corrupt" / "a.parquet"  # the footer stays, the pages go
    data = bytearray(f.read_bytes())
    data[4:2000] = b"\xff" * 1996
    f.write_bytes(data)
    specs = [SourceSpec(n, path=str(tmp_path / n), split=None) for n in ("corrupt", "good")]
    corpus, report = corpus_job(spark, specs, CorpusConfig(system_prompt="S"), out_path=str(tmp_path / "out"))
    assert [n for n, _ in report["skipped"]] == ["corrupt"]
    assert report["usable_per_source"] == {"good": 500}
    assert spark.read.parquet(str(tmp_path / "out")).count() == 500 == corpus.where("kept").count()
