"""Scale check of corpus preparation on amplified, id-less pairs.

Builds (prompt, svg) pairs from ``documents`` x ``copies`` (whole texts as
prompts, markup by id arithmetic as in the fixtures), makes one identical
pair hold a third of all rows, writes them as id-less Parquet, and runs the
corpus job with a seeded cap: cap -> normalise -> budget -> staged pairs ->
exact split -> chat text -> token count -> sink in seeded order. Checks the
counts exactly and prints the timings.

    python tools/stress_corpus.py [sf_dir] [copies]
"""

from __future__ import annotations

import math
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from markforge.config import CorpusConfig, SourceSpec, StructuralBudget  # noqa: E402
from markforge.operators.sampling import capped_sample, content_key, file_row_id, salted_hash  # noqa: E402
from markforge.plans import fixtures as fx  # noqa: E402
from markforge.plans.corpus import corpus_job  # noqa: E402
from markforge.session import local_session  # noqa: E402

HOT_PROMPT = "the same request, repeated"
HOT_SVG = '<svg xmlns="http://www.w3.org/2000/svg"><circle r="3"/></svg>'


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    copies = int(sys.argv[2]) if len(sys.argv) > 2 else 20
    scratch = tempfile.mkdtemp(prefix="run-")
    spark = local_session(8, shuffle_partitions=16, checkpoint_dir=os.path.join(scratch, "ckpt"))
    d = spark.read.parquet(f"{sf}/documents.parquet")
    big = d.select(F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("c"), "doc_id", "text", "lang", "source")
    big = big.withColumn("doc_id", F.col("c").cast("long") * F.lit(10**9) + F.col("doc_id")).drop("c")
    pairs = fx.svg_pairs_from(big)
    hot = F.pmod(F.col("doc_id"), F.lit(3)) == 0
    src = pairs.select(F.when(hot, F.lit(HOT_PROMPT)).otherwise(F.col("caption")).alias("prompt"),
                       F.when(hot, F.lit(HOT_SVG)).otherwise(F.col("svg_code")).alias("svg"))
    path = os.path.join(scratch, "pairs")
    t0 = time.time()
    src.repartition(32).write.parquet(path)
    out = {"write_input_sec": round(time.time() - t0, 2)}
    df = spark.read.parquet(path)
    n = df.count()
    # Put the cap's boundary inside the hot group: all its rows share one
    # salted hash, so only the row identity decides which of them are kept.
    order = salted_hash("cap:42:", [content_key(["prompt", "svg"])])
    hot_hash = df.where(F.col("prompt") == HOT_PROMPT).select(order).first()[0]
    n_hot = df.where(F.col("prompt") == HOT_PROMPT).count()
    below = df.where(order < F.lit(hot_hash)).count()
    cap = below + n_hot // 2
    out.update(rows=n, hot_rows=n_hot, cap=cap)

    # the cap alone: exactly ``cap`` rows although a third of them tie
    t0 = time.time()
    capped = capped_sample(df, cap, [content_key(["prompt", "svg"])], salt="cap:42:", unique=False,
                           tie_breaker=file_row_id(), stage=True)
    got = capped.count()
    out["cap_sec"] = round(time.time() - t0, 2)
    assert got == cap, (got, cap)
    assert capped.where(F.col("prompt") == HOT_PROMPT).count() == cap - below

    cfg = CorpusConfig(system_prompt="You draw SVG.", max_per_source=cap,
                       budget=StructuralBudget(max_len=400, max_counts=(("<path", 10), ("<circle", 8), ("<rect", 8))),
                       max_tokens=1700)
    t0 = time.time()
    corpus, report = corpus_job(spark, [SourceSpec("amplified", path=path, split=None)], cfg,
                                out_path=os.path.join(scratch, "corpus"))
    per_split = {r.split: (r.n_entered, r.n_kept) for r in report["per_split"].collect()}
    out["corpus_job_sec"] = round(time.time() - t0, 2)
    entered = sum(e for e, _ in per_split.values())
    kept = sum(k for _, k in per_split.values())
    assert per_split["eval"][0] == math.ceil(entered * cfg.eval_share), per_split
    written = spark.read.parquet(os.path.join(scratch, "corpus")).count()
    assert written == kept, (written, kept)
    hot_rows = corpus.where(F.col("prompt") == HOT_PROMPT).count()
    assert hot_rows == cap - below, (hot_rows, cap - below)  # every kept hot row passes the budgets
    out.update(entered=entered, kept=kept, hot_rows_entered=hot_rows, per_split=per_split)
    print(out)
    spark.stop()


if __name__ == "__main__":
    main()
