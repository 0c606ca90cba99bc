"""Corpus pipeline: the stages, in order, over ``documents``.

Each stage takes and returns whole rows of documents (other columns ride along)
and is judged on its own input; the last one adds ``mix_rate`` and ``mix_copies``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from markforge.llm.common import attach, checked_broadcast, keys_of, release, staged, without
from markforge.llm.op1 import held_out, language_id
from markforge.llm.op2 import EVERY, NEAR, line_dedup
from markforge.llm.op3 import near_duplicates
from markforge.llm.op5 import benchmark_hits
from markforge.llm.op7 import mix_sources


# A text of at least FLOOR_CHARS characters is of no learned language if its score is below FLOOR_SHARE of the score that
# all but FLOOR_QUANTILE of the training rows of that length reach where the prediction is right.
FLOOR_CHARS, FLOOR_QUANTILE, FLOOR_SHARE = 50, 0.01, 0.5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter or without a learned language go, and those whose score lies below a floor learned from the
    training rows. Null texts have no letter and go; short texts are only held to the letter; equal rows are judged alike;
    rows with a null id are judged by their text like any other; without labelled rows everything is ``und`` and goes."""
    found = staged(language_id(docs, docs.filter(~held_out())).distinct(), "stage-language-scores")
    rows = attach(docs, checked_broadcast(found))
    long = F.length(docs["text"]) >= FLOOR_CHARS
    right = rows.filter(~held_out() & (docs["lang"] == F.col("__d_lang_pred")) & long)
    usual = right.agg(F.percentile_approx("__d_score", FLOOR_QUANTILE)).first()[0] or 0.0
    low = long & (F.col("__d_score") < FLOOR_SHARE * usual)
    return rows.filter((F.col("__d_lang_pred") != "und") & ~F.coalesce(low, F.lit(False))).select(*(docs[c] for c in docs.columns))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated and near-repeated lines go, all but the earliest; a document that loses all its words goes."""
    found = line_dedup(docs, EVERY, NEAR).filter("n_removed > 0").select("doc_id", "row_key", "kept_text").dropDuplicates(["doc_id", "row_key"])
    changed = attach(docs, staged(found, "stage-lines"))
    text = F.when(F.col("__d_row_key").isNull(), docs["text"]).otherwise(F.col("__d_kept_text"))
    left = changed.filter(F.col("__d_row_key").isNull() | F.col("__d_kept_text").rlike("[^\\x20\\x09-\\x0D]"))
    return left.select(*(text.alias(c) if c == "text" else docs[c] for c in docs.columns))


def once(docs: DataFrame) -> DataFrame:
    """Of rows of equal id and text one stays: the first by its other columns, written as JSON."""
    key, text = keys_of(docs)[1], docs["text"]
    twice = staged(docs.groupBy(docs["doc_id"].cast("long").alias("doc_id"), key.alias("row_key")).count()
                   .filter("count > 1").drop("count"), "stage-near-twice")
    if twice.isEmpty():
        return docs
    twice = checked_broadcast(twice)
    several = attach(docs, twice, "inner").select(*(docs[c] for c in docs.columns))
    order = F.to_json(F.struct(*(several[c] for c in several.columns)))
    first = several.groupBy(several["doc_id"], several["text"]).agg(F.min_by(F.struct(*(several[c] for c in several.columns)), order).alias("__row"))
    return attach(docs, twice, "left_anti").unionByName(first.select("__row.*"))


def of_ids(docs: DataFrame, ids: DataFrame, how: str) -> DataFrame:
    """``docs`` joined with a staged table of ids."""
    side = checked_broadcast(ids).select(F.col("doc_id").alias("__i_doc_id"))
    return docs.join(side, docs["doc_id"].cast("long") == side["__i_doc_id"], how)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated rows are taken once, and one document of each group of near duplicates stays, the one with the smallest id:
    first by the texts of ``documents``, as line dedup has taken shared lines out of the copies; then among what is left by
    the texts as they are here. By the former an id goes if all its rows go. Rows with a null id go only as repeated rows or by the
    latter; texts without words are linked with nothing and stay; long texts are compared whole; extra columns ride along."""
    docs = once(docs)
    ids = staged(docs.select(F.col("doc_id").cast("long").alias("doc_id")).filter("doc_id is not null").distinct(), "stage-near-ids")
    given = of_ids(spark.read.parquet(f"{sf_dir}/documents.parquet"), ids, "left_semi")
    gone = near_duplicates(given).groupBy("doc_id").agg(F.max("kept").alias("kept")).filter("not kept and doc_id is not null")
    left = staged(of_ids(docs, staged(gone.select("doc_id"), "stage-near-copies"), "left_anti"), "stage-near-left")
    return without(left, near_duplicates(left).filter(~F.col("kept")), "stage-near")


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go. Texts without words have no hit and stay; equal rows go or stay together."""
    hits = benchmark_hits(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return without(docs, hits.filter("contaminated"), "stage-benchmark")


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rates that mix the labelled domains to their targets; rows with no copy go. Texts without words have rate 1 and stay;
    columns named ``mix_rate`` or ``mix_copies`` are replaced."""
    mixed = mix_sources(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    mixed = staged(mixed.select("doc_id", "row_key", "rate", "copies").dropDuplicates(["doc_id", "row_key"]), "stage-mixing")
    rows = attach(docs, checked_broadcast(mixed), "inner").filter("__d_copies > 0")
    return rows.select(*(docs[c] for c in docs.columns if c not in ("mix_rate", "mix_copies")),
                       F.col("__d_rate").alias("mix_rate"), F.col("__d_copies").alias("mix_copies"))


STAGES = [("language_id", language), ("line_dedup", lines), ("near_dedup", near), ("decontamination", benchmark),
          ("mixing", mixing)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if before is not None:  # the next stage's rows are written
            release(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
