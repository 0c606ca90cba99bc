"""The pipeline's stages on nulls, empty and long texts, repeats and clashing columns, and what they decide."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as C

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """A small corpus of real texts with odd rows, near copies that share long lines, and its other tables."""
    out = str(tmp_path_factory.mktemp("corpus"))
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text", "lang", "source", "n_chars").collect()]
    rnd = random.Random(8)
    word = lambda: "".join(rnd.choice("abdeghilmnorstu") for _ in range(rnd.randrange(3, 9)))
    lines = ["The " + " ".join(word() for _ in range(14)) + " and the end." for _ in range(12)]
    for k in range(4):  # near copies: eleven shared lines, one of their own
        rows.append((9000 + k, "\n".join([*lines[:11], f"own {word()} {word()} {word()}"]), "en", "x", 1))
    rows += [(9100, None, "en", "x", 0), (9101, "", "en", "x", 0), (9102, " \n", None, None, None), (None, lines[11], "en", "x", 5),
             (9200, " ".join(chr(rnd.randrange(0x4E00, 0x9000)) for _ in range(300)), None, "x", 1),
             (9300, "word here and there " * 5000, "en", "x", 1)]
    rows += [rows[3], rows[3], (rows[4][0], rows[4][1], rows[4][2], "other source", rows[4][4])]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    df = spark.createDataFrame(rows, schema).selectExpr("*", "'a' as row_key", "1 as kept", "2 as lang_pred", "3 as __id", "4 as score")
    df.repartition(3).write.parquet(f"{out}/documents.parquet")
    for name in ("benchmark", "labels"):
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(f"{out}/{name}.parquet")
    return out


def test_language_goes_by_a_learned_floor(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = C.language(spark, docs, folder)
    assert out.columns == docs.columns
    kept = {r.doc_id for r in out.select("doc_id").collect()}
    assert not kept & {9100, 9101, 9102, 9200}  # no letter, and a script nobody learned
    real = {r.doc_id for r in docs.filter("doc_id < 9000 and text rlike '[A-Za-z]'").select("doc_id").collect()}
    assert real <= kept and {9000, 9300, None} <= kept
    assert out.filter("doc_id = 9000").count() == 1


def test_near_takes_repeated_rows_once_and_judges_the_texts_as_given(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    cut = C.lines(spark, docs, folder)
    assert cut.filter("doc_id between 9001 and 9003").count() == 3  # short rests that look like nothing else
    out = C.near(spark, cut, folder)
    assert out.columns == docs.columns
    ids = [r.doc_id for r in out.select("doc_id").collect()]
    assert [i for i in ids if i is not None and 9000 <= i < 9004] == [9000]
    assert len(ids) == len(set(ids))
    # other columns of repeated rows: the first by their JSON
    same = C.once(docs).groupBy("doc_id", "text").count().filter("count > 1").count()
    assert same == 0 and C.once(docs).filter(F.col("source") == "other source").count() in (0, 1)


def test_all_stages(spark, folder):
    out = C.run(spark, folder)
    assert out.columns == [*spark.read.parquet(f"{folder}/documents.parquet").columns, "mix_rate", "mix_copies"]
    rows = out.select("doc_id", "mix_copies").collect()
    assert len(rows) > 40 and all(r.mix_copies > 0 for r in rows)


def test_empty_documents(spark, folder, tmp_path):
    spark.read.parquet(f"{folder}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    for name in ("benchmark", "labels"):
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    assert C.run(spark, str(tmp_path)).count() == 0
