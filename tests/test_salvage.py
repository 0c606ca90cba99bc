import glob
import json
import os

import pytest

from markforge.config import CorpusConfig, SourceSpec
from markforge.plans import queries as q
from markforge.plans.corpus import corpus_job
from markforge.sources.salvage import salvage

SCHEMA = "prompt string, svg string"


def parquet_files(spark, folder, n=5):
    rows = [(f"p{i} " * 50, f"<svg>{i}</svg>") for i in range(200)]
    spark.createDataFrame(rows, SCHEMA).repartition(n).write.parquet(str(folder))
    return sorted(glob.glob(f"{folder}/*.parquet")), rows


def rows_of(spark, file):
    return {tuple(r) for r in spark.read.parquet(file).collect()}


def without_checksum(file):
    crc = os.path.join(os.path.dirname(file), f".{os.path.basename(file)}.crc")
    if os.path.exists(crc):
        os.remove(crc)


def test_bad_files_go_whole_and_are_listed(spark, tmp_path):
    files, rows = parquet_files(spark, tmp_path / "p")
    lost = rows_of(spark, files[0]) | rows_of(spark, files[2])
    with open(files[0], "r+b") as f:  # the footer goes
        f.truncate(os.path.getsize(files[0]) - 20)
    size = os.path.getsize(files[2])
    with open(files[2], "r+b") as f:  # the footer stays, the pages do not
        f.seek(8)
        f.write(b"\xff" * (size // 2))
    for file in (files[0], files[2]):
        without_checksum(file)
    got = salvage(spark, SourceSpec("s", path=str(tmp_path / "p"), split=None))
    assert sorted(tuple(r) for r in got.rows.collect()) == sorted(set(rows) - lost)
    ledger = {os.path.basename(r.file): (r.n_rows, r.n_read < (r.n_rows or 1), r.reason) for r in got.files.collect()}
    assert ledger == {os.path.basename(files[0]): (None, True, "no row could be read"),
                      os.path.basename(files[2]): (40, True, "breaks off")}
    assert got.records.count() == 0


def test_whole_sources_lose_nothing(spark, tmp_path):
    _, rows = parquet_files(spark, tmp_path / "p")
    got = salvage(spark, SourceSpec("s", path=str(tmp_path / "p"), split=None), ["svg"])
    assert sorted(r.svg for r in got.rows.collect()) == sorted(s for _, s in rows) and got.rows.columns == ["svg"]
    assert got.files.count() == 0


def test_split_is_applied_after_salvage(spark, tmp_path):
    spark.createDataFrame([("a", "<svg/>", "train"), ("b", "<svg/>", "test")], "prompt string, svg string, split string") \
        .write.partitionBy("split").parquet(str(tmp_path / "t"))
    got = salvage(spark, SourceSpec("s", path=str(tmp_path / "t")), ["prompt", "svg"])
    assert [tuple(r) for r in got.rows.collect()] == [("a", "<svg/>")]


def test_malformed_records_are_listed(spark, tmp_path):
    lines = [json.dumps({"prompt": "a\nb", "svg": "<svg/>"}), '{"prompt": "cut', "{}", "no json", json.dumps({"prompt": "c", "svg": "<svg/>"})]
    (tmp_path / "x.json").write_text("\n".join(lines))
    for options in ({}, {"schema": SCHEMA}):
        got = salvage(spark, SourceSpec("s", path=str(tmp_path / "x.json"), format="json", split=None, options=options))
        assert sorted((tuple(r) for r in got.rows.collect()), key=repr) == [("a\nb", "<svg/>"), ("c", "<svg/>"), (None, None)]
        assert sorted(r.record for r in got.records.collect()) == sorted([lines[1], lines[3]])
        assert got.records.first().file.endswith("x.json")


def test_other_formats_are_refused(spark):
    with pytest.raises(ValueError, match="can be salvaged"):
        salvage(spark, SourceSpec("s", path="x.csv", format="csv"))


def test_corpus_job_reports_what_it_salvaged(spark, tmp_path):
    files, rows = parquet_files(spark, tmp_path / "p")
    kept = len(rows) - len(rows_of(spark, files[1]))
    with open(files[1], "wb") as f:
        f.write(b"nothing")
    without_checksum(files[1])
    specs = [SourceSpec("s", path=str(tmp_path / "p"), split=None), SourceSpec("absent", path=str(tmp_path / "none"), split=None)]
    corpus, report = corpus_job(spark, specs, CorpusConfig(system_prompt="S"), salvaged=True)
    assert corpus.count() == kept == report["usable_per_source"]["s"]
    assert [name for name, _ in report["skipped"]] == ["absent"]
    assert [os.path.basename(r.file) for r in report["bad_files"].collect()] == [os.path.basename(files[1])]
    # without it the source goes as a whole
    with pytest.raises(RuntimeError):
        corpus_job(spark, specs, CorpusConfig(system_prompt="S"))


def test_token_ids_of_whole_texts(spark):
    from tokenizers import Tokenizer

    import public_tokenizers

    sf = "/root/testdata/sf0.001"
    other = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    other.encode_special_tokens = True
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = q.q_token_ids(spark, sf).collect()
    assert len(got) == len(texts) and any(r.truncated for r in got)
    for r in got:
        ids = other.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert (r.n_tokens, r.n_kept, r.truncated, r.ids) == (len(ids), min(len(ids), 2048), len(ids) > 2048, ids[:2048])
