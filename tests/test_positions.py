"""Positions, heads of files, the keyed permutation and the run ledger."""

import contextlib
import io
import os
import tempfile

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from markforge.config import SourceSpec
from markforge.operators import positions
from markforge.operators.cascade import cascade, generation_inputs
from markforge.operators.positions import Permutation, head_of_files, seeded_permutation, with_file_position
from markforge.operators.runs import Run, RunPaused
from markforge.plans import fixtures as fx
from markforge.sources.readers import read_source

SF = "/root/testdata/sf0.001"


def plan_of(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


@pytest.fixture(scope="module")
def files(spark):
    """12 files whose path order is not the order of their ids, one of them empty, with a blank in the folder's name."""
    folder = tempfile.mkdtemp(prefix="mf-pos-") + "/a b"
    rows = []
    for i in range(12):
        ids = [] if i == 5 else [1000 - 40 * i - k for k in range(7 + i)]
        rows += ids
        part = spark.createDataFrame([(x, f"t{x}") for x in ids], "id long, t string").coalesce(1)
        part.write.parquet(f"{folder}/f{i:02d}.parquet")
    return f"{folder}/*", rows


def test_positions_are_dense_and_ignore_split_sizes(spark, files):
    path, rows = files
    want = {x: i for i, x in enumerate(rows)}
    for conf in ({}, {"spark.sql.files.maxPartitionBytes": "300"}, {"markforge.offsets.maxRows": "0"}):
        for k, v in conf.items():
            spark.conf.set(k, v)
        try:
            assert dict(with_file_position(spark.read.parquet(path)).select("id", "input_pos").collect()) == want
        finally:
            for k in conf:
                spark.conf.unset(k)


def test_positions_beyond_the_broadcast_bound(spark, files, monkeypatch):
    path, rows = files
    monkeypatch.setattr(positions, "CHUNK_BITS", 2)  # several chunks a file
    names = ("markforge.offsets.maxRows", "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for k, v in zip(names, ("0", "-1", "-1")):
        spark.conf.set(k, v)
    try:
        df = with_file_position(spark.read.parquet(path))
        assert "Broadcast" not in plan_of(df)
        assert dict(df.select("id", "input_pos").collect()) == {x: i for i, x in enumerate(rows)}
    finally:
        for k in names:
            spark.conf.unset(k)


@pytest.mark.parametrize("n", [1, 6, 7, 8, 15, 30, 60, 10**6])
def test_head_reads_files_up_to_the_boundary(spark, files, n):
    path, rows = files
    scan = spark.read.parquet(path)
    opened = []

    def read(paths):
        opened.extend(p for p in paths if p not in opened)
        return spark.read.schema(scan.schema).parquet(*paths)

    got = head_of_files(scan, n, read)
    assert [r.id for r in got.orderBy("input_pos").collect()] == rows[:n]
    held, upto = 0, 0
    for i in range(12):
        held, upto = held + (0 if i == 5 else 7 + i), i + 1
        if held >= n:
            break
    assert len(opened) <= upto + 1
    if n < 100:
        assert "paths)" in plan_of(got) and "Exchange" not in plan_of(got) and "Join" not in plan_of(got)


def test_head_of_csv_files_with_two_headers(spark):
    folder = tempfile.mkdtemp(prefix="mf-csv-")
    with open(f"{folder}/a.csv", "w") as f:
        f.write('prompt,svg\n"p1\nx",<svg/>\np2,<svg/>\n')
    with open(f"{folder}/b.csv", "w") as f:
        f.write("extra,svg,prompt\n1,<svg>b</svg>,p3\n2,<svg/>,p4\n")
    with open(f"{folder}/c.csv", "w") as f:
        f.write("nothing,useful\n1,2\n")  # never opened for two or three rows
    spec = SourceSpec("csv", path=f"{folder}/[ab].csv", format="csv", split=None, prompt_fields=("prompt",), markup_fields=("svg",))
    for n, want in ((1, ["p1\nx"]), (2, ["p1\nx", "p2"]), (3, ["p1\nx", "p2", "p3"]), (9, ["p1\nx", "p2", "p3", "p4"])):
        got = read_source(spark, spec, head=n)
        assert [r.prompt for r in got.orderBy("input_pos").collect()] == want
    with pytest.raises(ValueError):
        read_source(spark, SourceSpec("t", table="t", split=None, path=None), head=3) if spark.catalog.tableExists("t") else \
            read_source(spark, SourceSpec("j", path=folder, format="json", split=None), head=3)


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 4000), st.integers(0, 2**40))
def test_permutation_is_a_bijection(n, seed):
    assert sorted(Permutation(n, seed).values(np.arange(n)).tolist()) == list(range(n))


def test_permutation_of_large_sizes():
    for n in (10**12, 10**12 + 7, 2**40 + 1):
        p = Permutation(n, 5)
        x = np.unique(np.random.default_rng(1).integers(0, n, 20000))
        y = p.values(x)
        assert len(np.unique(y)) == len(x) and y.min() >= 0 and y.max() < n
        assert abs(np.corrcoef(x, y)[0, 1]) < 0.05 and p.walk <= 4


@pytest.mark.parametrize("n", [1, 2, 3, 10, 97, 1000])
def test_permutation_column_equals_its_values(spark, n):
    p = Permutation(n, "seed")
    got = [r[0] for r in spark.range(n).orderBy("id").select(p.column("id")).collect()]
    assert got == p.values(np.arange(n)).tolist()


def test_seeded_permutation(spark, files):
    path, rows = files
    got = seeded_permutation(spark.read.parquet(path), 42)
    assert "RangePartitioning" not in plan_of(got) and "Sort" not in plan_of(got) and "rangepartitioning" not in plan_of(got)
    ranks = dict(got.select("id", "shuffle_rank").collect())
    assert sorted(ranks.values()) == list(range(1, len(rows) + 1))
    assert ranks != dict(seeded_permutation(spark.read.parquet(path), 43).select("id", "shuffle_rank").collect())
    # another kind of frame, an empty one, and the order on disk
    staged = seeded_permutation(spark.range(50).withColumn("t", F.lit("x")), 1)
    assert sorted(r.shuffle_rank for r in staged.collect()) == list(range(1, 51))
    assert seeded_permutation(spark.range(0), 1).count() == 0
    out = tempfile.mkdtemp(prefix="mf-perm-") + "/t"
    seeded_permutation(spark.read.parquet(path), 42, write_to=out, partitions=3)
    import pyarrow.parquet as pq

    on_disk = [x for f in sorted(os.listdir(out)) if f.endswith(".parquet") for x in pq.read_table(f"{out}/{f}")["id"].to_pylist()]
    assert on_disk == sorted(rows, key=ranks.get)


# ---- runs ---------------------------------------------------------------------


@pytest.fixture
def prompts(spark):
    return generation_inputs(fx.test_prompts(spark, SF), "S")


def result_of(df):
    return sorted((r.id, r.svg, r.used_fallback, r.won_round) for r in df.collect())


def test_a_stopped_run_goes_on(spark, prompts):
    root = tempfile.mkdtemp(prefix="mf-runs-")
    plain = result_of(cascade(prompts, fx.stub_generator))

    def fails_in_round_two(pdf, spec):
        if (pdf["round"] == 2).any():
            raise RuntimeError("lost")
        return fx.stub_generator(pdf, spec)

    first = Run(spark, "r", root)
    with pytest.raises(Exception, match="lost"):
        cascade(prompts, fails_in_round_two, run=first, slices=2)
    assert first.made == ["inputs", "round1-slice0", "round1-slice1"]
    again = Run(spark, "r", root)
    got = result_of(cascade(prompts, fx.later_rounds_generator, run=again, slices=2, rows_per_task=20))
    assert got == plain
    assert again.reused == first.made and again.made == ["round2-slice0", "round2-slice1"]
    rows = {e["piece"]: e["rows"] for e in again.committed()}
    assert rows["round1-slice0"] + rows["round1-slice1"] == rows["inputs"] == prompts.count()
    # everything is committed: a third call generates nothing
    assert result_of(cascade(prompts, None, run=Run(spark, "r", root), slices=2)) == plain
    again.finish()
    assert os.listdir(root) == []


def test_slots_of_pieces(spark, prompts):
    root = tempfile.mkdtemp(prefix="mf-runs-")
    made = []
    for _ in range(10):
        run = Run(spark, "slots", root, max_pieces=1)
        try:
            got = result_of(cascade(prompts, fx.stub_generator, run=run, slices=3))
            break
        except RunPaused:
            made += [p for p in run.made if p != "inputs"]
    assert got == result_of(cascade(prompts, fx.stub_generator)) and len(made) == 5


def test_a_run_is_not_resumed_with_other_inputs_or_rounds(spark, prompts):
    root = tempfile.mkdtemp(prefix="mf-runs-")
    with pytest.raises(RunPaused):
        cascade(prompts, fx.stub_generator, run=Run(spark, "x", root, max_pieces=1))
    with pytest.raises(ValueError, match="inputs"):
        cascade(prompts.where("id <> 3"), fx.stub_generator, run=Run(spark, "x", root))
    with pytest.raises(ValueError, match="slices"):
        cascade(prompts, fx.stub_generator, run=Run(spark, "x", root), slices=2)
    # a table without a ledger entry (a job killed while writing) is not read
    os.remove(f"{root}/x/ledger/round1-slice0.json")
    run = Run(spark, "x", root)
    cascade(prompts, fx.stub_generator, run=run)
    assert "round1-slice0" in run.made
