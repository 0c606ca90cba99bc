import pandas as pd
import pytest
from pyspark.sql import functions as F

from markforge.config import FALLBACK_SVG, ONE_ROUND, RoundSpec
from markforge.functions.markup import valid_markup_py
from markforge.operators.cascade import cascade, first_valid_round, generate_round, generation_inputs
from markforge.operators.report import fallback_report, output_quality
from markforge.plans import fixtures as fx
from markforge.plans.inference import run_inference

SF01 = "/root/testdata/sf0.01"


def test_first_valid_round_counts(spark):
    ids = fx.read_table(spark, SF01, "documents").select("doc_id")
    res = first_valid_round(ids, fx.candidates(spark, SF01), id_col="doc_id")
    rows = res.collect()
    assert len(rows) == 1000 and len({r.id for r in rows}) == 1000
    assert sum(r.used_fallback for r in rows) == 44
    assert sum(r.won_round == 2 for r in rows) == 191
    for r in rows:
        assert valid_markup_py(r.svg)
        assert (r.svg == FALLBACK_SVG) == r.used_fallback
    rep = fallback_report(res).first()
    assert (rep.n_rows, rep.n_fallback) == (1000, 44)


def test_cascade_retries_only_failures(spark):
    acc = spark.sparkContext.accumulator(0)
    seen = spark.sparkContext.accumulator(0)

    def gen(pdf, spec):
        acc.add(len(pdf))
        if spec.temperature > 0.7:
            seen.add(len(pdf))
        return fx.stub_generator(pdf, spec)

    test = fx.test_prompts(spark, SF01)
    res = run_inference(test, gen, "You draw SVG.")
    rows = res.collect()
    assert len(rows) == 1000 and len({r.id for r in rows}) == 1000
    # round 1 saw every id, round 2 only the 235 failures of round 1
    assert seen.value == 191 + 44
    assert acc.value == 1000 + 235
    assert sum(r.used_fallback for r in rows) == 44
    assert {r.won_round for r in rows} == {1, 2, None}


def test_missing_prompt_renders_nan(spark):
    df = spark.createDataFrame([(1, None), (2, "a cat")], "id long, prompt string")
    got = {r.id: r.prompt for r in generation_inputs(df, "S").collect()}
    assert got == {1: "nan", 2: "a cat"}
    got = {r.id: r.prompt for r in generation_inputs(df, "S", compat_nan=False).collect()}
    assert got[1] == ""


def test_one_round_variant_and_budget(spark):
    def gen(pdf, spec):
        assert spec == ONE_ROUND[0]
        assert (pdf["max_new_tokens"] >= 128).all()
        return ["<svg><g/></svg>" if i % 2 else "nothing" for i in pdf["id"]]

    df = spark.range(10).select(F.col("id"), F.lit("p").alias("prompt"))
    res = cascade(generation_inputs(df, "S"), gen, ONE_ROUND)
    rows = {r.id: r for r in res.collect()}
    assert len(rows) == 10
    assert all(rows[i].used_fallback == (i % 2 == 0) for i in range(10))


def test_output_quality(spark):
    df = spark.createDataFrame([(1, FALLBACK_SVG), (2, "<svg><g>")], "id long, svg string")
    q = {r.id: r for r in output_quality(df).collect()}
    assert q[1].valid and q[1].ends_with_close and q[1].n_chars == len(FALLBACK_SVG)
    assert not q[2].valid and not q[2].ends_with_close
    assert q[1].tail == FALLBACK_SVG[-200:] and q[1].head == FALLBACK_SVG[:500]


def test_generator_sees_round_knobs(spark):
    seen = spark.sparkContext.accumulator(0.0)

    def gen(pdf, spec):
        seen.add(spec.temperature * len(pdf))
        return pd.Series(["x"] * len(pdf))

    rounds = (RoundSpec(0.5, 0.9, 1.0, 100), RoundSpec(1.0, 0.9, 1.0, 100))
    df = spark.range(4).select(F.col("id"), F.lit("p").alias("prompt"))
    res = cascade(generation_inputs(df, "S"), gen, rounds)
    assert res.where("used_fallback").count() == 4
    assert abs(seen.value - (0.5 * 4 + 1.0 * 4)) < 1e-9


def test_completion_only_ignores_markup_in_prompt(spark):
    # The decoded text echoes the prompt (markers skipped). By default the
    # lazy pattern can start at a tag inside the prompt, as in the
    # reference; completion_only extracts from the completion alone.
    from markforge.config import ONE_ROUND

    prompts = [(1, "draw <svg> text"), (2, "<svg><g/></svg> like this"), (3, "plain")]
    completions = {1: "<svg><path/></svg>", 2: "sorry, no markup", 3: "<svg><rect/></svg>"}

    def gen(pdf, spec):
        return [f"system\nS\nuser\n{p}\nassistant\n{completions[int(i)]}" for i, p in zip(pdf["id"], pdf["prompt"])]

    df = spark.createDataFrame(prompts, "id long, prompt string")
    whole = {r.id: r for r in cascade(generation_inputs(df, "S"), gen, ONE_ROUND).collect()}
    only = {r.id: r for r in cascade(generation_inputs(df, "S"), gen, ONE_ROUND, completion_only=True).collect()}
    # id 1: the block starts at the prompt's <svg> and swallows the echo -> invalid
    assert whole[1].used_fallback and whole[1].svg == FALLBACK_SVG
    assert only[1].svg == "<svg><path/></svg>" and not only[1].used_fallback
    # id 2: the prompt's own markup is taken by default, nothing with completion_only
    assert whole[2].svg == "<svg><g/></svg>" and not whole[2].used_fallback
    assert only[2].used_fallback and only[2].svg == FALLBACK_SVG
    assert whole[3].svg == only[3].svg == "<svg><rect/></svg>"


def test_generator_factory_is_built_once_per_task(spark):
    built = spark.sparkContext.accumulator(0)

    def factory():
        built.add(1)
        return lambda pdf, spec: ["<svg><g/></svg>"] * len(pdf)

    factory.is_factory = True
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        df = spark.range(40).repartition(2).select(F.col("id"), F.lit("p").alias("prompt"))
        res = cascade(generation_inputs(df, "S"), factory, ONE_ROUND, partitions=2)
        rows = res.collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    assert len(rows) == 40 and not any(r.used_fallback for r in rows)
    assert built.value <= 2  # one per task, not one per 3-row batch


def test_cascade_spreads_a_single_partition_input(spark):
    tasks = spark.sparkContext.accumulator(0)

    def factory():
        tasks.add(1)
        return lambda pdf, spec: ["<svg><g/></svg>"] * len(pdf)

    factory.is_factory = True
    df = spark.range(64).coalesce(1).select(F.col("id"), F.lit("p").alias("prompt"))
    rows = cascade(generation_inputs(df, "S"), factory, ONE_ROUND, partitions=4).collect()
    assert sorted(r.id for r in rows) == list(range(64))
    assert tasks.value == 4  # the generator ran in four tasks, not one


def test_validity_mode_reaches_the_validator(spark):
    # For blocks the svg pattern extracts, the loose (suffix) and strict checks
    # agree; the mode must still be passed through, and a bad mode rejected.
    import pytest

    test = fx.test_prompts(spark, SF01)
    strict = {r.id: (r.svg, r.used_fallback) for r in run_inference(test, fx.stub_generator, "You draw SVG.").collect()}
    loose = {r.id: (r.svg, r.used_fallback)
             for r in run_inference(test, fx.stub_generator, "You draw SVG.", validity="suffix").collect()}
    assert loose == strict
    ids = fx.read_table(spark, SF01, "documents").select("doc_id")
    with pytest.raises(ValueError):
        first_valid_round(ids, fx.candidates(spark, SF01), id_col="doc_id", validity="bogus")


def test_first_valid_round_with_a_hot_id(spark):
    # id 0 holds a third of all candidate rows (300 rounds); its first valid
    # round is 137. Every other id has rounds 1..3, valid from round id % 3 + 1.
    good, bad = "<svg><g/></svg>", "<svg><g>"
    rows = [(0, r, good if r >= 137 else bad) for r in range(1, 301)]
    rows += [(i, r, good if r >= i % 3 + 1 else bad) for i in range(1, 201) for r in range(1, 4)]
    cands = spark.createDataFrame(rows, "id long, round int, raw string").repartition(6)
    ids = spark.range(0, 201)
    got = {r.id: (r.won_round, r.used_fallback) for r in first_valid_round(ids, cands).collect()}
    assert got[0] == (137, False)
    assert all(got[i] == (i % 3 + 1, False) for i in range(1, 201))
    assert len(got) == 201


def test_first_valid_round_repeated_candidates_are_deterministic(spark):
    rows = [(1, 2, "<svg><b/></svg>"), (1, 2, "<svg><a/></svg>"), (1, 3, "<svg><0/></svg>"), (2, 1, "<svg><g>")]
    cands = spark.createDataFrame(rows, "id long, round int, raw string")
    for parts in (1, 3):
        got = {r.id: (r.svg, r.won_round, r.used_fallback)
               for r in first_valid_round(spark.range(1, 3), cands.repartition(parts)).collect()}
        assert got[1] == ("<svg><a/></svg>", 2, False)
        assert got[2] == (FALLBACK_SVG, None, True)


def test_first_valid_round_keeps_to_its_input_rows(spark):
    from markforge.operators.cascade import first_valid_round

    ids = spark.createDataFrame([(1,), (2,), (2,)], "id long")
    cands = spark.createDataFrame([(1, 1, "<svg>a</svg>"), (99, 1, "<svg>b</svg>")], "id long, round int, raw string")
    got = sorted((r.id, r.used_fallback) for r in first_valid_round(ids, cands).collect())
    assert got == [(1, False), (2, True), (2, True)]


def test_generator_gets_its_columns_only_and_rounds_are_dealt_by_rows(spark):
    tasks = spark.sparkContext.accumulator(0)

    def factory():
        tasks.add(1)

        def gen(pdf, spec):
            assert list(pdf.columns) == ["id", "prompt", "chat", "round", "max_new_tokens"]
            return ["<svg/>" if i % 2 or r == 2 else "none" for i, r in zip(pdf["id"], pdf["round"])]
        return gen

    factory.is_factory = True
    df = spark.range(100).select("id", F.lit("p").alias("prompt"), F.lit("x" * 1000).alias("wide"))
    inputs = generation_inputs(df, "S", carry=("wide",))
    plan = generate_round(inputs, factory, RoundSpec(0.5, 0.9, 1.0, 100), 1)._jdf.queryExecution().executedPlan().toString()
    assert "MapInPandas" not in plan and "ArrowEvalPython" in plan and "Exchange" not in plan
    rows = cascade(inputs, factory, carry=("wide",), rows_per_task=5).collect()
    assert len(rows) == 100 and all(r.wide == "x" * 1000 for r in rows)
    assert sum(r.won_round == 1 for r in rows) == sum(r.won_round == 2 for r in rows) == 50
    assert tasks.value == 20 + 10  # 100 rows, then 50


def test_generator_of_too_few_texts_is_an_error(spark):
    inputs = generation_inputs(spark.createDataFrame([(1, "a"), (2, "b")], "id long, prompt string"), "S")
    with pytest.raises(Exception, match="returned 0 texts"):
        cascade(inputs, lambda pdf, spec: [], partitions=1)
