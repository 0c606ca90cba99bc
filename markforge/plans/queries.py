"""Registered queries: one per operator group, each ``(spark, sf_dir) -> DataFrame``
over the driver's tables (or fixtures Spark derives from them)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from markforge.config import DEFAULT_BUDGET, MAX_SEQ_LENGTH, ONE_ROUND, STRICT_BUDGET, CorpusConfig, SourceSpec, StructuralBudget
from markforge.functions.chat import generation_prompt, training_text
from markforge.functions.markup import extract_last_block, is_valid_markup, repair_attributes
from markforge.functions.text import evaluate_once, first_non_empty
from markforge.functions.tokens import count_tokens, generation_budget, token_ids, truncated_length
from markforge.operators.budgets import structural_filter, token_filter
from markforge.operators.cascade import first_valid_round
from markforge.operators.normalize import normalize_pairs
from markforge.operators.positions import seeded_permutation
from markforge.operators.report import (
    fallback_report,
    output_quality,
    require_sources,
    rows_per_group,
    runtime_estimate,
    split_counts,
)
from markforge.operators.runs import Run, RunPaused
from markforge.operators.sampling import (
    capped_sample,
    capped_sample_by,
    exact_split,
    file_row_id,
    head_cap,
    preview,
    seeded_shuffle,
    with_input_position,
)
from markforge.operators.union import union_sources
from markforge.plans import fixtures as fx
from markforge.plans.corpus import prepare_source, sft_corpus
from markforge.plans.inference import inference_job, run_inference
from markforge.sources.readers import WIDE_SOURCE_FIELDS, load_shared_pairs, load_sources, read_csv_text, read_source
from markforge.sources.salvage import salvage
from markforge.sources.sinks import write_csv
from markforge.session import checkpoint_dir, materialize, spread

# Query parameters (fixed so that Spark and the SQL oracles agree).
SYSTEM = "You draw SVG."
SEED = 42
FIXTURE_BUDGET = StructuralBudget(max_len=400, max_counts=(("<path", 10), ("<circle", 8), ("<rect", 8)))
PAGES_BUDGET = StructuralBudget(max_len=6000, max_counts=(("<p", 12), ("<li", 6), ("<a ", 5)))
CORPUS_CFG = CorpusConfig(system_prompt=SYSTEM, budget=FIXTURE_BUDGET, max_tokens=1700, seed=SEED)
SOURCE_CAP = 120
IDLESS_CFG = CorpusConfig(system_prompt=SYSTEM, budget=FIXTURE_BUDGET, max_tokens=1700, seed=SEED,
                          max_per_source=SOURCE_CAP)
REPEATED_KEY_CAP = 333
HEAD_N = 120
TOKENIZER = "byte_bpe_50k.tiktoken"
RUNTIME_SAMPLE = (1.52, 5)
# Languages of ``documents`` posing as sources with the wide field layouts.
LANG_SOURCES = (("en", "wide_a"), ("fr", "wide_b"), ("de", "wide_c"), ("es", "wide_d"))
# Column names each wide source uses for (caption, name, svg_code).
LANG_COLUMNS = (
    ("description", "keywords", "svg"),
    ("qwen_caption", "name", "svg_code"),
    ("prompt", "instruction", "completion"),
    ("prompt", "input", "output"),
)


def _pairs(spark, sf):
    return normalize_pairs(fx.svg_pairs(spark, sf), ["caption", "name"], ["svg_code"], keep=["doc_id"])


def q_first_non_empty(spark, sf):
    p = fx.svg_pairs(spark, sf)
    return p.select("doc_id", first_non_empty(p.columns, ["caption", "name"]).alias("prompt"),
                    first_non_empty(p.columns, ["svg_code"]).alias("svg_raw"))


def q_normalize_pairs(spark, sf):
    return _pairs(spark, sf)


def q_structural_filter(spark, sf):
    return structural_filter(_pairs(spark, sf), "svg", FIXTURE_BUDGET).select("doc_id", "svg")


def q_structural_filter_default(spark, sf):
    return structural_filter(_pairs(spark, sf), "svg", DEFAULT_BUDGET).select("doc_id")


def q_structural_filter_strict(spark, sf):
    return structural_filter(_pairs(spark, sf), "svg", STRICT_BUDGET).select("doc_id")


def q_structural_filter_pages(spark, sf):
    return structural_filter(fx.read_table(spark, sf, "pages"), "html", PAGES_BUDGET).select("page_id", "url")


def wide_catalog(sf):
    """Four catalog sources over ``documents``, one per language, each with
    its own field layout (the split column is ``lang``)."""
    return [SourceSpec(name, path=f"{sf.rstrip('/')}/documents.parquet", split=lang, split_column="lang",
                       prompt_fields=pf, markup_fields=mf, key_fields=("doc_id",))
            for (lang, name), (pf, mf) in zip(LANG_SOURCES, WIDE_SOURCE_FIELDS)]


def _wide_layout(df):
    """One table of the pair fixture with the columns of all wide sources; a row fills those of its language's source."""
    p = fx.svg_pairs_from(spread(df))
    filled = {}
    for (lang, _), cols in zip(LANG_SOURCES, LANG_COLUMNS):
        for c, value in zip(cols, ("caption", "name", "svg_code")):
            filled.setdefault(c, []).append(F.when(F.col("lang") == lang, F.col(value)))
    return p.select("doc_id", "lang", *(F.coalesce(*values).alias(c) for c, values in filled.items()))


def q_union_sources(spark, sf):
    """Four sources of one path, by split and fields, from one scan."""
    pairs, skipped = load_shared_pairs(spark, wide_catalog(sf), keep=["doc_id"], layout=_wide_layout)
    if skipped:
        raise ValueError(f"sources skipped: {skipped}")
    return pairs


def q_source_counts(spark, sf):
    return rows_per_group(q_union_sources(spark, sf), "source_name")


def q_capped_sample(spark, sf):
    d = fx.read_table(spark, sf, "documents").select("doc_id", "lang", "text")
    return capped_sample_by(d, "lang", [lang for lang, _ in LANG_SOURCES], SOURCE_CAP, ["doc_id"], salt=f"cap:{SEED}:")


def q_head_cap(spark, sf):
    d = fx.read_table(spark, sf, "documents").select("doc_id", "lang", "text")
    return head_cap(d, HEAD_N, "doc_id")


def q_seeded_shuffle(spark, sf):
    """The global shuffle: every row is sorted by a salted hash of its id, written and numbered."""
    d = fx.read_table(spark, sf, "documents").select("doc_id", "text")
    return seeded_shuffle(d, ["doc_id"], salt=f"shuffle:{SEED}:")


def q_keyed_permutation(spark, sf):
    """A keyed permutation of the rows' positions: no sort, no exchange of the rows."""
    d = spark.read.parquet(f"{sf.rstrip('/')}/documents.parquet").select("doc_id", "text")
    return seeded_permutation(d, SEED)


def q_ordered_shuffle(spark, sf):
    """The order on disk, under the name it had beside the permutation: :func:`q_seeded_shuffle`."""
    return q_seeded_shuffle(spark, sf)


def _split(spark, sf, share):
    d = fx.read_table(spark, sf, "documents").select("doc_id", "text")
    return exact_split(d, ["doc_id"], share, salt=f"split:{SEED}:")


def q_exact_split(spark, sf):
    return _split(spark, sf, 0.5)


def q_split_2pct(spark, sf):
    return _split(spark, sf, 0.02)


def _corpus(spark, sf):
    return sft_corpus([("documents", _pairs(spark, sf))], CORPUS_CFG, key="doc_id")


def q_sft_corpus(spark, sf):
    return _corpus(spark, sf).where("kept").select("doc_id", "split", "text", "n_tokens")


def q_split_counts(spark, sf):
    return split_counts(_corpus(spark, sf))


def q_sft_render(spark, sf):
    c = fx.conversation_pairs(spark, sf)
    return c.select("conv_id", "turn", training_text("prompt", "output", SYSTEM).alias("text"))


def q_gen_prompt_budget(spark, sf):
    c = fx.read_table(spark, sf, "conversations").where(F.col("role") == "user")
    x = c.select("conv_id", "turn", count_tokens(generation_prompt("text", SYSTEM)).alias("n_input"))
    return x.select("conv_id", "turn", "n_input",
                    generation_budget("n_input", 640).alias("budget_r1"),
                    generation_budget("n_input", 2000).alias("budget_r2"))


def _docs_tokens(spark, sf):
    d = fx.read_table(spark, sf, "documents")
    return d.select("doc_id", count_tokens("text").alias("n_tokens"))


def q_token_count(spark, sf):
    return _docs_tokens(spark, sf)


def q_token_filter(spark, sf):
    d = fx.read_table(spark, sf, "documents").select("doc_id", "text")
    return token_filter(d, 1700, "text").select("doc_id", "n_tokens")


def q_token_truncate(spark, sf):
    t = _docs_tokens(spark, sf)
    return t.select("doc_id", "n_tokens", truncated_length("n_tokens", 2048).alias("n_kept"),
                    (F.col("n_tokens") > 2048).alias("truncated"))


def q_extract_last_block(spark, sf):
    c = fx.candidates(spark, sf)
    return c.select("doc_id", "round", extract_last_block("raw", "svg").alias("svg"))


def q_extract_last_block_pages(spark, sf):
    p = fx.read_table(spark, sf, "pages")
    return p.select("page_id", extract_last_block("html", "article").alias("article"),
                    extract_last_block("html", "li").alias("li"))


def q_attribute_repair(spark, sf):
    p = fx.read_table(spark, sf, "pages")
    return p.select("page_id", repair_attributes("html", {"href": "data-href"}).alias("html"))


def q_validity_strict(spark, sf):
    v = fx.validity_cases(spark, sf)
    return v.select("doc_id", is_valid_markup("markup", "svg", "strict").alias("valid"))


def q_validity_loose(spark, sf):
    v = fx.validity_cases(spark, sf)
    return v.select("doc_id", is_valid_markup("markup", "svg", "suffix").alias("valid"))


def _choice(spark, sf):
    ids = fx.read_table(spark, sf, "documents").select("doc_id")
    return first_valid_round(ids, fx.candidates(spark, sf), id_col="doc_id")


def q_first_valid_round(spark, sf):
    return _choice(spark, sf)


def q_fallback_report(spark, sf):
    return fallback_report(_choice(spark, sf))


def q_output_quality(spark, sf):
    return output_quality(_choice(spark, sf).select("id", "svg"))


def q_cascade_generate(spark, sf):
    return run_inference(fx.test_prompts(spark, sf), fx.stub_generator, SYSTEM)


def q_runtime_estimate(spark, sf):
    minutes, n = RUNTIME_SAMPLE
    return runtime_estimate(fx.test_prompts(spark, sf), minutes, n)


def _scratch(spark, name):
    return f"{checkpoint_dir(spark).rstrip('/')}/markforge/{name}-{uuid.uuid4().hex}"


# CSV layouts by doc_id % 3: permuted with an extra column, plain, without the
# first candidate; the last source has no usable field and must be skipped.
CSV_LAYOUTS = (
    ("permuted", ("svg_code", "name", "lang", "caption", "doc_id")),
    ("plain", ("doc_id", "caption", "name", "svg_code")),
    ("no_caption", ("name", "doc_id", "svg_code")),
)
CSV_UNUSABLE = "unusable"


def _skipped_rows(spark, skipped, **values):
    """One row per skipped source, with ``values`` in the columns it cannot fill."""
    rows = spark.createDataFrame([(name,) for name, _ in skipped], "source_name string")
    return rows.select("source_name", F.lit(True).alias("skipped"), *(F.lit(v).alias(c) for c, v in values.items()))


def q_csv_by_name(spark, sf):
    pairs = fx.svg_pairs(spark, sf)
    specs = []
    for i, (name, cols) in enumerate((*CSV_LAYOUTS, (CSV_UNUSABLE, ("doc_id", "lang")))):
        path = _scratch(spark, f"csv-{name}")
        rows = pairs if name == CSV_UNUSABLE else pairs.where(F.pmod("doc_id", F.lit(len(CSV_LAYOUTS))) == i)
        # every other row of a layout under the same path, columns permuted and one more
        odd = F.pmod(F.floor(F.col("doc_id") / len(CSV_LAYOUTS)), F.lit(2)) == 1
        write_csv(rows.where(~odd).select(*cols), path)
        write_csv(rows.where(odd).select(F.lit("x").alias("extra"), *reversed(cols)), path, mode="append")
        specs.append(SourceSpec(name, path=path, format="csv", split=None, prompt_fields=("caption", "name"),
                                markup_fields=("svg", "svg_code"), key_fields=("doc_id",)))

    def prepare(df, spec):
        return normalize_pairs(df, spec.prompt_fields, spec.markup_fields, keep=["doc_id"])

    loaded, skipped, _ = load_sources(spark, specs, prepare)
    out = union_sources(require_sources(loaded)).select(
        F.col("doc_id").cast("long").alias("doc_id"), "prompt", "svg", "source_name", F.lit(False).alias("skipped"))
    return out.unionByName(_skipped_rows(spark, skipped, doc_id=-1, prompt="", svg=""))


def q_load_with_bad_source(spark, sf):
    bad = _scratch(spark, "not-parquet")
    fx.read_table(spark, sf, "documents").select(F.coalesce("lang", F.lit(""))).write.text(bad)
    specs = [SourceSpec("documents", path=f"{sf.rstrip('/')}/documents.parquet", split=None),
             SourceSpec("corrupt", path=bad, split=None)]

    def prepare(df, spec):
        return normalize_pairs(fx.svg_pairs_from(spread(df)), ["caption", "name"], ["svg_code"])

    loaded, skipped, _ = load_sources(spark, specs, prepare, verify="count")
    counts = rows_per_group(union_sources(require_sources(loaded)), "source_name")
    out = counts.select("source_name", F.col("n_rows").cast("long").alias("n_rows"), F.lit(False).alias("skipped"))
    return out.unionByName(_skipped_rows(spark, skipped, n_rows=0))


def q_salvaged_sources(spark, sf):
    """A folder of Parquet files with one file of another kind among them, and JSON lines of which every second is cut
    off: the readable rows, one ledger row for the file and one for each broken line."""
    folder, lines = _scratch(spark, "salvage-parquet"), _scratch(spark, "salvage-json")
    pairs = fx.svg_pairs(spark, sf).select("doc_id", "caption", "name", "svg_code")
    in_lines = F.pmod("doc_id", F.lit(5)) == 4
    pairs.where(~in_lines).write.parquet(folder)
    spark.range(1).select(F.lit("not a Parquet file")).write.mode("append").text(folder)
    cut = F.concat(F.lit('{"doc_id": '), F.col("doc_id"))
    whole = F.to_json(F.struct("doc_id", "caption", "name", "svg_code"))
    pairs.where(in_lines).select(F.when(F.pmod("doc_id", F.lit(10)) == 4, cut).otherwise(whole)).write.text(lines)
    specs = [SourceSpec("files", path=folder, split=None),
             SourceSpec("lines", path=lines, format="json", split=None,
                        options={"schema": "doc_id long, caption string, name string, svg_code string"})]
    found = {}

    def read(spark, spec):
        found[spec.name] = salvage(spark, spec)
        return found[spec.name].rows

    def prepare(df, spec):
        return normalize_pairs(df, ["caption", "name"], ["svg_code"], keep=["doc_id"])

    loaded, _, _ = load_sources(spark, specs, prepare, read=read)
    rows = union_sources(require_sources(loaded)).select("source_name", "doc_id", "prompt", "svg", F.lit(None).cast("string").alias("lost"))
    none = [F.lit(None).cast(t).alias(c) for c, t in (("doc_id", "long"), ("prompt", "string"), ("svg", "string"))]
    files = found["files"].files.select("source_name", *none, F.col("reason").alias("lost"))
    return rows.unionByName(files).unionByName(found["lines"].records.select("source_name", *none, F.col("record").alias("lost")))


def byte_tokenizer():
    """Encoder factory: the byte-level vocabulary of ``TOKENIZER`` without special tokens."""
    import base64

    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path(TOKENIZER), "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    return tiktoken.Encoding("bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


byte_tokenizer.is_factory = True


def q_token_ids(spark, sf):
    """Subword ids of every whole text, cut at the sequence length. Arrow batches are kept to 500 whole texts in this
    session: a task and its worker each hold two of them, with their ids."""
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(rows)) <= 500:
        spark.conf.set(rows, "500")
    d = fx.read_table(spark, sf, "documents").select("doc_id", evaluate_once(token_ids("text", byte_tokenizer, None)).alias("ids"))
    n = F.size("ids")
    return d.select("doc_id", n.alias("n_tokens"), truncated_length(n).alias("n_kept"), (n > MAX_SEQ_LENGTH).alias("truncated"),
                    F.slice("ids", 1, MAX_SEQ_LENGTH).alias("ids"))


def q_capped_sample_repeated_key(spark, sf):
    """The key repeats in every row of a language: the cap's boundary lies inside a key."""
    d = spark.read.parquet(f"{sf.rstrip('/')}/documents.parquet").select("doc_id", "lang", "text")
    kept = capped_sample(d, REPEATED_KEY_CAP, ["lang"], salt=f"cap:{SEED}:", unique=False, tie_breaker=file_row_id())
    return kept.groupBy("lang").agg(F.count("*").alias("n_kept"))


def q_head_cap_file_order(spark, sf):
    """64 files whose order is not the id's: the first rows in file order, read from the files up
    to the boundary only."""
    path = _scratch(spark, "head")
    last_first = F.col("doc_id").desc()
    d = fx.read_table(spark, sf, "documents").select("doc_id", "lang", "text")
    d.repartitionByRange(64, last_first).sortWithinPartitions(last_first).write.parquet(path)
    return read_source(spark, SourceSpec("head", path=path, split=None), head=HEAD_N).drop("input_pos")


def q_position_file_order(spark, sf):
    """The dense position of each row over files whose order is not the id's."""
    path = _scratch(spark, "positions")
    last_first = F.col("doc_id").desc()
    d = fx.read_table(spark, sf, "documents").select("doc_id", "text")
    d.repartitionByRange(16, last_first).sortWithinPartitions(last_first).write.parquet(path)
    return with_input_position(spark.read.parquet(path)).select("doc_id", F.md5("text").alias("text_md5"), "input_pos")


def q_corpus_idless(spark, sf):
    """The whole corpus path over sources without ids: content keys, ties by row identity."""
    def prepare(df, spec):
        cols = LANG_COLUMNS[[n for _, n in LANG_SOURCES].index(spec.name)]
        p = fx.svg_pairs_from(df)
        src = p.select(*(F.col(c).alias(to) for c, to in zip(("caption", "name", "svg_code"), cols)))
        return prepare_source(src, spec.prompt_fields, spec.markup_fields, IDLESS_CFG, tie_breaker=file_row_id())

    loaded, _, _ = load_sources(spark, wide_catalog(sf), prepare)
    return sft_corpus(require_sources(loaded), IDLESS_CFG).where("kept").select("split", "text", "n_tokens")


def q_cascade_resumed(spark, sf):
    """A run that stops after three of its four pieces (two rounds of two slices) and goes on from its ledger
    with a generator that refuses the first round."""
    name = f"cascade-{uuid.uuid4().hex}"
    prompts = fx.test_prompts(spark, sf)
    try:
        run_inference(prompts, fx.stub_generator, SYSTEM, run=Run(spark, name, max_pieces=3), slices=2)
        raise AssertionError("the run should have stopped")
    except RunPaused:
        pass
    run = Run(spark, name)
    result = materialize(run_inference(prompts, fx.later_rounds_generator, SYSTEM, run=run, slices=2), "resumed")
    run.finish()
    return result


def q_cascade_one_round(spark, sf):
    return run_inference(fx.test_prompts(spark, sf), fx.stub_generator, SYSTEM, rounds=ONE_ROUND, validity="suffix")


def q_submission_csv(spark, sf):
    test, out = _scratch(spark, "test-csv"), _scratch(spark, "submission")
    write_csv(fx.test_prompts(spark, sf), test)
    inference_job(spark, test, fx.stub_generator, SYSTEM, out)
    return read_csv_text(spark, out, ["id", "svg"]).select(F.col("id").cast("long").alias("id"), "svg")


def q_attribute_repair_default(spark, sf):
    p = fx.svg_pairs(spark, sf)
    planted = F.replace("svg_code", F.lit("<path d"), F.lit('<path FILLING = "evenodd" d'))
    return p.select("doc_id", repair_attributes(planted).alias("svg"))


def q_csv_round_trip(spark, sf):
    path = _scratch(spark, "csv")
    pairs = _pairs(spark, sf).select(F.col("doc_id").cast("string").alias("id"), "prompt", "svg")
    write_csv(pairs, path)
    r = read_csv_text(spark, path, ["id", "prompt", "svg"])
    return r.select(F.col("id").cast("long").alias("doc_id"), "prompt", "svg")


def q_preview(spark, sf):
    d = fx.read_table(spark, sf, "documents").select("doc_id", "lang", "text")
    return preview(d, 5, ["doc_id"], ["text"], 400)


QUERIES = {
    "first_non_empty": q_first_non_empty,
    "normalize_pairs": q_normalize_pairs,
    "structural_filter": q_structural_filter,
    "structural_filter_default": q_structural_filter_default,
    "structural_filter_strict": q_structural_filter_strict,
    "structural_filter_pages": q_structural_filter_pages,
    "union_sources": q_union_sources,
    "source_counts": q_source_counts,
    "capped_sample": q_capped_sample,
    "head_cap": q_head_cap,
    "seeded_shuffle": q_seeded_shuffle,
    "keyed_permutation": q_keyed_permutation,
    "exact_split": q_exact_split,
    "split_2pct": q_split_2pct,
    "sft_corpus": q_sft_corpus,
    "split_counts": q_split_counts,
    "sft_render": q_sft_render,
    "gen_prompt_budget": q_gen_prompt_budget,
    "token_count": q_token_count,
    "token_filter": q_token_filter,
    "token_truncate": q_token_truncate,
    "extract_last_block": q_extract_last_block,
    "extract_last_block_pages": q_extract_last_block_pages,
    "attribute_repair": q_attribute_repair,
    "validity_strict": q_validity_strict,
    "validity_loose": q_validity_loose,
    "first_valid_round": q_first_valid_round,
    "fallback_report": q_fallback_report,
    "output_quality": q_output_quality,
    "cascade_generate": q_cascade_generate,
    "runtime_estimate": q_runtime_estimate,
    "csv_round_trip": q_csv_round_trip,
    "preview": q_preview,
    "csv_by_name": q_csv_by_name,
    "load_with_bad_source": q_load_with_bad_source,
    "capped_sample_repeated_key": q_capped_sample_repeated_key,
    "head_cap_file_order": q_head_cap_file_order,
    "corpus_idless": q_corpus_idless,
    "cascade_one_round": q_cascade_one_round,
    "cascade_resumed": q_cascade_resumed,
    "ordered_shuffle": q_ordered_shuffle,
    "position_file_order": q_position_file_order,
    "salvaged_sources": q_salvaged_sources,
    "token_ids": q_token_ids,
    "submission_csv": q_submission_csv,
    "attribute_repair_default": q_attribute_repair_default,
}
