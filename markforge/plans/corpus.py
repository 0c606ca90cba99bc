"""Corpus preparation: sources -> normalised pairs -> budgets -> split ->
chat text -> token budget, as one lazy plan with a few small driver actions
(the cap and split histograms, and optional per-source counts)."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from markforge.config import CorpusConfig, SourceSpec
from markforge.functions.chat import training_text
from markforge.functions.text import evaluate_once
from markforge.functions.tokens import count_tokens
from markforge.operators.budgets import within_structure
from markforge.operators.normalize import normalize_pairs
from markforge.operators.positions import position_tie
from markforge.operators.report import require_sources, rows_per_group, split_counts
from markforge.operators.sampling import (
    capped_sample,
    content_key,
    exact_split,
    file_row_id,
    head_cap,
    long_order,
    salted_hash,
)
from markforge.operators.union import union_sources
from markforge.sources.readers import load_sources, read_source
from markforge.sources.salvage import salvage
from markforge.session import materialize
from markforge.sources.sinks import write_corpus

PAIR_KEY, PAIR_ID, SALVAGED_ID = "pair_key", "pair_id", "salvaged_id"


def prepare_source(df: DataFrame, prompt_fields: Sequence[str], markup_fields: Sequence[str],
                   cfg: CorpusConfig, keys: Sequence[str] = (), keep: Sequence[str] = (),
                   tie_breaker: Column | None = None, position_col: str = "input_pos",
                   identity: Sequence[str] = ()) -> DataFrame:
    """Cap (before normalising, as the reference does), normalise, drop empties.

    ``cfg.head_per_source`` first keeps the first rows by the integer ``position_col``
    (``with_input_position``); ``corpus_job`` takes them while reading instead
    (``read_source(head=...)``). ``identity`` names the columns ``tie_breaker`` reads. Without
    ``keys`` the seeded cap ranks rows by the content of their candidate
    fields. Equal contents repeat, so ties are broken by ``tie_breaker``
    (:func:`file_row_id` for a Parquet scan, or the file-order position:
    only the order keys are staged), else by stored row ids, for which the
    source is first narrowed to the fields normalisation reads.
    """
    extra = list(identity)
    if cfg.head_per_source:
        if position_col not in df.columns:
            raise ValueError(f"a head cap needs the file-order position column {position_col!r}")
        df = head_cap(df, cfg.head_per_source, position_col)
        # the position is a stable, unique row identity (file rank, row)
        tie_breaker, extra = long_order(position_col), [position_col]
    if keys:
        # a repeated key may meet the cap's boundary: rows are told apart by identity
        capped = capped_sample(df, cfg.max_per_source, list(keys), salt=f"cap:{cfg.seed}:", unique=False,
                               tie_breaker=tie_breaker, stage=tie_breaker is not None)
    else:
        fields = [c for c in dict.fromkeys([*prompt_fields, *markup_fields]) if c in df.columns]
        narrow = df.select(*dict.fromkeys([*keep, *fields, *extra])) if fields else df
        capped = capped_sample(narrow, cfg.max_per_source, [content_key(fields or df.columns)],
                               salt=f"cap:{cfg.seed}:", unique=False, tie_breaker=tie_breaker,
                               stage=tie_breaker is not None)
    return normalize_pairs(capped, prompt_fields, markup_fields, cfg.root_tag, keep=keep)


def render_and_budget(split_df: DataFrame, cfg: CorpusConfig,
                      counter: Callable[[str], int] | None = None) -> DataFrame:
    """Add the chat text, its token count and the ``kept`` flag (token budget)."""
    text = training_text("prompt", "svg", cfg.system_prompt)
    # Text and token count are computed once; the ``kept`` filter a caller
    # applies stays above them instead of re-rendering and re-counting.
    out = split_df.withColumn("text", text).withColumn("n_tokens", evaluate_once(count_tokens("text", counter)))
    return out.withColumn("kept", F.col("n_tokens") <= F.lit(cfg.max_tokens))


def sft_corpus(sources: Sequence[tuple[str, DataFrame]], cfg: CorpusConfig, key: str | None = None,
               counter: Callable[[str], int] | None = None, unique_key: bool = True,
               stage: bool = True) -> DataFrame:
    """Union of normalised sources -> structural budget -> exact split ->
    rendered text with token count and ``kept`` flag.

    ``key`` names a unique id column carried through normalisation; without
    one (training pairs carry no id) rows are keyed by the md5 of the
    normalised pair and equal pairs are told apart by their row identity.
    The caller filters ``kept`` for the training table, or reports entered /
    kept per split from the same frame (one pass).

    With ``stage`` (the default) the pairs that pass the structural budget
    are written once to the checkpoint folder: the sources are read and
    normalised once, the cut's histograms read only the key column of the
    staged table, repeated keys are told apart by the staged files' row
    identity (no second staging), and a lost executor re-reads files.
    """
    pairs = union_sources(sources)
    fit = pairs.where(within_structure("svg", cfg.budget))
    if key is None:
        fit = fit.withColumn(PAIR_KEY, content_key(["prompt", "svg"]))
        key, unique_key = PAIR_KEY, False
    salt = f"split:{cfg.seed}:"
    if stage:
        fit = materialize(fit, "corpus-fit")
        tie = None if unique_key else file_row_id()
        split = exact_split(fit, [key], cfg.eval_share, salt=salt, unique=unique_key, stage=False,
                            tie_breaker=tie)
    else:
        split = exact_split(fit, [key], cfg.eval_share, salt=salt, unique=unique_key, stage=False)
    return render_and_budget(split, cfg, counter)


def stage_source(pairs: DataFrame, name: str, cfg: CorpusConfig) -> tuple[DataFrame, int]:
    """Write one source's pairs that fit the structural budget; returns them
    with their content key and row identity, and the source's usable rows
    (before the budget), observed during that write."""
    usable = Observation(f"usable-{name}")
    pairs = pairs.observe(usable, F.count(F.lit(1)).alias("n"))
    fit = pairs.where(within_structure("svg", cfg.budget)).withColumn(PAIR_KEY, content_key(["prompt", "svg"]))
    stored = materialize(fit, "corpus-source")
    return stored.withColumn(PAIR_ID, file_row_id()), usable.get.get("n", 0)


def corpus_job(spark: SparkSession, specs: Sequence[SourceSpec], cfg: CorpusConfig, out_path: str | None = None,
               counter: Callable[[str], int] | None = None, shuffle: bool = True, salvaged: bool = False):
    """The whole preparation run over a source catalog.

    Loads every source with failure isolation, caps, normalises and stages
    each by itself, so a source whose content cannot be read is skipped and
    reported like one whose path is missing (none loaded is an error), then
    builds the corpus from the staged pairs. Writes the kept rows partitioned by split when ``out_path`` is
    given, in a seeded shuffled order (``md5('shuffle:<seed>:' || pair key)``)
    unless ``shuffle`` is off. Returns ``(corpus, report)`` where ``report``
    holds the skipped sources and rows per source and entered / kept rows
    per split: observed during the write (no extra pass) when ``out_path``
    is given, else lazy aggregations.

    With ``salvaged`` a Parquet or JSON source loses only its unreadable files and records (:func:`salvage`), which the
    report lists as ``bad_files`` and ``bad_records``; sources of other formats are read as usual.
    """
    rules = replace(cfg, head_per_source=None)  # the head is taken while reading

    def prepare(df, spec):
        keys = [k for k in spec.key_fields if k in df.columns]
        identity = ("input_pos",) if cfg.head_per_source else ()
        if cfg.head_per_source:
            tie = position_tie("input_pos")
        else:  # a Parquet file source has a stable row identity; others stage row ids
            tie = file_row_id() if spec.table is None and spec.format == "parquet" else None
        if can_salvage(spec):
            tie, identity = F.col(SALVAGED_ID), (SALVAGED_ID,)
        pairs = prepare_source(df, spec.prompt_fields, spec.markup_fields, rules, keys, tie_breaker=tie, identity=identity)
        stored, counts[spec.name] = stage_source(pairs, spec.name, cfg)
        return stored

    def can_salvage(spec):
        return salvaged and spec.table is None and spec.format in ("parquet", "json")

    def read(spark, spec):
        if not can_salvage(spec):
            return read_source(spark, spec, head=cfg.head_per_source)
        got = salvage(spark, spec, list(dict.fromkeys([*spec.key_fields, *spec.prompt_fields, *spec.markup_fields])), SALVAGED_ID)
        bad_files.append(got.files)
        bad_records.append(got.records)
        return got.rows

    if salvaged and cfg.head_per_source:
        raise ValueError("a head cap needs every file of a source: it cannot be salvaged")
    counts, bad_files, bad_records = {}, [], []
    loaded, skipped, _ = load_sources(spark, specs, prepare, read=read)
    names = [name for name, _ in require_sources(loaded)]
    split = exact_split(union_sources(loaded), [PAIR_KEY], cfg.eval_share, salt=f"split:{cfg.seed}:",
                        unique=False, tie_breaker=F.col(PAIR_ID))
    corpus = render_and_budget(split, cfg, counter)
    report = {"skipped": skipped, "usable_per_source": counts}
    if bad_files:
        report["bad_files"] = reduce(DataFrame.unionByName, bad_files)
        report["bad_records"] = reduce(DataFrame.unionByName, bad_records)
    if not out_path:
        report["per_source"] = rows_per_group(corpus, "source_name")
        report["per_split"] = split_counts(corpus)
        return corpus, report
    # The reports are observed during the write (one pass over the corpus,
    # tokens counted once); sources and split labels are known up front.
    labels = ("train", "eval")
    src, split, kept = F.col("source_name"), F.col("split"), F.col("kept")
    metrics = [F.count_if(src == F.lit(n)).alias(f"src{i}") for i, n in enumerate(names)]
    metrics += [F.count_if(split == F.lit(s)).alias(f"in_{s}") for s in labels]
    metrics += [F.count_if((split == F.lit(s)) & kept).alias(f"kept_{s}") for s in labels]
    obs = Observation("corpus-report")
    cols = ["source_name", "split", "text", "n_tokens", "kept"]
    if shuffle:
        # equal pairs share a hash: the staged row's identity lets a range bound split them
        order = F.concat(salted_hash(f"shuffle:{cfg.seed}:", [PAIR_KEY]), F.col(PAIR_ID)).alias("_order")
        write_corpus(corpus.select(*cols, order), out_path, order_col="_order", keep_col="kept",
                     observation=(obs, metrics))
    else:
        write_corpus(corpus.select(*cols), out_path, keep_col="kept", observation=(obs, metrics))
    m = obs.get
    per_source = [(n, m[f"src{i}"]) for i, n in enumerate(names) if m[f"src{i}"]]
    per_split = [(s, m[f"in_{s}"], m[f"kept_{s}"]) for s in labels if m[f"in_{s}"]]
    report["per_source"] = spark.createDataFrame(per_source, "source_name string, n_rows long")
    report["per_split"] = spark.createDataFrame(per_split, "split string, n_entered long, n_kept long")
    return corpus, report
