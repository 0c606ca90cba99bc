"""Generation cascade around a caller-supplied generator, and the offline
choice of the first valid candidate.

The reference loops over test prompts one by one and calls the model up to
twice per prompt. Here each round is one partition-parallel batch job over
the rows still failing; every round's output is written to the checkpoint
folder before the next round reads it, because generators are
nondeterministic and a recomputed round would change which rows retry.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from markforge.config import DEFAULT_ROUNDS, FALLBACK_SVG, RoundSpec
from markforge.functions.chat import completion_text, generation_prompt
from markforge.functions.markup import extract_last_block, is_valid_markup, repair_attributes
from markforge.functions.text import evaluate_once
from markforge.functions.tokens import count_tokens, generation_budget
from markforge.operators.runs import Run
from markforge.session import materialize

# A generator maps a pandas batch with columns (id, prompt, chat, round,
# max_new_tokens) and the round's knobs to the decoded text of each row.
# A zero-argument factory marked ``is_factory = True`` that returns such a
# function is called once per task, so a model is loaded once per task and
# not once per Arrow batch.
Generator = Callable[[pd.DataFrame, RoundSpec], Sequence[str]]
GENERATOR_COLUMNS = ("id", "prompt", "chat", "round", "max_new_tokens")

# Rows that one generation task takes unless the caller says otherwise: also what a lost task repeats.
ROWS_PER_TASK = 2_000


def postprocess(raw_col: str | Column = "raw", tag: str = "svg", renames: dict | None = None):
    """Decoded text -> last markup block -> attribute repair (Column).

    Evaluated in its own projection, so the validity UDF and the output read
    the extracted markup instead of each re-running the regex over the raw
    text.
    """
    return evaluate_once(repair_attributes(extract_last_block(raw_col, tag), renames))


def generation_inputs(df: DataFrame, system_prompt: str, id_col: str = "id", prompt_col: str = "prompt",
                      compat_nan: bool = True, counter: Callable[[str], int] | None = None,
                      carry: Sequence[str] = ()) -> DataFrame:
    """(id, prompt, chat, n_input): rendered generation prompt and its tokens.

    ``compat_nan`` renders a missing prompt as the text ``nan``, as a pandas
    read of the test file would; otherwise it renders as ``''``. ``carry``
    names extra columns (e.g. the input position) kept to the output.
    """
    missing = F.lit("nan") if compat_nan else F.lit("")
    prompt = F.coalesce(F.col(prompt_col).cast("string"), missing)
    x = df.select(*carry, F.col(id_col).alias("id"), prompt.alias("prompt"))
    x = x.withColumn("chat", generation_prompt("prompt", system_prompt))
    return x.withColumn("n_input", count_tokens("chat", counter))


def generated_text(generator: Generator, spec: RoundSpec) -> Column:
    """The decoded text of each row: an iterator pandas UDF over the generator's columns. It is marked
    nondeterministic, so the optimizer neither repeats it nor moves a filter below it."""
    is_factory = getattr(generator, "is_factory", False)

    @F.pandas_udf("string")
    def _text(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        generate = generator() if is_factory else generator
        for pdf in batches:
            texts = list(generate(pdf, spec)) if len(pdf) else []
            if len(texts) != len(pdf):
                raise ValueError(f"the generator returned {len(texts)} texts for {len(pdf)} rows")
            yield pd.Series(texts, index=pdf.index, dtype=object)

    return _text.asNondeterministic()(F.struct(*GENERATOR_COLUMNS))


def generate_round(inputs: DataFrame, generator: Generator, spec: RoundSpec, round_no: int,
                   tag: str = "svg", renames: dict | None = None, completion_only: bool = False,
                   validity: str = "strict") -> DataFrame:
    """One round: budget per row, batch generation in ``mapInPandas``, then
    extraction, repair and validation as columns.

    Python gets the columns a generator may read (:data:`GENERATOR_COLUMNS`) and returns the decoded
    text alone; every other column, and the prompt and chat themselves, stay in the JVM beside it, so a
    later round finds them in this round's output: no join back to the inputs and no copy of a prompt out of
    Python. Output: input columns + (round, svg, valid).
    Extraction reads the whole decoded text (prompt included, as the
    reference does) unless ``completion_only`` drops the echoed prompt.
    ``validity`` is ``"strict"`` (root local name equals ``tag``) or
    ``"suffix"`` (root name ends with it, the earlier variant's check).
    """
    cols = inputs.columns
    x = inputs.select(*cols, F.lit(round_no).alias("round"),
                      generation_budget("n_input", spec.max_cap).alias("max_new_tokens"))
    raw = x.withColumn("raw", generated_text(generator, spec))
    source = completion_text("raw", "chat") if completion_only else F.col("raw")
    out = raw.select(*cols, "round", postprocess(source, tag, renames).alias("svg"))
    return out.withColumn("valid", is_valid_markup("svg", tag, validity))


def cascade(inputs: DataFrame, generator: Generator, rounds: Sequence[RoundSpec] = DEFAULT_ROUNDS,
            tag: str = "svg", fallback_doc: str = FALLBACK_SVG, renames: dict | None = None,
            carry: Sequence[str] = (), completion_only: bool = False,
            partitions: int | None = None, validity: str = "strict", run: Run | None = None, slices: int = 1,
            rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """N-round generation: round i runs only on ids that failed rounds < i;
    ids failing every round get the fallback.

    Returns (id, svg, used_fallback, won_round) with exactly one row per
    input row. Each round's output is written before the next round reads
    its failures, so the rows retried are exactly the rows that failed, even
    if an executor is lost. Winners of different rounds are disjoint, so the
    result is a plain union: no join, no grouping, and no exchange besides
    the deal of the inputs below.

    Generation dominates the cost, so the rows of every round are first dealt
    round-robin over ``partitions`` tasks (default: one per ``rows_per_task`` rows, and
    at least the cluster's slots): every slot generates and tasks are balanced whatever the
    input's partitioning (a multi-line CSV of test prompts is one task per
    file; the failures of a round lie in few small files). Winners are staged without their prompts. Moving the
    prompts costs little next to generating from them, and the deal is deterministic, so a retried task gets the same rows.

    With a ``run`` (:class:`Run`) the cascade can be resumed: its inputs are staged once, cut into ``slices`` by
    their stored row number, and every round of a slice is a piece of the run's ledger. Called again with the
    same run after a stop, it reads the pieces that were committed and generates only the others; another
    input or other settings under the same name are an error. The caller finishes the run when the result is stored.
    """
    cols = inputs.columns
    spark = inputs.sparkSession
    slots = spark.sparkContext.defaultParallelism

    def one_round(pending, i, spec):
        res = generate_round(pending, generator, spec, i, tag, renames, completion_only, validity)
        # only a row to be retried needs its prompt again
        retry = [F.when(~F.col("valid"), F.col(c)).alias(c) if c in ("prompt", "chat") else F.col(c) for c in res.columns]
        return res.select(*retry)

    def dealt(piece):
        return piece.repartition(partitions or max(slots, -(-piece.count() // rows_per_task)))

    if run is None:
        pieces = [inputs]
    else:
        run.open({"rounds": [repr(spec) for spec in rounds], "tag": tag, "renames": repr(renames), "validity": validity,
                  "completion_only": completion_only, "slices": slices, "inputs": _digest(inputs)})
        number = F.pmod(F.monotonically_increasing_id(), F.lit(slices)).alias("_slice")
        staged = run.stage("inputs", lambda: inputs.select("*", number), counted=False)
        pieces = [staged.where(F.col("_slice") == k).select(*cols) for k in range(slices)]
    winners = []
    for i, spec in enumerate(rounds, start=1):
        pending = []
        for k, piece in enumerate(pieces):
            if run is None:
                res = materialize(one_round(dealt(piece), i, spec), f"gen-round{i}")
            else:
                res = run.stage(f"round{i}-slice{k}", lambda: one_round(dealt(piece), i, spec))
            winners.append(res.where("valid").select(*carry, "id", "svg", F.lit(False).alias("used_fallback"),
                                                     F.col("round").alias("won_round")))
            pending.append(res.where(~F.col("valid")).select(*cols))
        pieces = pending
    winners += [piece.select(*carry, "id", F.lit(fallback_doc).alias("svg"), F.lit(True).alias("used_fallback"),
                             F.lit(None).cast("int").alias("won_round")) for piece in pieces]
    out = winners[0]
    for w in winners[1:]:
        out = out.unionByName(w)
    return out


def _digest(inputs: DataFrame) -> str:
    """Rows and an order-free sum of row hashes: tells whether a resumed run has the same inputs."""
    h = F.xxhash64(*inputs.columns).cast("decimal(38,0)")
    return "{}:{}:{}".format(*inputs.agg(F.count(F.lit(1)), F.sum(h)).first(), ",".join(inputs.columns))


def first_valid_round(ids: DataFrame, cands: DataFrame, id_col: str = "id", round_col: str = "round",
                      raw_col: str = "raw", tag: str = "svg", fallback_doc: str = FALLBACK_SVG,
                      renames: dict | None = None, validity: str = "strict") -> DataFrame:
    """Offline choice from a candidate table (id, round, raw): the lowest
    valid round wins; ids without a valid candidate get the fallback.

    The id table and the valid candidates are unioned and grouped once by id
    (partial + final ``min`` of ``(round, svg)``, one exchange), so every input
    row yields exactly one row, ids that are not in the id table yield none, and no join is needed; a hot id is pre-aggregated
    map-side like any other. Equal rounds of one id (a repeated candidate)
    resolve to the smallest markup, so the choice is deterministic.
    """
    c = cands.select(F.col(id_col).alias("id"), F.col(round_col).cast("int").alias("round"),
                     postprocess(raw_col, tag, renames).alias("svg"))
    valid = c.where(is_valid_markup("svg", tag, validity))
    base = ids.select(F.col(id_col).alias("id"), F.lit(None).cast("int").alias("round"),
                      F.lit(None).cast("string").alias("svg"), F.lit(1).cast("long").alias("is_input"))
    # The id rows carry a NULL struct (ignored by min), not a struct of NULLs.
    candidate = F.when(F.col("round").isNotNull(), F.struct("round", "svg"))
    best = (base.unionByName(valid.withColumn("is_input", F.lit(0).cast("long"))).groupBy("id")
            .agg(F.min(candidate).alias("best"), F.sum("is_input").alias("n_input")))
    # Candidates of unknown ids go; a repeated id gets one row per input row.
    best = best.where("n_input > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n_input"))))
    return best.select(
        "id",
        F.coalesce(F.col("best.svg"), F.lit(fallback_doc)).alias("svg"),
        F.col("best").isNull().alias("used_fallback"),
        F.col("best.round").alias("won_round"),
    )


def submission(result: DataFrame) -> DataFrame:
    """Submission projection (id, svg)."""
    return result.select("id", "svg")
