"""Batch inference: test prompts -> N-round cascade -> submission."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from markforge.config import DEFAULT_ROUNDS, FALLBACK_SVG, RoundSpec
from markforge.operators.cascade import ROWS_PER_TASK, Generator, cascade, generation_inputs
from markforge.operators.runs import Run
from markforge.sources.readers import read_test_prompts
from markforge.sources.sinks import write_submission


def run_inference(test: DataFrame, generator: Generator, system_prompt: str,
                  rounds: Sequence[RoundSpec] = DEFAULT_ROUNDS, id_col: str = "id", prompt_col: str = "prompt",
                  tag: str = "svg", fallback_doc: str = FALLBACK_SVG, compat_nan: bool = True,
                  counter: Callable[[str], int] | None = None,
                  carry: Sequence[str] = (), completion_only: bool = False,
                  partitions: int | None = None, validity: str = "strict", run: Run | None = None, slices: int = 1,
                  rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """(id, svg, used_fallback, won_round), one row per test row."""
    inputs = generation_inputs(test, system_prompt, id_col, prompt_col, compat_nan, counter, carry)
    return cascade(inputs, generator, rounds, tag, fallback_doc, carry=carry,
                   completion_only=completion_only, partitions=partitions, validity=validity, run=run, slices=slices,
                   rows_per_task=rows_per_task)


def inference_job(spark: SparkSession, test_csv: str, generator: Generator, system_prompt: str,
                  out_path: str, rounds: Sequence[RoundSpec] = DEFAULT_ROUNDS, single_file: bool = False,
                  validity: str = "strict", completion_only: bool = False,
                  counter: Callable[[str], int] | None = None, run: Run | None = None, slices: int = 1,
                  rows_per_task: int = ROWS_PER_TASK) -> dict:
    """Read the test CSV, run the cascade, write the submission CSV in test
    file order and report rows, fallbacks and minutes.

    The result is a piece of the run as well, so the generator runs once per row and round; the report
    and the submission read it. ``counter`` (e.g. a tokenizer's counter) sizes each row's new-token budget from its prompt's
    token count; the default is the native proxy.

    With a ``run`` a job that stopped goes on where its ledger ends when it is called again with
    the same run; the run is deleted once the submission is written. Without one the job has a run of its own, deleted
    when it ends, also by an error, so no staged round stays behind.
    """
    t0 = time.time()
    own = run is None
    run = run or Run(spark, f"inference-{uuid.uuid4().hex}")
    test = read_test_prompts(spark, test_csv, with_position=True)
    try:
        res = run_inference(test, generator, system_prompt, rounds, carry=("input_pos",),
                            completion_only=completion_only, validity=validity, counter=counter, run=run, slices=slices,
                            rows_per_task=rows_per_task)
        result = run.stage("result", lambda: res, counted=False)
        write_submission(result, out_path, order_by="input_pos", single_file=single_file)
        fallbacks, rows = result.where("used_fallback").count(), run.rows("result")
        run.finish()
    except Exception:
        if own:
            run.finish()
        raise
    return {"rows": rows, "fallbacks": fallbacks, "minutes": round((time.time() - t0) / 60, 2)}
