"""Scale check of the generation cascade on amplified test prompts.

Test prompts from ``documents`` x ``copies`` (whole texts, NULL prompts
included) go through the two-round cascade with the deterministic stub
generator. Checks one output row per input row, the exact number of
fallbacks and round-2 winners from the id arithmetic, and that round 2 saw
only round 1's failures (an accumulator counts the generator's rows).

    python tools/stress_cascade.py [sf_dir] [copies]
"""

from __future__ import annotations

import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from markforge.plans import fixtures as fx  # noqa: E402
from markforge.plans.inference import run_inference  # noqa: E402
from markforge.session import local_session, materialize  # noqa: E402


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    copies = int(sys.argv[2]) if len(sys.argv) > 2 else 20
    scratch = tempfile.mkdtemp(prefix="run-")
    spark = local_session(8, shuffle_partitions=16, checkpoint_dir=os.path.join(scratch, "ckpt"))
    test = fx.test_prompts(spark, sf)
    big = test.select(F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("c"), "id", "prompt")
    big = big.select((F.col("c").cast("long") * F.lit(10**6) + F.col("id")).alias("id"), "prompt")
    big = materialize(big, "stress-prompts")
    ids = [r.id for r in big.select("id").collect()]
    seen = spark.sparkContext.accumulator(0)

    def generator(pdf, spec):
        seen.add(len(pdf))
        return fx.stub_generator(pdf, spec)

    t0 = time.time()
    res = materialize(run_inference(big, generator, "You draw SVG."), "stress-result")
    out = {"rows": len(ids), "cascade_sec": round(time.time() - t0, 2)}
    rows = res.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("id").alias("ids"),
                   F.count_if("used_fallback").alias("fb"), F.count_if(F.col("won_round") == 2).alias("r2")).first()

    # Round r is valid iff (id + r) % 5 != 0 and id % 23 != 0 (the stub's rule).
    def ok(i, r):
        return (i + r) % 5 != 0 and i % 23 != 0

    fallbacks = sum(1 for i in ids if not ok(i, 1) and not ok(i, 2))
    round2 = sum(1 for i in ids if not ok(i, 1) and ok(i, 2))
    failed1 = sum(1 for i in ids if not ok(i, 1))
    assert (rows.n, rows.ids) == (len(ids), len(ids)), rows
    assert (rows.fb, rows.r2) == (fallbacks, round2), (rows, fallbacks, round2)
    assert seen.value == len(ids) + failed1, (seen.value, len(ids), failed1)
    out.update(fallbacks=fallbacks, won_round2=round2, generator_rows=seen.value)
    print(out)
    spark.stop()


if __name__ == "__main__":
    main()
