"""Scale check of the exact cut on an amplified table.

Amplifies ``documents`` by ``copies`` (each copy a distinct id) and makes one
key hold a third of all rows, then times an exact split with unique ids, an
exact split keyed by the hot, repeating key (ties broken by stored row ids,
then by Parquet file row ids), and a forced multi-round cut; checks the
counts exactly.

    python tools/stress.py [sf_dir] [copies]
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from markforge.operators.sampling import (  # noqa: E402
    exact_split,
    file_row_id,
    rank_cut,
    salted_hash,
    with_order_key,
)
from markforge.session import local_session, materialize  # noqa: E402


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    copies = int(sys.argv[2]) if len(sys.argv) > 2 else 100
    spark = local_session(8, shuffle_partitions=16)
    d = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    big = d.select(F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("c"), "doc_id", "lang")
    big = big.select((F.col("c").cast("long") * F.lit(10**9) + F.col("doc_id")).alias("id"),
                     F.when(F.pmod(F.col("doc_id"), F.lit(3)) == 0, F.lit(-1)).otherwise(F.col("doc_id")).alias("hot"),
                     "lang")
    big = materialize(big.repartition(32), "stress-input")
    n = big.count()
    out = {"rows": n}

    t0 = time.time()
    s = exact_split(big, ["id"], 0.02)
    ev = s.where("split = 'eval'").count()
    out["split_unique_sec"] = round(time.time() - t0, 2)
    assert ev == math.ceil(n * 0.02), (ev, n)

    t0 = time.time()
    s = exact_split(big, ["hot"], 0.5, unique=False)
    ev = s.where("split = 'eval'").count()
    out["split_hot_key_sec"] = round(time.time() - t0, 2)
    assert ev == math.ceil(n * 0.5), (ev, n)

    # the same split with the Parquet row identity as tie-breaker (no staged rows)
    t0 = time.time()
    s = exact_split(big, ["hot"], 0.5, unique=False, tie_breaker=file_row_id())
    ev = s.where("split = 'eval'").count()
    out["split_hot_key_file_ids_sec"] = round(time.time() - t0, 2)
    assert ev == math.ceil(n * 0.5), (ev, n)

    # force several narrowing rounds: one hex digit per round, small final bucket
    work = materialize(with_order_key(big, salted_hash("s:", ["hot"]), unique=False), "stress-keys")
    t0 = time.time()
    cut = rank_cut(work, n // 3 + 7, digits=1, max_final=1000)
    got = work.where(cut.predicate).count()
    out["multi_round_cut_sec"] = round(time.time() - t0, 2)
    assert got == n // 3 + 7
    print(out)
    spark.stop()


if __name__ == "__main__":
    main()
