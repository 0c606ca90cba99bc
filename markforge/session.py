"""Session helpers: a tuned builder, the checkpoint folder, materialisation."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Configuration a corpus job wants regardless of cluster size.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Markup rows can be large; keep Arrow batches modest for Python operators.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    # ... and bounded in bytes too: prompts are whole documents (a 2,000-row
    # batch of 100 KB texts would be 200 MB per Python worker).
    "spark.sql.execution.arrow.maxBytesPerBatch": str(64 * 1024 * 1024),
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "markforge",
                  checkpoint_dir: str | None = None, extra: dict | None = None) -> SparkSession:
    """A local session for tests and benches (a cluster brings its own)."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in RECOMMENDED_CONF.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", "8g")
    if checkpoint_dir:
        builder = builder.config("spark.checkpoint.dir", checkpoint_dir)
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for materialised intermediates.

    Taken from the session (``spark.checkpoint.dir`` or the context's
    checkpoint directory). Only a local-mode session without one gets a
    fresh temporary folder; on a cluster an unset folder is an error, since a
    machine-local path would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if conf:
        sc.setCheckpointDir(conf)
        return sc.getCheckpointDir() or conf
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS / object store)")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="markforge-ckpt-"))
    return sc.getCheckpointDir()


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the checkpoint folder and read it back.

    Cuts lineage (a lost executor re-reads files instead of recomputing a
    nondeterministic or expensive plan) and gives later passes column pruning.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/markforge/{name}-{uuid.uuid4().hex}"
    df.write.mode("error").parquet(path)
    return spark.read.parquet(path)


# Largest driver-built lookup table (one row per file) that is broadcast.
DEFAULT_BROADCAST_MAX_ROWS = 50_000


def broadcast_if_small(small: DataFrame, n_rows: int) -> DataFrame:
    """Broadcast hint for a table of ``n_rows`` rows built on the driver
    (file ranks, per-file offsets), given only when the count is within
    ``markforge.broadcast.maxRows`` (default 50,000 rows, a few MB of
    paths). Beyond that the hint is dropped and the planner joins by
    shuffle (or AQE picks a broadcast from the measured size); the joined
    key is a file, so no task receives more than one file's rows per key.
    """
    spark = small.sparkSession
    limit = int(spark.conf.get("markforge.broadcast.maxRows", str(DEFAULT_BROADCAST_MAX_ROWS)))
    return F.broadcast(small) if n_rows <= limit else small


# Inputs with more partitions than this are never spread by default: at
# ~128 MB per split that is ~32 GB, beyond which the input's own splits are
# parallel enough and a full round-robin shuffle would cost more than it gains.
DEFAULT_SPREAD_MAX_INPUT_PARTITIONS = 256


def spread(df: DataFrame, min_partitions: int | None = None,
           max_input_partitions: int | None = None) -> DataFrame:
    """Round-robin ``df`` over at least ``min_partitions`` tasks (default: the
    cluster's default parallelism) when the scan yields fewer, e.g. a few
    large multi-line CSV files (one task each) or a small table in one
    Parquet row group feeding CPU-heavy regex or Python work.

    Only inputs of at most ``max_input_partitions`` partitions are spread
    (default ``markforge.spread.maxInputPartitions``, 256); a large input
    with many splits passes through untouched even on a cluster with more
    cores than splits. Callers whose per-row work dwarfs moving the rows
    (generation) pass a larger bound. Call it on a scan or a plan without
    exchanges: the partition count is then found by planning alone, while
    for a plan with an exchange Spark runs that exchange to count them. Set
    ``markforge.spread.enabled=false`` to see the at-scale plan shapes.
    """
    spark = df.sparkSession
    if spark.conf.get("markforge.spread.enabled", "true") != "true":
        return df
    want = min_partitions or spark.sparkContext.defaultParallelism
    limit = max_input_partitions or int(spark.conf.get("markforge.spread.maxInputPartitions",
                                                       str(DEFAULT_SPREAD_MAX_INPUT_PARTITIONS)))
    have = df.rdd.getNumPartitions()
    if have >= want or have > limit:
        return df
    return df.repartition(want)
