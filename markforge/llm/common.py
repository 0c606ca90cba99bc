"""Shared steps of the operators: staged tables, checked broadcasts, row keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from markforge.session import materialize

# A side is broadcast only if its measured size is at most this; beyond it the
# same join runs as a shuffle join, which gives the same rows.
BROADCAST_BYTES = 24 << 20


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared checkpoint folder and read back."""
    return materialize(df, f"llm-{name}")


def release(*tables: DataFrame) -> None:
    """Delete staged tables that no later result reads."""
    for table in tables:
        spark = table.sparkSession
        for path in {f.rsplit("/", 1)[0] for f in table.inputFiles()[:1]}:
            p = spark._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def checked_broadcast(side: DataFrame, payload: Column | None = None, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``side`` (a staged table) with a broadcast hint if its rows, at 64 bytes
    each and ``payload`` bytes more, fit ``limit``."""
    size = side.agg(F.sum(F.lit(64) + (F.lit(0) if payload is None else F.coalesce(payload, F.lit(0))))).first()[0] or 0
    return F.broadcast(side) if size <= limit else side


def bounded_batches(spark, rows: int = 1000) -> None:
    """Arrow batches of whole texts are kept to ``rows`` rows in this session: a
    task and its Python worker each hold two of them."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= rows:
        spark.conf.set(name, str(rows))


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, text, row_key)``: rows of equal id and text share a key, rows
    of equal id and other text do not, so decisions find their own row."""
    bounded_batches(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                       F.xxhash64(F.col(id_col), F.col(text_col)).alias("row_key"))


def by_key(docs: DataFrame, decisions: DataFrame, how: str = "left") -> DataFrame:
    """Join ``keyed`` rows with decisions on (doc_id, row_key), null ids included."""
    d = decisions.withColumnsRenamed({"doc_id": "__id", "row_key": "__key"})
    return docs.join(d, docs["doc_id"].eqNullSafe(d["__id"]) & (docs["row_key"] == d["__key"]), how).drop("__id", "__key")


def keys_of(docs: DataFrame) -> tuple[Column, Column]:
    """The key columns of rows that are not ``keyed`` (they may hold any other columns)."""
    return docs["doc_id"].cast("long"), F.xxhash64(docs["doc_id"], docs["text"])


def attach(docs: DataFrame, decisions: DataFrame, how: str = "left") -> DataFrame:
    """Whole rows of ``docs`` joined with decisions by key; decision columns
    come as ``__d_<name>``, so they never clash."""
    side = decisions.select(F.col("doc_id").alias("__d_doc_id"), F.col("row_key").alias("__d_row_key"),
                            *(F.col(c).alias(f"__d_{c}") for c in decisions.columns if c not in ("doc_id", "row_key")))
    doc_id, row_key = keys_of(docs)
    return docs.join(side, doc_id.eqNullSafe(side["__d_doc_id"]) & (row_key == side["__d_row_key"]), how)


def without(docs: DataFrame, dropped: DataFrame, name: str) -> DataFrame:
    """Rows of ``docs`` that are not among the ``dropped`` keys."""
    dropped = staged(dropped.select("doc_id", "row_key").distinct(), name)
    return attach(docs, checked_broadcast(dropped), "left_anti")
