"""Sources read file by file and record by record: what cannot be read is put on record, the rest is kept.

The reference skips a source for one bad file. Here a Parquet source loses only the files that
cannot be read whole, and a JSON Lines source only its malformed records; both are reported.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from markforge.config import SourceSpec
from markforge.operators.sampling import file_row_id
from markforge.session import broadcast_if_small, materialize
from markforge.sources.readers import of_split, path_of

FILE, RECORD, ROW = "__file", "__record", "__row"
FILE_LEDGER = "source_name string, file string, n_bytes long, n_rows long, n_read long, reason string"
RECORD_LEDGER = "source_name string, file string, record string"


@dataclass
class Salvaged:
    """The rows of a source that could be read, staged, and the two ledgers of what could not."""

    rows: DataFrame
    files: DataFrame
    records: DataFrame


def _files(spark: SparkSession, path: str) -> DataFrame:
    """The files of a path with their sizes, listed by Spark; their content is not read."""
    listed = spark.read.format("binaryFile").load(path)
    return listed.select(F.col("_metadata.file_path").alias(FILE), F.col("length").alias("n_bytes"))


def _parquet(spark: SparkSession, spec: SourceSpec, columns: Sequence[str] | None) -> Salvaged:
    path = path_of(spec)
    reader = spark.read.options(**spec.options).option("ignoreCorruptFiles", True)
    schema = spec.options.get("schema")
    # the schema comes from every file's footer, as any one of them may be the bad one
    df = reader.schema(schema).parquet(path) if schema else reader.option("mergeSchema", True).parquet(path)
    file = F.col("_metadata.file_path").alias(FILE)
    wanted = [c for c in df.columns if columns is None or c in columns]
    stored = materialize(df.select(*wanted, file), "salvaged")
    held = df.groupBy(file).agg(F.count(F.lit(1)).alias("n_rows"))  # no column is read: counts of the footers
    read = stored.groupBy(FILE).agg(F.count(F.lit(1)).alias("n_read"))
    counted = _files(spark, path).join(held, FILE, "left").join(read, FILE, "left")
    reason = (F.when(F.col("n_rows").isNull(), F.lit("no row could be read"))
              .when(F.coalesce("n_read", F.lit(0)) < F.col("n_rows"), F.lit("breaks off")))
    bad = counted.select(F.lit(spec.name).alias("source_name"), F.col(FILE).alias("file"), "n_bytes", "n_rows",
                         F.coalesce("n_read", F.lit(0).cast("long")).alias("n_read"), reason.alias("reason"))
    bad = materialize(bad.where("reason is not null"), "salvage-files")
    n_bad = bad.count()
    rows = stored = stored.withColumn(ROW, file_row_id())
    if n_bad:
        rows = stored.join(broadcast_if_small(bad.select(F.col("file").alias(FILE)), n_bad), FILE, "left_anti")
    return Salvaged(rows.select(*wanted, ROW), bad, spark.createDataFrame([], RECORD_LEDGER))


def _json(spark: SparkSession, spec: SourceSpec, columns: Sequence[str] | None) -> Salvaged:
    path = path_of(spec)
    reader = spark.read.options(**spec.options).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", RECORD)
    schema = spec.options.get("schema")
    kind = T._parse_datatype_string(schema) if schema else reader.json(path).schema
    fields = [f for f in kind.fields if f.name != RECORD]
    df = reader.schema(T.StructType([*fields, T.StructField(RECORD, T.StringType())])).json(path)
    wanted = [f.name for f in fields if columns is None or f.name in columns]
    stored = materialize(df.select(*wanted, RECORD, F.col("_metadata.file_path").alias(FILE)), "salvaged")
    records = stored.where(F.col(RECORD).isNotNull()).select(
        F.lit(spec.name).alias("source_name"), F.col(FILE).alias("file"), F.col(RECORD).alias("record"))
    return Salvaged(stored.where(F.col(RECORD).isNull()).select(*wanted, file_row_id().alias(ROW)), spark.createDataFrame([], FILE_LEDGER), records)


def salvage(spark: SparkSession, spec: SourceSpec, columns: Sequence[str] | None = None, row_id: str | None = None) -> Salvaged:
    """Read a source and keep what can be read.

    ``parquet``: the wanted ``columns`` (default all) are staged once with the reader skipping what it cannot decode;
    a file whose staged rows are fewer than its footer says, or that gave none, goes into the ledger whole,
    and none of its rows is kept (a file with no rows at all is listed too: nothing is lost by it).
    ``json`` (one record a line): records that the reader cannot parse under the schema go into the record ledger with their text; a
    file that cannot be read at all is still an error of the source. ``spec.options["schema"]`` gives the schema;
    else it is that of all files together, and files whose types disagree are an error. ``row_id`` names a column
    for the identity of each staged row (:func:`file_row_id`).

    File names meet the rows only as a broadcast of the bad ones, up to ``markforge.broadcast.maxRows`` of them;
    beyond that by a shuffle join. No file list passes through the driver but Spark's own.
    """
    if spec.table or spec.path is None or spec.format not in ("parquet", "json"):
        raise ValueError(f"source {spec.name}: only Parquet and JSON files can be salvaged")
    keep = None if columns is None else [*columns, spec.split_column]
    got = (_parquet if spec.format == "parquet" else _json)(spark, spec, keep)
    rows = of_split(got.rows, spec)
    wanted = [c for c in rows.columns if c != ROW and (columns is None or c in columns)]
    return Salvaged(rows.select(*wanted, *([F.col(ROW).alias(row_id)] if row_id else [])), got.files, got.records)
