"""Row-local markup operators on a stream of generator outputs.

Generation workers that drop (id, round, raw) files into a folder can be
post-processed incrementally: the same native extraction / repair and the
Arrow validity UDF run per micro-batch, with progress kept in the
checkpoint folder so a restarted query resumes where it stopped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from markforge.functions.markup import is_valid_markup
from markforge.operators.cascade import postprocess

CANDIDATE_SCHEMA = "id long, round int, raw string"


def candidate_stream(spark: SparkSession, path: str, schema: str = CANDIDATE_SCHEMA,
                     max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming read of candidate Parquet files (explicit schema, no inference)."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def postprocess_stream(stream: DataFrame, tag: str = "svg", renames: dict | None = None) -> DataFrame:
    """(id, round, raw) -> (id, round, svg, valid), row by row."""
    out = stream.select("id", "round", postprocess("raw", tag, renames).alias("svg"))
    return out.withColumn("valid", is_valid_markup(F.col("svg"), tag))


def write_stream(stream: DataFrame, out_path: str, name: str = "postprocess",
                 available_now: bool = True, checkpoint: str | None = None) -> StreamingQuery:
    """Append to Parquet. The checkpoint belongs to the output (``<out_path>_checkpoint``
    unless given), so a restart goes on with the files that are new."""
    ckpt = checkpoint or f"{out_path.rstrip('/')}_checkpoint/{name}"
    w = stream.writeStream.format("parquet").option("path", out_path).option("checkpointLocation", ckpt)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.outputMode("append").start()
