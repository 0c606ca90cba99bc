"""Sources: CSV pair files, catalog sources of any format, and the
failure-isolated multi-source load."""

from __future__ import annotations

import csv
import io
import logging
import re
from collections import Counter
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from markforge.config import NA_SENTINELS, SourceSpec
from markforge.functions.text import null_sentinels_to_null
from markforge.operators.positions import SCHEME, head_of_files, position_key
from markforge.operators.union import shared_pairs
from markforge.session import spread

log = logging.getLogger(__name__)

# Field candidates of the wide sources in the reference's (commented-out)
# catalog, as ordered (prompt fields, markup fields). Fixed values.
WIDE_SOURCE_FIELDS = (
    (("description", "keywords", "detail", "prompt", "text"), ("svg", "picosvg", "completion", "target")),
    (("qwen_caption", "img_analysis", "blip_caption", "name"), ("svg_code",)),
    (("prompt", "instruction", "input", "query"), ("completion", "output", "svg", "response")),
    (("prompt", "instruction", "input"), ("completion", "output", "svg")),
)


def _header_text(spark: SparkSession, file: str) -> str:
    """The first record of a CSV file as it is written; empty for a file without one."""
    hadoop, java = spark._jvm.org.apache.hadoop, spark._jvm.java
    conf, path = spark._jsc.hadoopConfiguration(), hadoop.fs.Path(java.net.URI(file))
    stream = path.getFileSystem(conf).open(path)
    try:
        codec = hadoop.io.compress.CompressionCodecFactory(conf).getCodec(path)
        lines = java.io.BufferedReader(java.io.InputStreamReader(codec.createInputStream(stream) if codec else stream, "UTF-8"))
        text = ""
        while (line := lines.readLine()) is not None:
            text = f"{text}\n{line}" if text else line.removeprefix("\ufeff")
            if text.strip() and text.count('"') % 2 == 0:  # a quoted name may hold newlines
                return text
            text = text if text.strip() else ""
        return text
    finally:
        stream.close()


def _header_names(text: str) -> list[str]:
    """Column names of a header, named as Spark's reader does: empty and repeated ones get their place."""
    names = next(csv.reader(io.StringIO(text, newline="")))
    times = Counter(n.lower() for n in names)
    return [f"{n}{i}" if n and times[n.lower()] > 1 else n or f"_c{i}" for i, n in enumerate(names)]


def _csv_layouts(spark: SparkSession, path: str, columns: Sequence[str], na_sentinels: bool,
                 one_of: Sequence[Sequence[str]]) -> list[DataFrame]:
    """``columns`` of a CSV path, one frame per distinct header of its files.

    Spark binds all files of one read to one header by position, so files of
    another header are a read of their own, with their own schema."""
    reader = spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("mode", "PERMISSIVE")
    whole = reader.csv(path)
    files = whole.inputFiles()
    with ThreadPoolExecutor(16) as pool:
        headers = list(pool.map(lambda f: _header_text(spark, f), files))
    layouts: dict[str, list[str]] = {}
    for file, header in zip(files, headers):
        if header:
            layouts.setdefault(header, []).append(re.sub(SCHEME, "", file))
    frames = [whole]
    if len(layouts) > 1:
        at = F.regexp_replace(F.col("_metadata.file_path"), SCHEME, "")
        # the filter is on a constant of each file: other layouts' files are not read
        frames = [reader.schema(T.StructType([T.StructField(n, T.StringType()) for n in _header_names(header)]))
                  .csv(path).where(at.isin(group)) for header, group in sorted(layouts.items())]
    out = []
    for df in frames:
        for group in (columns, *one_of):
            if not set(group) & set(df.columns):
                raise ValueError(f"{path} has none of the fields {list(group)}")
        # fields are found by their name in the header; an absent one is NULL
        df = df.select(*(df[f"`{c}`"] if c in df.columns else F.lit(None).cast("string").alias(c) for c in columns))
        if na_sentinels:
            df = df.select(*[null_sentinels_to_null(c, NA_SENTINELS).alias(c) for c in columns])
        out.append(df)
    return out


def read_csv_text(spark: SparkSession, path: str, columns: Sequence[str], na_sentinels: bool = True,
                  one_of: Sequence[Sequence[str]] = ()) -> DataFrame:
    """A headed CSV whose fields may hold quoted newlines and doubled quotes,
    read as strings by header name (no inference pass). Files of one path may
    differ in their headers.

    ``multiLine`` and ``escape='"'`` are both required for quoted markup.
    ``na_sentinels`` maps pandas' default null spellings to NULL. Every header
    must have at least one of ``columns`` and of each group in ``one_of``.

    A multi-line CSV file cannot be split, so each file is one task: at scale
    convert once to Parquet (see :func:`csv_to_parquet`) and read that.
    """
    return reduce(DataFrame.unionByName, _csv_layouts(spark, path, columns, na_sentinels, one_of))


def read_pairs_csv(spark: SparkSession, path: str, prompt_col: str = "prompt", markup_col: str = "svg") -> DataFrame:
    """Training pairs file (prompt, svg)."""
    return read_csv_text(spark, path, [prompt_col, markup_col])


def read_test_prompts(spark: SparkSession, path: str, id_col: str = "id", prompt_col: str = "prompt",
                      with_position: bool = False) -> DataFrame:
    """Test prompts file (id, prompt); id is passed through as text.

    ``with_position`` adds ``input_pos``, the row's position in file order
    (a multi-line CSV file is read by one task, so the id of the row within
    its task is its line order; files are ordered by path).
    """
    if not with_position:
        return read_csv_text(spark, path, [id_col, prompt_col])
    return with_csv_position(*_csv_layouts(spark, path, [id_col, prompt_col], True, ()))


def csv_row() -> Column:
    """The index of a row within its multi-line CSV file, which one task reads whole (rising, not
    dense, where a task reads several files)."""
    return F.monotonically_increasing_id().bitwiseAND(F.lit(2**33 - 1))


def with_csv_position(*layouts: DataFrame, out: str = "input_pos", spread_rows: bool = False) -> DataFrame:
    """File-order position of a multi-line CSV read (one task per file), given as one frame per header
    (see :func:`_csv_layouts`): a :func:`position_key` of the file's path and the row's index, taken
    at each scan; no table of files. ``spread_rows`` round-robins the rows (see ``spread``) after that."""
    x = reduce(DataFrame.unionByName, (df.select("*", position_key(csv_row()).alias(out)) for df in layouts))
    return spread(x) if spread_rows else x


def csv_to_parquet(df: DataFrame, path: str, partitions: int | None = None) -> None:
    """Write a CSV-read frame as Parquet once, spread over ``partitions``."""
    (df.repartition(partitions) if partitions else df).write.mode("overwrite").parquet(path)


def read_source(spark: SparkSession, spec: SourceSpec, with_position: bool = False, head: int | None = None) -> DataFrame:
    """Read one catalog source. ``path`` may contain ``{split}``; the split
    column, if present, is filtered (partition pruning when partitioned). A
    split that neither can give is an error.

    ``with_position`` adds ``input_pos``, the row's place in file order,
    captured right at the scan (CSV, or Parquet files / tables). ``head`` keeps the source's first
    rows in file order (before a split is filtered) and gives their position; files behind them are not read."""
    if spec.table:
        df = spark.table(spec.table)
        if head:
            raise ValueError(f"source {spec.name}: a head cap needs files, not a table")
        if with_position:
            df = df.select("*", position_key().alias("input_pos"))
    else:
        if spec.path is None:
            raise ValueError(f"source {spec.name}: no path or table")
        path = path_of(spec)
        if spec.format == "csv":
            cols = list(dict.fromkeys([*spec.key_fields, *spec.prompt_fields, *spec.markup_fields]))

            def layouts_of(paths):
                return _csv_layouts(spark, paths, spec.options.get("columns", cols), True,
                                    [g for g in (spec.prompt_fields, spec.markup_fields) if g])

            if head:
                def read(paths):
                    return reduce(DataFrame.unionByName, (df.select("*", "_metadata") for df in layouts_of(paths)))

                # the text reader only lists the files
                got = head_of_files(spark.read.text(path), head, read, row_index=csv_row, whole=read(path))
                return of_split(got.drop("_metadata"), spec)
            layouts = layouts_of(path)
            # A multi-line CSV is one task per file: spread a few large files
            # over the cluster before the per-row work (no-op with many files).
            df = (with_csv_position(*layouts, spread_rows=True) if with_position
                  else spread(reduce(DataFrame.unionByName, layouts)))
        else:
            df = spark.read.format(spec.format).options(**spec.options).load(path)
            if with_position or head:
                if spec.format != "parquet":
                    raise ValueError(f"source {spec.name}: file order needs csv or parquet, not {spec.format}")
                if head:
                    part = spark.read.schema(df.schema).options(**spec.options)
                    if _is_folder(spark, path):  # keeps the columns that its subfolders give
                        part = part.option("basePath", path)
                    return of_split(head_of_files(df, head, lambda paths: part.parquet(*paths)), spec)
                df = df.select("*", position_key().alias("input_pos"))
    return of_split(df, spec)


def _is_folder(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.exists(at) and fs.getFileStatus(at).isDirectory()


def path_of(spec: SourceSpec) -> str | None:
    """The path of a source's files, its split filled in."""
    return spec.path.format(split=spec.split) if spec.path and "{split}" in spec.path else spec.path


def of_split(df: DataFrame, spec: SourceSpec) -> DataFrame:
    """The rows of the source's split."""
    if spec.split is None:
        return df
    if spec.split_column in df.columns:
        return df.where(F.col(spec.split_column) == F.lit(spec.split))
    if spec.table is None and "{split}" in spec.path:
        return df
    raise ValueError(f"source {spec.name}: split {spec.split!r} asked for, but there is neither a {{split}} path "
                     f"nor a column {spec.split_column!r}; use split=None to read all rows")


def load_sources(spark: SparkSession, specs: Sequence[SourceSpec], prepare, verify: str = "schema",
                 with_position: bool = False, head: int | None = None, read: Callable[..., DataFrame] | None = None):
    """Load and prepare every source, skipping (and logging) those that fail.

    ``prepare(df, spec) -> DataFrame`` normalises one source. ``verify``:
    ``"schema"`` only resolves the plan (no job; missing paths and bad
    schemas are caught), ``"count"`` also runs the per-source usable-row
    count, as the reference does, which catches corrupt content at the cost
    of one pass per source. ``with_position`` reads each source with its
    file-order position, ``head`` only its first rows in file order (see :func:`read_source`). ``read(spark, spec)`` replaces
    :func:`read_source`, for instance by one that salvages bad files. Returns ``(loaded, skipped, counts)``.
    """
    loaded, skipped, counts = [], [], {}
    for spec in specs:
        try:
            df = prepare(read(spark, spec) if read else read_source(spark, spec, with_position, head), spec)
            df.schema  # resolves the plan
            if verify == "count":
                counts[spec.name] = df.count()
            loaded.append((spec.name, df))
        except Exception as e:  # isolate any failure to its own source
            log.warning("Skipping %s: %s: %s", spec.name, type(e).__name__, e)
            skipped.append((spec.name, f"{type(e).__name__}: {e}"))
    return loaded, skipped, counts


def _scan_of(spec: SourceSpec) -> tuple:
    """What a source reads; sources that agree in it share one scan."""
    return spec.table, path_of(spec), spec.format, repr(sorted(spec.options.items()))


def _split_rows(df: DataFrame, spec: SourceSpec) -> Column | None:
    """The condition of a source's rows in the scan it shares; ``None``: all."""
    if spec.split is None:
        return None
    if spec.split_column in df.columns:
        return F.col(spec.split_column) == F.lit(spec.split)
    of_split(df, spec)  # an error if neither path nor column gives the split
    return None


def load_shared_pairs(spark: SparkSession, specs: Sequence[SourceSpec], keep: Sequence[str] = (), layout=None,
                      root_tag: str = "svg"):
    """The normalised pairs of every source, each scan read once: sources of one path or table (and format
    and options) are taken from it in one pass (:func:`shared_pairs`), by the split and the candidate fields of each.

    ``keep`` columns come along and must be in every source. ``layout(df)`` may rearrange a scan's columns before. Failures
    are isolated as in :func:`load_sources`: a scan that cannot be resolved skips its sources, a split that a
    source cannot apply skips that source; a source whose fields are all absent has no rows. Returns ``(pairs or None, skipped)``."""
    scans: dict[tuple, list[SourceSpec]] = {}
    frames, skipped = [], []
    for spec in specs:
        scans.setdefault(_scan_of(spec), []).append(spec)
    for (table, path, *_), group in scans.items():
        loaded = []
        try:
            splits = [s.split_column for s in group if s.split is not None and "{split}" not in (s.path or "")]
            whole = replace(group[0], path=path, split=None, key_fields=tuple(dict.fromkeys([*keep, *splits])),
                            prompt_fields=tuple(dict.fromkeys(f for s in group for f in s.prompt_fields)),
                            markup_fields=tuple(dict.fromkeys(f for s in group for f in s.markup_fields)))
            df = read_source(spark, whole)
            df = layout(df) if layout else df
            for spec in group:
                try:
                    loaded.append((spec, _split_rows(df, spec)))
                except ValueError as e:
                    log.warning("Skipping %s: %s", spec.name, e)
                    skipped.append((spec.name, f"ValueError: {e}"))
            if loaded:
                pairs = shared_pairs(df, loaded, keep, root_tag)
                pairs.schema  # resolves the plan
                frames.append(pairs)
        except Exception as e:  # isolate any failure to its own scan
            names = [spec.name for spec, _ in loaded] or [spec.name for spec in group if spec.name not in dict(skipped)]
            log.warning("Skipping %s: %s: %s", ", ".join(names), type(e).__name__, e)
            skipped += [(name, f"{type(e).__name__}: {e}") for name in names]
    return (reduce(DataFrame.unionByName, frames) if frames else None), skipped
