"""Positions of rows in file order, the first rows in file order, and a keyed
permutation of positions.

A file's rows are ordered by their index in it, files by their path. Nothing here sorts or
moves rows: a position is an offset plus a row index, a seeded shuffle is arithmetic on the
position, and the first ``n`` rows are the whole files before a boundary file and
a part of that file.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Callable
from urllib.parse import unquote

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from markforge.session import materialize

SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?"
MARK = "\u0001"  # sorts before any character of a path
CHUNK_BITS = 20
# A table of file offsets is broadcast up to this many rows of three longs (24 MB).
OFFSET_ROWS = 1_000_000


def path_column() -> Column:
    """The file of a scanned row, without scheme and authority."""
    return F.regexp_replace(F.col("_metadata.file_path"), SCHEME, "")


def hex_index(index: Column) -> Column:
    """A row index as 16 hex digits, whose string order is the numeric one."""
    return F.lpad(F.lower(F.hex(index.cast("long"))), 16, "0")


def position_key(row_index: Column | None = None) -> Column:
    """A string that orders a scan's rows by file path, then row index (by default the Parquet
    one). It needs no table of files: neither a join nor a file list."""
    return F.concat(path_column(), F.lit(MARK), hex_index(F.col("_metadata.row_index") if row_index is None else row_index))


def position_tie(position: str | Column) -> Column:
    """The fixed-width form (48 characters) of a :func:`position_key`, in order within a file."""
    p = F.col(position) if isinstance(position, str) else position
    return F.concat(F.md5(F.substring_index(p, MARK, 1)), F.substring_index(p, MARK, -1))


def file_offsets(scan: DataFrame) -> DataFrame:
    """``(file_key, n, offset)`` of a Parquet scan, staged: one row a file, the rows of the files
    before it by path. The row counts come from the footers; no column is read."""
    counts = scan.groupBy(path_column().alias("path")).agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.orderBy("path").rowsBetween(Window.unboundedPreceding, -1))  # one row a file
    out = materialize(counts.select(F.xxhash64("path").alias("file_key"), "n", F.coalesce(before, F.lit(0)).alias("offset")),
                      "file-offsets")
    n, distinct = out.agg(F.count(F.lit(1)), F.countDistinct("file_key")).first()
    if n != distinct:
        raise RuntimeError("two file paths share a 64-bit key; rename one of them")
    return out


def with_file_position(scan: DataFrame, out: str = "input_pos", offsets: DataFrame | None = None) -> DataFrame:
    """The dense position 0 ... n - 1 of each row of a Parquet scan in file order; call it right on
    the result of ``spark.read``. It does not depend on split sizes or the cluster.

    The offsets are broadcast while they have at most ``OFFSET_ROWS`` rows (``markforge.offsets.maxRows``).
    Beyond that they are joined by (file, million rows), so that no key holds more than 2**20 rows."""
    spark = scan.sparkSession
    offsets = file_offsets(scan) if offsets is None else offsets
    row = F.col("_metadata.row_index")
    keyed = scan.select("*", F.xxhash64(path_column()).alias("_file"), row.alias("_row"))
    if offsets.count() <= int(spark.conf.get("markforge.offsets.maxRows", str(OFFSET_ROWS))):
        side = F.broadcast(offsets.select(F.col("file_key").alias("_file"), F.col("offset").alias("_offset")))
        joined = keyed.join(side, "_file")
    else:
        last = F.shiftright(F.greatest(F.col("n") - 1, F.lit(0)), CHUNK_BITS)
        side = offsets.select(F.col("file_key").alias("_file"), F.col("offset").alias("_offset"),
                              F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("_chunk"))
        joined = keyed.withColumn("_chunk", F.shiftright("_row", CHUNK_BITS)).join(side, ["_file", "_chunk"])
    return joined.withColumn(out, F.col("_offset") + F.col("_row")).select(*scan.columns, out)


def scanned_files(scan: DataFrame) -> list[str]:
    """The files of a scan in path order, as paths a reader takes."""
    files = sorted((unquote(f) for f in scan.inputFiles()), key=lambda f: re.sub(SCHEME, "", f))
    return [re.sub(r"([\[\]{}*?\\])", r"\\\1", f) for f in files]


def head_of_files(scan: DataFrame, n: int, read: Callable[[list[str]], DataFrame], position: str = "input_pos",
                  row_index: Callable[[], Column] | None = None, whole: DataFrame | None = None) -> DataFrame:
    """The first ``n`` rows of a file scan in file order, with their :func:`position_key`.

    ``read`` reads a list of its files. Files are counted from the front until the boundary file is
    found, about as many at a time as the rows still missing need; later files are never
    opened. The result is the files before the boundary and the first rows of that file: no join,
    no exchange, no order key. ``row_index`` gives a row's index within its file (by default Parquet's), ``whole``
    the result where there are not more rows (by default the scan)."""
    index = row_index or (lambda: F.col("_metadata.row_index"))
    files = scanned_files(scan)
    taken, at, step, boundary = 0, 0, 1, None
    while at < len(files) and boundary is None:
        part = files[at:at + step]
        found = read(part).groupBy(path_column().alias("path")).agg(F.count(F.lit(1)).alias("n")).collect()
        sizes = {unquote(r["path"]): r["n"] for r in found}
        for i, file in enumerate(part):
            size = sizes.get(re.sub(SCHEME, "", re.sub(r"\\(.)", r"\1", file)), 0)
            if taken + size >= n:
                boundary = at + i
                break
            taken += size
        at += len(part)
        mean = taken / at
        step = max(1, min(int((n - taken) / mean) if mean else 2 * step, 4096))
    keyed = lambda df: df.select("*", position_key(index()).alias(position))
    if boundary is None:
        return keyed(scan if whole is None else whole)
    last = keyed(read([files[boundary]]))
    last = last.where(F.substring_index(position, MARK, -1) < hex_index(F.lit(n - taken)))
    return keyed(read(files[:boundary])).unionByName(last) if boundary else last


# ---------------------------------------------------------------------------
# Keyed permutation
# ---------------------------------------------------------------------------

PRIME = 2_147_483_647
FACTOR = 1_103_515_245
ROUNDS = 6


def round_keys(seed: int | str, rounds: int = ROUNDS) -> list[int]:
    """One key below ``PRIME`` a round, from the seed's md5."""
    return [int(hashlib.md5(f"{seed}:{i}".encode()).hexdigest()[:12], 16) % PRIME for i in range(rounds)]


class Permutation:
    """A keyed bijection of 0 ... n - 1, as a column expression.

    A Feistel network over pairs (x div b, x mod b) of a x b cells, where a is the rounded-up root
    of n and b the rounded-up n / a; each round adds a hash of one half to the other, modulo the
    other's size, so it can be undone. Fewer than a cells lie beyond n; a value that falls there
    walks on through the permutation until it is inside. The longest such walk is found
    when the permutation is made (from the fewer than a cells outside), so the expression has a
    fixed number of steps and is exact."""

    def __init__(self, n: int, seed: int | str):
        self.n = n
        self.a = math.isqrt(max(n - 1, 0)) + 1
        self.b = max(1, -(-n // self.a))
        self.keys = round_keys(seed)
        outside = np.arange(n, self.a * self.b, dtype=np.int64)
        self.walk = 0
        while len(outside):
            on = self._once(outside)
            on = on[on >= n]
            if len(on) == len(outside):  # what is left goes round outside, where no walk comes
                break
            outside, self.walk = on, self.walk + 1

    def _once(self, x: np.ndarray) -> np.ndarray:
        left, right = x // self.b, x % self.b
        for i, key in enumerate(self.keys):
            y = (right * FACTOR + key) % PRIME
            left, right = right, (left + (y * y + key) % PRIME) % (self.b if i % 2 else self.a)
        return left * self.b + right

    def values(self, x: np.ndarray) -> np.ndarray:
        """The images of positions, as :meth:`column` gives them."""
        x = self._once(np.asarray(x, np.int64))
        while (x >= self.n).any():
            x = np.where(x >= self.n, self._once(x), x)
        return x

    def column(self, position: str | Column) -> Column:
        long = lambda v: F.lit(v).cast("long")
        steps = F.array(*(F.struct(long(k).alias("key"), long(self.b if i % 2 else self.a).alias("size"))
                          for i, k in enumerate(self.keys)))

        def once(x: Column) -> Column:
            def turn(pair, step):
                y = (pair["r"] * long(FACTOR) + step["key"]) % long(PRIME)
                return F.struct(pair["r"].alias("l"), ((pair["l"] + (y * y + step["key"]) % long(PRIME)) % step["size"]).alias("r"))

            start = F.struct(F.call_function("div", x, long(self.b)).alias("l"), (x % long(self.b)).alias("r"))
            return F.aggregate(steps, start, turn, lambda pair: pair["l"] * long(self.b) + pair["r"])

        x = once(F.col(position) if isinstance(position, str) else position)
        if self.walk:
            x = F.aggregate(F.sequence(F.lit(1), F.lit(self.walk)), x, lambda v, _: F.when(v < long(self.n), v).otherwise(once(v)))
        return x


def seeded_permutation(scan: DataFrame, seed: int | str, out: str = "shuffle_rank", write_to: str | None = None,
                       partitions: int | None = None) -> DataFrame:
    """Each row of a Parquet scan with its 1-based rank in a seeded random order.

    The rank is a :class:`Permutation` of the row's position: rows are neither sorted nor moved, and
    the ranks depend on the files' rows and the seed alone. Another kind of frame is staged as
    Parquet first. With ``write_to`` the rows are also written there in that order (the one range exchange)
    and read back."""
    try:
        scan.select("_metadata.row_index").schema
    except Exception:
        scan = materialize(scan, "permute")
    offsets = file_offsets(scan)
    n = offsets.agg(F.sum("n")).first()[0] or 0
    rank = Permutation(n, seed).column("_position") + 1
    ranked = with_file_position(scan, "_position", offsets).withColumn(out, rank).drop("_position")
    if write_to is None:
        return ranked
    ordered = ranked.repartitionByRange(partitions, out) if partitions else ranked.repartitionByRange(out)
    ordered.sortWithinPartitions(out).write.parquet(write_to)
    return scan.sparkSession.read.parquet(write_to)
