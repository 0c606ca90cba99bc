"""A run ledger: named pieces of a long job, committed one by one, that a restarted job finds again.

The folder of a run lies under ``spark.checkpoint.dir`` and is named by the caller, so another
application finds it too. A piece is a Parquet table in a path of its own; it counts once its ledger entry
exists, which is written after the table and put in place by a rename. What a killed job left behind has
no entry and is not read. The run's owner deletes the folder when its result is safe.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession

from markforge.session import checkpoint_dir


class RunPaused(RuntimeError):
    """The call made as many pieces as it was allowed; the same run can go on later."""


def run_root(spark: SparkSession) -> str:
    """The shared folder of runs: ``spark.checkpoint.dir`` as it is set (not the subfolder that each
    Spark application makes in it)."""
    conf = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    return (conf or checkpoint_dir(spark).rstrip("/").rsplit("/", 1)[0]).rstrip("/") + "/markforge-runs"


class Run:
    """The ledger of one run. ``max_pieces`` limits how many pieces this object makes before it
    raises :class:`RunPaused`, so a job can work in time slots."""

    def __init__(self, spark: SparkSession, name: str, root: str | None = None, max_pieces: int | None = None):
        if not name or "/" in name:
            raise ValueError("a run needs a name without a slash")
        self.spark, self.name = spark, name
        self.folder = f"{(root or run_root(spark)).rstrip('/')}/{name}"
        self.left, self.made, self.reused = max_pieces, [], []
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.folder).getFileSystem(spark._jsc.hadoopConfiguration())

    # -- small files ------------------------------------------------------

    def _read(self, name: str) -> dict | None:
        path = self._path(f"{self.folder}/ledger/{name}.json")
        if not self._fs.exists(path):
            return None
        stream = self._fs.open(path)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _write(self, name: str, value: dict) -> None:
        """Written beside its place and renamed into it: an entry is whole or absent."""
        part = self._path(f"{self.folder}/ledger/.{name}-{uuid.uuid4().hex}")
        stream = self._fs.create(part, True)
        try:
            stream.write(bytearray(json.dumps(value).encode("utf-8")))
        finally:
            stream.close()
        if not self._fs.rename(part, self._path(f"{self.folder}/ledger/{name}.json")):
            raise RuntimeError(f"run {self.name}: {name} was committed by another job")

    # -- the run ------------------------------------------------------------

    def open(self, parameters: dict) -> None:
        """Start the run, or go on with it; a run begun with other parameters is an error."""
        begun = self._read("run")
        if begun is None:
            self._write("run", parameters)
        elif begun != json.loads(json.dumps(parameters)):
            other = sorted(k for k in {*begun, *parameters} if begun.get(k) != json.loads(json.dumps(parameters)).get(k))
            raise ValueError(f"run {self.name} was begun with other parameters: {', '.join(other)}")

    def committed(self) -> list[dict]:
        """The ledger: one entry a committed piece (``piece``, ``path``, ``rows``)."""
        folder = self._path(f"{self.folder}/ledger")
        if not self._fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(folder)]
        return [self._read(n.removesuffix(".json")) for n in sorted(names) if n.endswith(".json") and n != "run.json"]

    def stage(self, piece: str, make, counted: bool = True) -> DataFrame:
        """The table of ``piece``: read if it is committed, else made by ``make()``, written and committed.
        Pieces that are not ``counted`` do not use up ``max_pieces``."""
        entry = self._read(piece)
        if entry is not None:
            self.reused.append(piece)
            return self.spark.read.parquet(entry["path"])
        if counted and self.left is not None:
            if self.left <= 0:
                raise RunPaused(f"run {self.name}: paused before {piece}")
            self.left -= 1
        path = f"{self.folder}/{piece}-{uuid.uuid4().hex}"
        make().write.mode("error").parquet(path)
        done = self.spark.read.parquet(path)
        self._write(piece, {"piece": piece, "path": path, "rows": done.count()})
        self.made.append(piece)
        return done

    def rows(self, piece: str) -> int:
        """Rows of a committed piece, from the ledger."""
        return self._read(piece)["rows"]

    def finish(self) -> None:
        """Delete the run; call it when nothing reads its tables any more."""
        self._fs.delete(self._path(self.folder), True)
