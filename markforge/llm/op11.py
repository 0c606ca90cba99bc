"""Hard negatives by a vertical branch-and-bound scan (BOND) over dimension columns.

Vectors become whole numbers ``floor(scale * x)``, so every score is an exact
integer inner product. The anchors (a stated query set) are dealt into rounds of at
most about ``ROUND_BYTES``; each round is broadcast and all rows stream past it once.
A task turns its rows into blocks of dimension columns. Each anchor reads the columns
of a block in the descending order of its own components' magnitude, a few at a
time; what the unread columns can still add lies between sums of the block's minima and
maxima, and rows whose bounds miss every window the anchor looks for leave its candidate
set. The rest get exact scores, of which each window keeps the best few; a window that is
full raises its own lower bound. Per task and window at most those few rows leave, and a
ranking over all tasks gives the result.

The scan runs twice: one window without bounds over the rows of the anchor's label gives its
positives, then a window for each positive's score over the rows of other labels gives the
negatives.

Defined results: rows with a null id, label or vector, or a null or non-finite component take
no part; whole numbers are limited to +-2**22, so scores of up to 4,096 components fit a
long; rows are compared with rows of their own number of components (an empty vector scores
0); rows that share the anchor's id are the anchor itself and never its positives or
negatives; an anchor row given twice counts once, other repeated rows count each; equal scores go
by the smaller id; an anchor without positives, or a positive without negatives in its window,
gives no row; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from markforge.llm.common import staged

SCALE = 256.0
LIMIT = 1 << 22
ROUND_BYTES = 4 << 20
BLOCK_VALUES = 1 << 19  # components of a block: 8,192 rows of 64
STEP = 8  # columns read between two looks at the bounds
LEAST, MOST = -(1 << 62), 1 << 62


class Anchors:
    """Anchors of one vector length, with the windows each looks for."""

    def __init__(self, key, vec_id, label, vectors, low, high, count: int):
        self.key, self.vec_id, self.label, self.vectors = key, vec_id, label, vectors
        self.low, self.high, self.count = low, high, count
        self.read = 0  # components read so far
        self.order = np.argsort(-np.abs(vectors), axis=1, kind="stable")
        self.scores = [np.full((len(w), count), LEAST, np.int64) for w in low]
        self.ids = [np.full((len(w), count), MOST, np.int64) for w in low]

    def scan(self, columns: np.ndarray, ids: np.ndarray, labels: np.ndarray, same: bool) -> None:
        """Take a block, one row of ``columns`` a dimension, into the windows."""
        dims, rows = columns.shape
        peak = int(np.abs(self.vectors).max(initial=0)) * int(np.abs(columns).max(initial=0)) * dims
        kind = np.float64 if peak < 1 << 53 else np.int64  # floats below 2**53 are exact and faster
        columns, vectors = columns.astype(kind), self.vectors.astype(kind)
        ends = (columns.min(axis=1, initial=MOST), columns.max(axis=1, initial=LEAST)) if rows else (np.zeros(dims),) * 2
        parts = np.stack([vectors * ends[0].astype(kind), vectors * ends[1].astype(kind)])
        rest = np.zeros((2, len(vectors), dims + 1), kind)  # least and most that columns from k on can add
        for i, part in enumerate((parts.min(axis=0), parts.max(axis=0))):
            part = np.take_along_axis(part, self.order, axis=1)
            rest[i, :, :dims] = part[:, ::-1].cumsum(axis=1)[:, ::-1]
        found, where = np.unique(labels, return_inverse=True)
        members = dict(zip(found.tolist(), np.split(np.argsort(where, kind="stable"), np.cumsum(np.bincount(where))[:-1])))
        for a in range(len(self.key)):
            if len(self.low[a]):
                mine = members.get(int(self.label[a]), np.zeros(0, np.int64))
                if not same:
                    others = np.ones(rows, bool)
                    others[mine] = False
                    mine = np.flatnonzero(others)
                self._scan_one(a, columns, ids, mine[ids[mine] != self.vec_id[a]], vectors[a], rest[:, a])

    def _scan_one(self, a: int, columns, ids, alive, vector, rest) -> None:
        floors = np.maximum(self.low[a], self.scores[a][:, -1])  # a full window asks for its last score
        least, most = floors.min(), self.high[a].max()
        score = np.zeros(len(alive), columns.dtype)
        dims = len(vector)
        for at in range(0, dims, STEP):
            read = self.order[a, at:at + STEP]
            block = columns[read]
            self.read += len(read) * len(alive)
            score = score + vector[read] @ (block if len(alive) == block.shape[1] else block[:, alive])
            left = min(at + STEP, dims)
            keep = (score + rest[1, left] >= least) & (score + rest[0, left] <= most)
            if not keep.all():
                alive, score = alive[keep], score[keep]
                if not len(alive):
                    return
        score = score.astype(np.int64)
        for w, (floor, high) in enumerate(zip(floors, self.high[a])):
            fit = np.flatnonzero((score >= floor) & (score <= high))
            if len(fit):
                scores = np.concatenate([self.scores[a][w], score[fit]])
                names = np.concatenate([self.ids[a][w], ids[alive[fit]]])
                best = np.lexsort((names, -scores))[:self.count]
                self.scores[a][w], self.ids[a][w] = scores[best], names[best]

    def result(self) -> pa.RecordBatch:
        keys = np.concatenate([np.full(s.size, k, np.int64) for k, s in zip(self.key, self.scores)] or [np.zeros(0, np.int64)])
        windows = np.concatenate([np.repeat(np.arange(len(s)), self.count) for s in self.scores] or [np.zeros(0, np.int64)])
        scores, names = (np.concatenate([x.ravel() for x in y] or [np.zeros(0, np.int64)]) for y in (self.scores, self.ids))
        full = scores > LEAST
        return pa.RecordBatch.from_arrays([pa.array(x[full].astype(t)) for x, t in (
            (keys, np.int64), (windows, np.int32), (names, np.int64), (scores, np.int64))],
            names=["anchor_key", "window", "vec_id", "score"])


def lists_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Flat values and list lengths of an Arrow list column without nulls."""
    return (column.flatten().to_numpy(zero_copy_only=False).astype(np.int64),
            np.diff(column.offsets.to_numpy()).astype(np.int64))


def blocks(batches):
    """Rows of equal length as ``(columns, ids, labels)``, of about ``BLOCK_VALUES`` components."""
    held: dict[int, list] = {}
    for batch in batches:
        values, lengths = lists_of(batch.column("comps"))
        starts = np.cumsum(lengths) - lengths
        ids, labels = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("vec_id", "label"))
        for dims in np.unique(lengths).tolist():
            rows = np.flatnonzero(lengths == dims)
            vectors = values[starts[rows][:, None] + np.arange(dims)]
            size = max(1, BLOCK_VALUES // max(dims, 1))
            for at in range(0, len(rows), size):
                part = rows[at:at + size]
                held.setdefault(dims, []).append((vectors[at:at + size], ids[part], labels[part]))
                if sum(len(x[1]) for x in held[dims]) >= size:
                    yield _block(held.pop(dims))
    for parts in held.values():
        yield _block(parts)


def _block(parts):
    vectors, ids, labels = (np.concatenate(x) for x in zip(*parts))
    return np.ascontiguousarray(vectors.T), ids, labels


def best_in_windows(rows: DataFrame, anchors: DataFrame, same: bool, count: int, name: str) -> DataFrame:
    """``(anchor_key, window, vec_id, score, rank)``: the first ``count`` rows, by score and then
    id, of each window of each anchor, among rows of the anchor's label (``same``) or of others.

    ``anchors`` (staged) has ``anchor_key, vec_id, label, comps`` and ``low, high``, the
    arrays of its windows' bounds.
    """
    spark = rows.sparkSession
    size = anchors.agg(F.sum(F.lit(64) + 4 * F.size("comps") + 16 * (1 + F.size("low")) * count)).first()[0] or 0
    rounds = max(1, math.ceil(size / ROUND_BYTES))
    order = Window.partitionBy("anchor_key", "window").orderBy(F.desc("score"), "vec_id")
    parts = []
    for r in range(rounds):
        table = anchors.filter(F.pmod(F.hash("anchor_key"), F.lit(rounds)) == r).toArrow().combine_chunks()
        given = spark.sparkContext.broadcast({c: table.column(c).to_pylist() for c in ("anchor_key", "vec_id", "label", "comps", "low", "high")})

        def run(batches, given=given):
            groups = {}
            lengths = np.array([len(c) for c in given.value["comps"]], np.int64)
            for dims in np.unique(lengths).tolist():
                at = np.flatnonzero(lengths == dims)
                pick = lambda c: [given.value[c][i] for i in at]
                groups[dims] = Anchors(*(np.array(pick(c), np.int64) for c in ("anchor_key", "vec_id", "label")),
                                       np.array(pick("comps"), np.int64).reshape(len(at), dims),
                                       *([np.array(x, np.int64) for x in pick(c)] for c in ("low", "high")), count)
            for columns, ids, labels in blocks(batches):
                if len(columns) in groups:
                    groups[len(columns)].scan(columns, ids, labels, same)
            for group in groups.values():
                yield group.result()

        found = rows.mapInArrow(run, "anchor_key long, window int, vec_id long, score long")
        best = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= count)
        parts.append(best if rounds == 1 else staged(best, f"{name}-{r}"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def whole_vectors(rows: DataFrame, id_col: str, label: Column, vector_col: str, scale: float = SCALE) -> DataFrame:
    """``(vec_id, label, comps)`` of the rows that take part, components as whole numbers."""
    x = rows.select(F.col(id_col).cast("long").alias("vec_id"), label.cast("long").alias("label"),
                    F.col(vector_col).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    x = x.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & finite)
    whole = F.transform("v", lambda c: F.greatest(F.lit(-float(LIMIT)), F.least(F.lit(float(LIMIT)), F.lit(scale) * c)))
    return x.select("vec_id", "label", F.transform(whole, lambda c: F.floor(c).cast("int")).alias("comps"))


def hard_negatives(rows: DataFrame, is_anchor: Column, n_positives: int = 5, n_negatives: int = 10, low: int = 30,
                   high: int = 90, id_col: str = "vec_id", label: Column | None = None,
                   vector_col: str = "embedding") -> DataFrame:
    """Hard negatives of the anchors ``is_anchor`` (a condition on ``vec_id`` and ``label``).

    A negative of a positive with score p has another label than the anchor and a score s with
    ``low * p <= 100 * s <= high * p``; the best ``n_negatives`` are ranked from 1."""
    data = whole_vectors(rows, id_col, F.col("label") if label is None else label, vector_col)
    anchors = staged(data.filter(is_anchor).distinct().withColumn("anchor_key", F.monotonically_increasing_id()), "op11-anchors")
    every = [F.array(F.lit(b).cast("long")).alias(c) for b, c in ((LEAST, "low"), (MOST, "high"))]
    positives = best_in_windows(data, anchors.select("*", *every), True, n_positives, "op11-positives")
    positives = staged(positives.select("anchor_key", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")),
                       "op11-positives")

    def hundredths(x: str) -> Column:  # rounded down, in whole numbers
        return F.expr(f"({x} - pmod({x}, 100)) div 100")

    # one window per distinct score of a positive
    bounds = F.struct(F.col("positive_score").alias("p"), (-hundredths(f"{-low} * positive_score")).alias("l"),
                      hundredths(f"{high} * positive_score").alias("h"))
    windows = (positives.groupBy("anchor_key").agg(F.array_sort(F.collect_set(bounds)).alias("w"))
               .withColumn("w", F.filter("w", lambda x: x["l"] <= x["h"])))
    windows = staged(anchors.join(windows, "anchor_key").select(
        "anchor_key", "vec_id", "label", "comps", F.col("w.p").alias("p"), F.col("w.l").alias("low"), F.col("w.h").alias("high")), "op11-windows")
    negatives = best_in_windows(data, windows, False, n_negatives, "op11-negatives")
    of = windows.select("anchor_key", F.col("vec_id").alias("anchor_id"), F.posexplode("p").alias("window", "positive_score"))
    pairs = positives.join(of, ["anchor_key", "positive_score"])
    return negatives.withColumnsRenamed({"vec_id": "negative_id", "score": "negative_score"}).join(
        pairs, ["anchor_key", "window"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of all rows of ``embeddings`` whose id is divisible by 100, against all rows."""
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows, F.col("vec_id") % 100 == 0, label=label)


ORACLE = """
WITH rows AS (
  SELECT CAST(vec_id AS BIGINT) AS vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, r.vec_id AS vec_id, a.label = r.label AS same,
         CAST(list_inner_product(a.v, r.v) AS BIGINT) AS score
  FROM rows a JOIN rows r ON a.vec_id <> r.vec_id
  WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
ranked AS (
  SELECT p.anchor_id, p.positive_id, s.vec_id AS negative_id, p.positive_score, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS place
  FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
   AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score)
SELECT anchor_id, positive_id, CAST(place AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM ranked WHERE place <= 10
"""
