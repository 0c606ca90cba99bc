"""Line dedup by a deletion-neighbourhood join, keeping the earliest line.

A line is its words, A-Z lower-cased. Lines of ``min_words`` words or more are
removed if an earlier line (by doc_id, then line number; judged on the input) is
equal; lines of ``min_near`` words or more also if an earlier one is within one
word edit (a word replaced, inserted or deleted). The query and the pipeline
remove equal lines of every length with a word (``EVERY``) and near ones of
``NEAR`` words or more: in shorter ones a word is a quarter of the line.

1. Every line is hashed where it is read; Spark keeps the first place of each
   distinct line (a map-side combine bounds very common lines).
2. Lines within one edit share the first or the last half of their words, for
   half lengths both lengths have. Halves are counted in Spark, and only lines
   with a half that another line has go on; none that has a partner is lost.
3. These emit their deletion variants as hashed keys: the line itself and, per
   place p, the line without word p. Equal variants are joined: lines that share
   (variant, p) differ at p only; a variant equal to a whole line is one word
   longer. A group is joined through its earliest line, never as all its pairs.
4. Each pair's edit distance is verified on its words.

Defined results: a null text has no lines; lines without words are kept; rows
with equal id and text count as one document; null ids come last; empty tables
give empty results; other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from markforge.llm.common import by_key, checked_broadcast, keyed, release, staged
from markforge.llm.words import Words, mix64, slices

MIN_WORDS, MIN_NEAR, EVERY, NEAR = 3, 8, 1, 5
_PLACE = ("late", "doc_id", "line", "row_key")  # late: the id is null


def _line_bounds(buf, offsets):
    """Byte ranges of all lines and the index of each document's first line."""
    breaks = np.flatnonzero(buf == 10)
    ends = np.sort(np.concatenate((breaks, offsets[1:])), kind="stable")
    per_doc = np.searchsorted(breaks, offsets[1:]) - np.searchsorted(breaks, offsets[:-1]) + 1
    first = np.concatenate(([0], np.cumsum(per_doc)))
    # a document's last line ends with it; a break right there belongs to the line before
    starts = np.empty(len(ends), np.int64)
    starts[1:] = ends[:-1] + 1
    starts[first[:-1]] = offsets[:-1]
    return starts, ends, first


def _hashed(min_words: int, min_near: int):
    def run(batches):
        words = Words(lower=True)
        for part, buf, offsets in slices(batches):
            starts, ends, _ = words.split(buf, offsets)
            h = words.hashes(buf, starts, ends)
            a, b, first = _line_bounds(buf, offsets)
            lo, hi = np.searchsorted(starts, a), np.searchsorted(starts, b)
            pick = np.flatnonzero(hi - lo >= min_words)
            lo, hi = lo[pick], hi[pick]
            doc = np.searchsorted(first, pick, "right") - 1
            n = hi - lo
            halves = []
            for half in ((n - 1) // 2, n // 2):
                halves.append(words.spans(h, lo, lo + half))
                halves.append(mix64(words.spans(h, hi - half, hi)))
            halves = np.stack(halves, axis=1).view(np.int64)
            halves[n % 2 == 1, 2:] = halves[n % 2 == 1, :2]  # an odd length has one half length
            size = np.where(n >= min_near, 4, 0)
            bounds = np.concatenate(([0], np.cumsum(size)))
            keys = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(halves[n >= min_near].ravel()))
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(pa.array(doc)), part.column(2).take(pa.array(doc)),
                 pa.array((pick - first[doc]).astype(np.int64)), pa.array(words.spans(h, lo, hi).view(np.int64)), keys],
                ["doc_id", "row_key", "line", "hash", "halves"])

    return run


def _variants(batches):
    """Deletion variants and words of the listed lines of each document."""
    words = Words(lower=True)
    for part, buf, offsets in slices(batches):
        starts, ends, _ = words.split(buf, offsets)
        h = words.hashes(buf, starts, ends)
        a, b, first = _line_bounds(buf, offsets)
        lo, hi = np.searchsorted(starts, a), np.searchsorted(starts, b)
        rows = []
        raw = buf.tobytes()
        for i, lines in enumerate(part.column(1).to_pylist()):
            for x in lines:
                s, e = int(lo[first[i] + x["line"]]), int(hi[first[i] + x["line"]])
                text = raw[starts[s]:ends[e - 1]].decode().translate(_LOWER)
                rows.append((x["hash"], text, words.deletions(h[s:e]).view(np.int64).tolist()))
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows), (pa.int64(), pa.string(), pa.list_(pa.int64())))],
                ["hash", "line_text", "without"])


_LOWER = {c: c + 32 for c in range(65, 91)}


def _spread_words(text: str) -> list[str]:
    return text.translate({9: " ", 11: " ", 12: " ", 13: " "}).split(" ")


def within_one_edit(a: list[str], b: list[str]) -> bool:
    """Whether two word lists differ by at most one replaced, inserted or deleted word."""
    if abs(len(a) - len(b)) > 1:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    j = 0
    while j < min(len(a), len(b)) - i and a[-1 - j] == b[-1 - j]:
        j += 1
    return max(len(a), len(b)) - i - j <= 1


def _verified(batches):
    for batch in batches:
        d = batch.to_pydict()
        ok = [within_one_edit([w for w in _spread_words(a) if w], [w for w in _spread_words(b) if w])
              for a, b in zip(d["text_a"], d["text_b"])]
        yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(ok))], ["hash"])


def near_lines(rows: DataFrame, firsts: DataFrame) -> DataFrame:
    """Hashes of distinct lines that have an earlier distinct line within one edit."""
    halves = firsts.select("hash", F.explode("halves").alias("half")).distinct()
    shared = staged(halves.groupBy("half").count().filter("count > 1").select("half"), "op2-halves")
    some = halves.join(checked_broadcast(shared), "half", "left_semi").select("hash").distinct()
    lines = staged(firsts.join(some, "hash", "left_semi").select("hash", F.struct(*_PLACE).alias("at")), "op2-lines")
    wanted = staged(lines.groupBy("at.doc_id", "at.row_key").agg(
        F.collect_list(F.struct("at.line", "hash")).alias("lines")), "op2-wanted")
    found = by_key(rows, checked_broadcast(wanted, F.size("lines") * 24), "inner").select("doc_id", "lines", "text")
    found = found.mapInArrow(_variants, "hash long, line_text string, without array<long>")
    found = staged(found.dropDuplicates(["hash"]).join(lines, "hash"), "op2-variants")
    v = found.select("hash", "at", F.posexplode("without").alias("p", "v"))
    earliest = v.groupBy("v", "p").agg(F.min(F.struct("at", "hash")).alias("e"), F.count("*").alias("n")).filter("n > 1")
    one_place = v.join(earliest, ["v", "p"]).filter("hash <> e.hash").select("hash", F.col("e.hash").alias("other"))
    shorter = lines.select(F.col("hash").alias("other"), F.col("at").alias("other_at"))
    one_longer = v.join(shorter, v["v"] == shorter["other"])
    later = F.col("at") > F.col("other_at")
    one_longer = one_longer.select(F.when(later, F.col("hash")).otherwise(F.col("other")).alias("hash"),
                                   F.when(later, F.col("other")).otherwise(F.col("hash")).alias("other"))
    pairs = one_place.union(one_longer).distinct()
    text = found.select("hash", F.col("line_text").alias("text_a"))
    other = found.select(F.col("hash").alias("other"), F.col("line_text").alias("text_b"))
    pairs = pairs.join(text, "hash").join(other, "other").select("hash", "text_a", "text_b")
    return pairs.mapInArrow(_verified, "hash long").distinct()


def _kept(batches):
    for part, buf, offsets in slices(batches):
        a, b, first = _line_bounds(buf, offsets)
        raw, rows = buf.tobytes(), []
        for i, (gone, near) in enumerate(zip(part.column(1).to_pylist(), part.column(2).to_pylist())):
            out = set(gone or ())
            s, e = a[first[i]:first[i + 1]].tolist(), b[first[i]:first[i + 1]].tolist()
            text = raw[s[0]:e[-1]] if not out else b"\n".join(
                [raw[x:y] for k, (x, y) in enumerate(zip(s, e)) if k not in out])
            rows.append((len(s) if len(raw[s[0]:e[-1]]) else 0, len(out), near or 0, text.decode(), hashlib.sha256(text).hexdigest()))
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
        yield pa.RecordBatch.from_arrays(
            [part.column(0), part.column(3), *(pa.array(c, k) for c, k in zip(zip(*rows), kinds))],
            ["doc_id", "row_key", "n_lines", "n_removed", "n_near", "kept_text", "kept_sha256"])


def removed_lines(docs: DataFrame, min_words: int = MIN_WORDS, min_near: int = MIN_NEAR) -> DataFrame:
    """Staged ``doc_id, row_key, lines`` (numbers of removed lines) ``, n_near``
    of the documents that lose a line."""
    rows = keyed(docs)
    lines = staged(rows.select("doc_id", "text", "row_key").mapInArrow(
        _hashed(min_words, min_near), "doc_id long, row_key long, line long, hash long, halves array<long>")
        .withColumn("late", F.col("doc_id").isNull()), "op2-hashed")
    firsts = staged(lines.groupBy("hash").agg(
        F.min(F.struct(*_PLACE, "halves")).alias("f"), F.count("*").alias("n")).select("hash", "n", "f.*"), "op2-firsts")
    near = near_lines(rows, firsts).withColumn("near", F.lit(True))
    hit = staged(firsts.join(near, "hash", "left").filter("n > 1 or near").select(
        "hash", F.struct(*_PLACE).alias("first"), F.coalesce("near", F.lit(False)).alias("near")), "op2-hit")
    is_first = F.struct(*_PLACE).eqNullSafe(F.col("first"))
    gone = lines.drop("halves").join(checked_broadcast(hit), "hash").filter(~is_first | F.col("near")).groupBy("doc_id", "row_key").agg(
        F.collect_set("line").alias("lines"), F.count_distinct(F.when(is_first, F.col("line"))).alias("n_near"))
    gone = staged(gone, "op2-gone")
    release(lines, firsts)
    return gone


def line_dedup(docs: DataFrame, min_words: int = MIN_WORDS, min_near: int = MIN_NEAR) -> DataFrame:
    """Per document: ``doc_id, row_key, n_lines, n_removed, n_near`` (removed
    for an earlier line that is near, not equal), ``kept_text, kept_sha256``."""
    gone = checked_broadcast(removed_lines(docs, min_words, min_near), F.size("lines") * 8)
    joined = by_key(keyed(docs), gone).select("doc_id", "lines", "n_near", "row_key", "text")
    return joined.mapInArrow(_kept, "doc_id long, row_key long, n_lines long, n_removed long, n_near long, "
                                    "kept_text string, kept_sha256 string")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"), EVERY, NEAR)
    return found.select("doc_id", "n_lines", "n_removed", "n_near", "kept_sha256")
