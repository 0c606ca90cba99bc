"""Quality rules with suffix-array repetition.

One Arrow pass, no shuffle. Words of a slice of documents are hashed; base
counts come from byte masks and prefix sums. For the method, suffixes that
start a repeated 5-word window of their document are sorted by prefix doubling
(5, 10, 20, ... words), which gives the suffix array of all suffixes that repeat
anything; longest common prefixes of neighbours are read from the doubling
ranks. Each suffix then has its longest repeated prefix, that is a maximal
repeated substring; spans of ``min_repeat`` words or more are united. A document
fails if they cover more than ``max_covered`` of its words or one is longer than
``max_longest`` words. Symbols are compared by 64-bit hash, in any fixed order.

Defined results: null, empty and blank texts have no words, zero counts and
fail the base rule; null and repeated ids are rows like any other; other
columns are not read; very long texts cost a fixed multiple of their length.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from markforge.llm.words import Words, document_of, mix64, slices, sums

MIN_REPEAT, MAX_COVERED, MAX_LONGEST = 10, 0.18, 100
SYMBOLS = b"#*$%&|<>"
BASE = 5

_COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_covered", "longest_repeat")


def _groups(key):
    """Order of ``key`` and, in that order, the number of its group."""
    order = np.argsort(key, kind="stable")
    k = key[order]
    new = np.ones(len(k), bool)
    new[1:] = k[1:] != k[:-1]
    return order, np.cumsum(new) - 1


def repeated_prefixes(hashes, doc, start, key, width: int = BASE):
    """``(p, length)`` for each suffix p whose first ``width`` words occur twice
    in its document: the longest prefix that occurs twice. ``key`` is one value
    per document and window at ``start``."""
    order, group = _groups(key)
    size = np.bincount(group)
    twice = size[group] > 1
    p = start[order[twice]]
    if not len(p):
        return p, p
    n = len(hashes)
    rank = np.full(n + 1, -1, np.int64)
    rank[p] = group[twice]
    levels, length = [(width, rank)], width
    while True:
        after = np.where(p + length < n, rank[np.minimum(p + length, n)], -1)
        after = np.where(after >= 0, after, n + p)  # what does not repeat equals nothing
        order = np.lexsort((after, rank[p]))
        p, after = p[order], after[order]
        r = rank[p]
        new = np.ones(len(p), bool)
        new[1:] = (r[1:] != r[:-1]) | (after[1:] != after[:-1])
        if new.all():
            break
        rank = np.full(n + 1, -1, np.int64)
        rank[p] = np.cumsum(new) - 1
        length *= 2
        levels.append((length, rank))
    i, j = p[:-1], p[1:]  # neighbours in the suffix array
    common = np.zeros(len(i), np.int64)
    for length, rank in reversed(levels):
        a, b = np.minimum(i + common, n), np.minimum(j + common, n)
        common += length * ((rank[a] >= 0) & (rank[a] == rank[b]))
    open_ = common >= width
    for _ in range(width - 1):
        a, b = i + common, j + common
        ok = open_ & (a < n) & (b < n)
        a, b = np.where(ok, a, 0), np.where(ok, b, 0)
        open_ = ok & (hashes[a] == hashes[b]) & (doc[a] == doc[i]) & (doc[b] == doc[i])
        common += open_
    best = np.zeros(len(p), np.int64)
    best[:-1] = common
    best[1:] = np.maximum(best[1:], common)
    return p, best


def _covered(n: int, starts, lengths):
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.subtract.at(edge, starts + lengths, 1)
    return np.cumsum(edge[:-1]) > 0


def _count(min_repeat: int):
    def run(batches):
        words = Words()
        symbol = np.zeros(256, bool)
        symbol[list(SYMBOLS)] = True
        for part, buf, offsets in slices(batches):
            n_docs = part.num_rows
            starts, ends, first = words.split(buf, offsets)
            h = words.hashes(buf, starts, ends)
            n = len(h)
            inside = words.is_word[buf]
            out = {"n_words": np.diff(first),
                   "word_chars": sums(inside & ((buf & 0xC0) != 0x80), offsets),
                   "n_symbols": sums(symbol[buf], offsets)}
            # lines: split at \n; a document's last line ends with it
            cut = np.unique(np.concatenate((np.flatnonzero(buf == 10) + 1, offsets)))
            a, b = cut[:-1], cut[1:]
            b = b - (buf[b - 1] == 10) if len(b) else b
            full = np.searchsorted(starts, b) > np.searchsorted(starts, a)
            a, b = a[full], b[full]
            of = np.searchsorted(offsets, a, "right") - 1
            order, group = _groups(mix64(words.hashes(buf, a, b) + of.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
            again = np.zeros(len(order), bool)
            again[1:] = group[1:] == group[:-1]
            out["n_dup_lines"] = np.bincount(of[order[again]], minlength=n_docs)
            # repeated windows and maximal repeats
            start, wh = words.windows(h, first, BASE)
            doc = document_of(first, np.arange(n)) if n else np.zeros(0, np.int64)
            key = mix64(wh + doc[start].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            p, longest = repeated_prefixes(h, doc, start, key)
            out["n_repeat_words"] = sums(_covered(n, p, BASE), first)
            keep = longest >= min_repeat
            p, longest = p[keep], longest[keep]
            out["n_covered"] = sums(_covered(n, p, longest), first)
            most = np.zeros(n_docs, np.int64)
            np.maximum.at(most, doc[p], longest)
            out["longest_repeat"] = most
            yield pa.RecordBatch.from_arrays(
                [part.column(0), *(pa.array(out[c].astype(np.int64)) for c in _COLUMNS)], ["doc_id", *_COLUMNS])

    return run


def quality_rules(docs: DataFrame, min_repeat: int = MIN_REPEAT, max_covered: float = MAX_COVERED,
                  max_longest: int = MAX_LONGEST, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, the base counts, ``n_covered``, ``longest_repeat``,
    ``base_failed`` and ``kept`` per document."""
    counts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    counts = counts.mapInArrow(_count(min_repeat), "doc_id long, " + ", ".join(f"{c} long" for c in _COLUMNS))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    repetitive = (F.col("n_covered") > max_covered * F.col("n_words")) | (F.col("longest_repeat") > max_longest)
    return counts.withColumn("base_failed", failed).withColumn("kept", ~(failed | repetitive))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(spark.read.parquet(f"{sf_dir}/documents.parquet"))
