"""Substring dedup: Rabin-Karp windows counted in Spark, merged into removal intervals.

Every window of ``width`` words of every text is hashed (64 bits, rolling). The
windows of a slice of documents travel as packed rows, one per slice and hash
bucket, so a shuffle row holds thousands of windows at about ten bytes each. A
map-side combine settles windows that repeat inside a slice: only the document
with the smallest id goes on, the others are known to be removed. A hot passage
thus costs one entry per slice, not one per document. The number of buckets
follows the bytes of text, and each is a shuffle partition of its own, so a bucket is of one size
at every size of the input. It is sorted by hash; windows that also start in a document with a smaller id are removed.
Intervals of removed words are merged per document.

Two different windows share a hash with probability below n**2 / 2**65 for n windows.

Defined results: a null text has no words; a null ``doc_id`` neither removes
nor is removed; rows with one ``doc_id`` never remove one another; empty tables
give empty results; other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from markforge.llm.common import by_key, checked_broadcast, keyed, staged
from markforge.llm.words import SLICE_BYTES, Words, document_of, slices

WIDTH = 50
# Windows kept back by a map task before it sends them; bounds its memory.
PACK = 2_000_000
# Bytes of text whose windows share a bucket: at six bytes a word and ten a packed window, about 14 MB; a
# task holds a bucket unpacked at some 60 bytes a window.
BUCKET_TEXT = 8 << 20

_PACKED = "bucket int, settled boolean, docs binary, keys binary, counts binary, hashes binary, positions binary"
_REMOVED = "doc_id long, row_key long, position int"


def _combine(docs, hashes, doc_index, positions):
    """Split entries into those of the smallest document of each hash and the
    rest, which a smaller document of this slice removes."""
    order = np.argsort(hashes)
    h, d = hashes[order], docs[doc_index[order]]
    begins = np.concatenate(([True], h[1:] != h[:-1])) if len(h) else np.zeros(0, bool)
    group = np.cumsum(begins) - 1
    least = np.minimum.reduceat(d, np.flatnonzero(begins)) if len(h) else d
    lost = d > least[group] if len(h) else np.zeros(0, bool)
    return order[~lost], order[lost]


def _planes(values) -> bytes:
    """Whole numbers from 0, byte plane by byte plane, without the highest planes that are all zero."""
    planes = np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T)
    return planes[:max(1, 8 - int(np.argmax(planes.any(axis=1)[::-1])))].tobytes()


def _from_planes(raw: bytes, n: int):
    planes = np.zeros((8, n), np.uint8)
    got = np.frombuffer(raw, np.uint8).reshape(-1, n)
    planes[:len(got)] = got
    return np.ascontiguousarray(planes.T).view("<u8").ravel().astype(np.int64)


def _steps(positions, counts):
    """Positions, ascending per document, as steps from the one before."""
    positions = positions.astype(np.int64)
    steps = np.diff(positions, prepend=0)
    at = np.cumsum(counts)[:-1]
    steps[at] = positions[at]
    return steps


def _from_steps(steps, counts):
    total = np.cumsum(steps, dtype=np.int64)
    at = np.concatenate(([0], np.cumsum(counts)[:-1])).astype(np.int64)
    return total - np.repeat(total[at] - steps[at], counts)


def _pack(width: int, buckets: int, pack: int):
    def run(batches):
        words = Words()
        held, n_held = [], 0
        n_docs = 0

        def flush():
            docs, keys = (np.concatenate([x[i] for x in held]) for i in (0, 1))
            doc_index, hashes, positions = (np.concatenate([x[i] for x in held]) for i in (2, 3, 4))
            keep, lost = _combine(docs, hashes, doc_index, positions)
            rows = []
            for settled, pick in ((False, np.sort(keep)), (True, np.sort(lost))):
                if not len(pick):
                    continue
                # settled entries are dealt by document, open ones by hash
                to = (doc_index[pick] if settled else hashes[pick]) % np.uint64(buckets)
                to = to.astype(np.int16 if buckets < 1 << 15 else np.int32)
                order = np.argsort(to, kind="stable")  # documents and positions stay ascending
                pick, to = pick[order], to[order]
                at = np.flatnonzero(np.concatenate(([True], to[1:] != to[:-1])))
                for s, e in zip(at, [*at[1:], len(pick)]):
                    used, counts = np.unique(doc_index[pick[s:e]], return_counts=True)
                    rows.append((int(to[s]), settled, docs[used].tobytes(), keys[used].tobytes(), _planes(counts),
                                 b"" if settled else hashes[pick[s:e]].tobytes(),
                                 _planes(_steps(positions[pick[s:e]], counts))))
                    if len(rows) >= 512:
                        yield _batch(rows)
                        rows = []
            if rows:
                yield _batch(rows)

        for part, buf, offsets in slices(batches):
            ids, row_keys = part.column(0), part.column(2)
            starts, ends, first = words.split(buf, offsets)
            if len(starts) < width:
                continue
            start, h = words.windows(words.hashes(buf, starts, ends), first, width)
            doc = document_of(first, start)
            known = np.asarray(ids.is_valid())[doc]
            start, h, doc = start[known], h[known], doc[known]
            if not len(start):
                continue
            held.append((np.asarray(ids.fill_null(0)), np.asarray(row_keys), (doc + n_docs).astype(np.int32), h,
                         (start - first[doc]).astype(np.int32)))
            n_docs += part.num_rows
            n_held += len(start)
            if n_held >= pack:
                yield from flush()
                held, n_held, n_docs = [], 0, 0
        if held:
            yield from flush()

    return run


def _batch(rows) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.bool_(), *[pa.binary()] * 5)
    names = ("bucket", "settled", "docs", "keys", "counts", "hashes", "positions")
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def _settle(pdf: pd.DataFrame) -> pd.DataFrame:
    """One bucket: entries whose hash also starts in a smaller document."""
    out = []
    for settled, rows in pdf.groupby("settled"):
        docs = np.concatenate([np.frombuffer(x, np.int64) for x in rows.docs])
        keys = np.concatenate([np.frombuffer(x, np.int64) for x in rows["keys"]])
        counts = [_from_planes(x, len(d) // 8) for x, d in zip(rows.counts, rows.docs)]
        positions = np.concatenate([_from_steps(_from_planes(x, int(c.sum())), c)
                                    for x, c in zip(rows.positions, counts)])
        doc_index = np.repeat(np.arange(len(docs)), np.concatenate(counts))
        if not settled:
            hashes = np.concatenate([np.frombuffer(x, np.uint64) for x in rows.hashes])
            lost = _combine(docs, hashes, doc_index, positions)[1]
            doc_index, positions = doc_index[lost], positions[lost]
        out.append(pd.DataFrame({"doc_id": docs[doc_index], "row_key": keys[doc_index], "position": positions.astype(np.int32)}))
    return pd.concat(out)


def _merge(width: int):
    """Window starts of a document as bounds of the intervals they cover."""

    def run(batches):
        for batch in batches:
            bounds = []
            for starts in batch.column(2).to_pylist():
                p = np.unique(np.asarray(starts, np.int64))
                apart = np.flatnonzero(np.diff(p) > width)
                lo, hi = p[np.concatenate(([0], apart + 1))], p[np.concatenate((apart, [len(p) - 1]))] + width
                bounds.append(np.stack((lo, hi), axis=1).ravel().tolist())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(bounds, pa.list_(pa.int64()))],
                                             ["doc_id", "row_key", "removed"])

    return run


def buckets_for(docs: DataFrame, text: int = BUCKET_TEXT) -> int:
    """Buckets for the texts of ``docs``: one for each ``text`` bytes, and one a core of the cluster at least."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(docs.sparkSession.sparkContext.defaultParallelism, -(-size // text))


def removed_windows(docs: DataFrame, width: int = WIDTH, buckets: int | None = None, pack: int = PACK) -> DataFrame:
    """``(doc_id, row_key, removed)``: bounds of the intervals covered by windows
    that also start in a document with a smaller id. ``docs`` is ``keyed``."""
    buckets = buckets or buckets_for(docs)
    packed = docs.select("doc_id", "text", "row_key").mapInArrow(_pack(width, buckets, pack), _PACKED)
    found = packed.repartitionById(buckets, "bucket").groupBy("bucket").applyInPandas(_settle, _REMOVED)
    found = found.groupBy("doc_id", "row_key").agg(F.collect_list("position").alias("positions"))
    return found.mapInArrow(_merge(width), "doc_id long, row_key long, removed array<long>")


def _kept(batches):
    words = Words()
    for part, buf, offsets in slices(batches):
        starts, ends, first = words.split(buf, offsets)
        raw, rows = buf.tobytes(), []
        for i, bounds in enumerate(part.column(1).to_pylist()):
            a, b = first[i], first[i + 1]
            keep = np.ones(b - a, bool)
            for s, e in zip(*[iter(bounds or ())] * 2):
                keep[s:e] = False
            text = b" ".join([raw[s:e] for s, e in zip(starts[a:b][keep].tolist(), ends[a:b][keep].tolist())])
            rows.append((int(b - a), int(b - a - keep.sum()), text.decode(), hashlib.sha256(text).hexdigest(), bounds or []))
        n_words, n_removed, kept, sha, spans = zip(*rows)
        yield pa.RecordBatch.from_arrays(
            [part.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
             pa.array(kept, pa.string()), pa.array(sha, pa.string()), pa.array(spans, pa.list_(pa.int64()))],
            ["doc_id", "n_words", "n_removed", "kept_text", "kept_sha256", "removed"])


def substring_dedup(docs: DataFrame, width: int = WIDTH, buckets: int | None = None) -> DataFrame:
    """Per document: ``doc_id, n_words, n_removed, kept_text, kept_sha256,
    removed`` (bounds of the maximal removed word intervals: start, end, start, ...)."""
    rows = keyed(docs)
    found = staged(removed_windows(rows, width, buckets), "op9-removed")
    side = checked_broadcast(found, F.size("removed") * 8)
    joined = by_key(rows, side).select("doc_id", "removed", "text")
    return joined.mapInArrow(_kept, "doc_id long, n_words long, n_removed long, kept_text string, "
                                           "kept_sha256 string, removed array<long>")


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return substring_dedup(docs).select("doc_id", "n_words", "n_removed", "kept_sha256")
