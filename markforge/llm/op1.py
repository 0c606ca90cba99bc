"""Language identification with hyperdimensional profiles.

A letter is a random vector of +1 and -1, made from its code point. An n-gram
binds the vectors of its letters, rolled by their place, by multiplication; a
document bundles (adds) the vectors of all its n-grams; a language prototype
bundles its training documents, each at unit length, less the mean over all
languages' prototypes. A document takes the language of highest cosine.

A slice of documents becomes a matrix of n-gram counts, bundled by a
matrix product for each ``CHUNK`` distinct n-grams: beside a fixed multiple of the slice (or of a longer text), memory
is the vectors of one chunk. The prototypes are learned from a bounded sample: of the
training rows of each language at most about ``SAMPLE`` are used, those with the
smallest hash of their id. Their sums are added up in Spark; what reaches the
driver is one vector per language (at most ``MAX_LANGUAGES``).

Defined results: null texts and texts without a letter are ``und`` with score 0,
as is every text if there is no training row; rows with a null ``doc_id`` are
never training rows and are not held out; languages of one score: the first by name;
repeated rows are rows of their own; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from markforge.llm.common import keyed
from markforge.llm.words import mix64, slices

DIMENSIONS = 512
N = 3
SAMPLE = 2_000
MAX_LANGUAGES = 2_000
SLICE = 256 << 10
CHUNK = 16_384  # distinct n-grams bundled at a time


class Profiles:
    """Bundled n-gram vectors of the texts of a slice."""

    def __init__(self, dimensions: int, n: int):
        self.dimensions, self.n = dimensions, n
        self.letter = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)

    def vectors(self, codes):
        """One vector of +1 and -1 per code point; 0, the gap, has one too."""
        bits = codes.astype(np.uint64)[:, None] * np.uint64(self.dimensions // 64) + np.arange(
            self.dimensions // 64, dtype=np.uint64)
        raw = mix64((bits + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)).view(np.uint8)
        signs = np.unpackbits(raw.reshape(len(codes), -1), axis=1).view(np.int8)
        signs *= 2
        signs -= 1
        return signs

    def bundle(self, texts):
        """``(bundles, has a letter)`` of a list of strings."""
        texts = [(t or "").lower() for t in texts]
        points = np.frombuffer(" ".join(["", *texts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
        ends = np.cumsum([len(t) + 1 for t in texts])
        codes = np.where(self.letter[points], points, 0)
        doc = np.searchsorted(ends, np.arange(len(codes)) - 1, "right")
        doc = np.minimum(doc, len(texts) - 1)
        has = np.bincount(doc[codes > 0], minlength=len(texts)) > 0
        keep = np.ones(len(codes), bool)
        keep[1:] = (codes[1:] > 0) | (codes[:-1] > 0)  # a gap counts once
        codes, doc = codes[keep], doc[keep]
        alphabet, number = np.unique(codes, return_inverse=True)
        if len(codes) < self.n:
            return np.zeros((len(texts), self.dimensions), np.float32), has
        gram = np.zeros(len(codes) - self.n + 1, np.int64)
        for i in range(self.n):
            gram = gram * len(alphabet) + number[i:len(codes) - self.n + 1 + i]
        middle = doc[self.n // 2:len(codes) - self.n + 1 + self.n // 2]
        if len(alphabet) ** self.n <= 1 << 22:  # number the n-grams by a table
            used = np.flatnonzero(np.bincount(gram, minlength=len(alphabet) ** self.n))
            at = np.zeros(len(alphabet) ** self.n, np.int32)
            at[used] = np.arange(len(used))
            gram = at[gram]
        else:
            used, gram = np.unique(gram, return_inverse=True)
        letters = self.vectors(alphabet)
        rolled = [np.roll(letters, self.n - 1 - i, axis=1) for i in range(self.n)]
        bundles = np.zeros((len(texts), self.dimensions), np.float32)
        for low in range(0, len(used), CHUNK):
            some = used[low:low + CHUNK]
            bound = np.ones((len(some), self.dimensions), np.int8)
            for i in range(self.n):
                bound *= rolled[i][some // len(alphabet) ** (self.n - 1 - i) % len(alphabet)]
            here = (gram >= low) & (gram < low + CHUNK) if len(used) > CHUNK else slice(None)
            counts = np.bincount(middle[here].astype(np.int64) * len(some) + (gram[here] - low), minlength=len(texts) * len(some))
            bundles += counts.reshape(len(texts), len(some)).astype(np.float32) @ bound.astype(np.float32)
        return bundles * has[:, None], has


def _pieces(batches):
    """Slices of at most SLICE bytes, and of few rows if the texts are short."""
    for part, _, _ in slices(batches, size=SLICE):
        for at in range(0, part.num_rows, 256):
            yield part.slice(at, 256)


def _learn(dimensions: int, n: int):
    def run(batches):
        profiles, sums = Profiles(dimensions, n), {}
        for part in _pieces(batches):
            bundles, has = profiles.bundle(part.column(1).to_pylist())
            length = np.linalg.norm(bundles, axis=1)
            unit = bundles / np.where(length > 0, length, 1)[:, None]
            for i, lang in enumerate(part.column(0).to_pylist()):
                if has[i]:
                    sums.setdefault(lang, np.zeros(dimensions))[:] += unit[i]
        if sums:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(sums), pa.string()), pa.array([v.tolist() for v in sums.values()], pa.list_(pa.float64()))],
                ["lang", "bundle"])

    return run


def prototypes(rows: DataFrame, dimensions: int = DIMENSIONS, n: int = N, sample: int = SAMPLE):
    """``(languages, unit prototypes, mean)`` from training rows ``lang, text, doc_id``."""
    rows = rows.filter("lang is not null and doc_id is not null")
    per_lang = rows.groupBy("lang").count().limit(MAX_LANGUAGES + 1).collect()
    if len(per_lang) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not per_lang:
        return [], np.zeros((0, dimensions)), np.zeros(dimensions)
    # keep the smallest hashes of each language: a share that gives about `sample` rows
    share = F.create_map(*(x for r in per_lang for x in (F.lit(r["lang"]), F.lit(min(1.0, sample / r["count"])))))
    picked = rows.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < share[F.col("lang")] * float(1 << 30))
    sums = picked.select("lang", "text").mapInArrow(_learn(dimensions, n), "lang string, bundle array<double>")
    sums = sums.select("lang", F.posexplode("bundle").alias("i", "x")).groupBy("lang", "i").agg(F.sum("x").alias("x"))
    table: dict[str, np.ndarray] = {}
    for r in sums.toLocalIterator():
        table.setdefault(r.lang, np.zeros(dimensions))[r.i] = r.x
    languages = sorted(table)
    made = np.array([table[x] / max(np.linalg.norm(table[x]), 1e-12) for x in languages]).reshape(-1, dimensions)
    mean = made.mean(axis=0) if len(languages) > 1 else np.zeros(dimensions)
    made = np.round(made - mean, 9)  # the same whatever the order of the sums
    return languages, made / np.maximum(np.linalg.norm(made, axis=1, keepdims=True), 1e-12), np.round(mean, 9)


def _predict(languages, made, mean, dimensions: int, n: int):
    def run(batches):
        profiles = Profiles(dimensions, n)
        for part in _pieces(batches):
            bundles, has = profiles.bundle(part.column(1).to_pylist())
            length = np.linalg.norm(bundles, axis=1)
            unit = bundles / np.where(length > 0, length, 1)[:, None] - mean
            length = np.linalg.norm(unit, axis=1)
            if languages:
                cosine = unit @ made.T / np.where(length > 0, length, 1)[:, None]
                best = cosine.argmax(axis=1)
                top = np.clip(cosine[np.arange(len(best)), best], 0, 1)
                name = [languages[b] if h else "und" for b, h in zip(best, has)]
            else:
                top, name = np.zeros(part.num_rows), ["und"] * part.num_rows
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(2), pa.array(name, pa.string()), pa.array(np.where(has, top, 0.0), pa.float64())],
                ["doc_id", "row_key", "lang_pred", "score"])

    return run


def language_id(docs: DataFrame, train: DataFrame, dimensions: int = DIMENSIONS, n: int = N,
                sample: int = SAMPLE) -> DataFrame:
    """``doc_id, row_key, lang_pred, score`` for every row of ``docs`` (``doc_id, text``)
    by prototypes learned from ``train`` (``doc_id, lang, text``)."""
    learned = prototypes(train.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"),
                                      F.col("doc_id")), dimensions, n, sample)
    return keyed(docs).mapInArrow(_predict(*learned, dimensions, n),
                                  "doc_id long, row_key long, lang_pred string, score double")


def held_out(doc_id="doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    found = language_id(docs, docs.filter(~held_out()))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
