"""License scans by diagonal voting.

One Arrow pass hashes the words of every text and hands
every rolling k-gram hash to Spark (templates of fewer words are one gram, of their own length), which joins them to the template positions
(a broadcast: the templates are a parameter of bounded size). Hits are counted
per document, template and diagonal (place in the text minus place in the
template). Neighbouring diagonals of a document are merged, so a match survives
inserted or missing words, and each merged span is verified by aligning its
words with the template's. Of overlapping spans one that explains as many words and fits better stands for
the other; a span of a label that overlaps a better one of the same label is the same match.

Defined results: null and empty texts have no words and no labels (empty
strings, score 0); repeated rows are reported each; a null ``doc_id`` is a row
like any other; other columns are not read.
"""

from __future__ import annotations

from difflib import SequenceMatcher

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from markforge.llm.common import by_key, checked_broadcast, keyed, staged
from markforge.llm.licences import LICENCES, SPDX
from markforge.llm.words import NOT_ALNUM, Words, document_of, slices, sums

K = 5
TEMPLATE_CHARS = 4 << 20  # templates of at most so many characters are broadcast
MIN_SHARE = 0.85  # words in order that template and verified span share, of the longer of the two
NEAR = 4  # diagonals this close belong to one match; less for short templates, so that repeats stay apart

# Phrases that the base rule looks for, and their labels.
BASE_PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Licence bodies and notices, and the identifier lines that files carry.
TEMPLATES = {**LICENCES, **{f"spdx:{name.lower()}": f"SPDX-License-Identifier: {name}" for name in SPDX}}


def _words() -> Words:
    return Words(NOT_ALNUM, lower=True)


def _hashes_of(words: Words, text: str):
    buf = np.frombuffer(text.encode(), np.uint8)
    return words.hashes(buf, *words.split(buf, np.array([0, len(buf)]))[:2])


def template_grams(spark: SparkSession, templates: dict[str, str], k: int) -> DataFrame:
    """``(gram, label, at)``: the places of every k-gram hash of the templates; one gram of a shorter template."""
    words, rows = _words(), []
    for label, text in templates.items():
        h = _hashes_of(words, text)
        n = min(k, len(h))
        start = np.arange(len(h) - n + 1 if n else 0)
        rows += [(int(g), label, int(i)) for i, g in zip(start, words.spans(h, start, start + n).view(np.int64))]
    return spark.createDataFrame(rows, "gram long, label string, at int")


def gram_lengths(templates: dict[str, str], k: int) -> list[int]:
    """The lengths of the templates' grams."""
    words = _words()
    return sorted({min(k, len(_hashes_of(words, text))) for text in templates.values()} - {0})


def _grams(lengths: list[int]):
    def run(batches):
        words = _words()
        for part, buf, offsets in slices(batches):
            starts, ends, first = words.split(buf, offsets)
            h = words.hashes(buf, starts, ends)
            start, grams = (np.concatenate(x) for x in zip(*(words.windows(h, first, n) for n in lengths)))
            order = np.argsort(start, kind="stable")
            start, grams = start[order], grams[order]
            bounds = pa.array(np.searchsorted(start, first), pa.int32())
            place = start - first[document_of(first, start)]
            pairs = pa.StructArray.from_arrays([pa.array(place, pa.int32()), pa.array(grams.view(np.int64))], ["place", "gram"])
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.ListArray.from_arrays(bounds, pairs)],
                                             ["doc_id", "row_key", "grams"])

    return run


def _base(h, first, wanted):
    """Per document: places of the phrases, the smallest and largest, labels."""
    n, docs = len(h), len(first) - 1
    places, labels = np.zeros(n, np.int64), [set() for _ in range(docs)]
    for phrase, label in wanted:
        at = np.arange(max(n - len(phrase) + 1, 0))
        for i, x in enumerate(phrase):
            at = at[h[at + i] == x]
        at = at[at + len(phrase) <= first[document_of(first, at) + 1]]
        places[at] += 1
        for d in np.unique(document_of(first, at)):
            labels[d].add(label)
    at = np.flatnonzero(places)
    low, high = [None] * docs, [None] * docs
    for p, d in zip(at.tolist(), document_of(first, at).tolist()):
        low[d] = p - int(first[d]) if low[d] is None else low[d]
        high[d] = p - int(first[d])
    return sums(places, first), low, high, labels


def _spans(text, hits, known, k, min_share, near):
    """Merge neighbouring diagonals of each template and align what they span."""
    by_label, spans = {}, {}
    for x in hits or ():
        by_label.setdefault(x["label"], []).append((x["low"], x["high"], x["diagonal"], x["diagonal"]))
    for label, diagonals in by_label.items():
        template, runs = known[label], []
        reach = min(near, (len(template) - 1) // 2)
        for low, high, d, _ in sorted(diagonals):
            if runs and abs(d - runs[-1][3]) <= reach and low <= runs[-1][1] + reach + k:
                runs[-1] = (runs[-1][0], max(high, runs[-1][1]), min(d, runs[-1][2]), d)
            else:
                runs.append((low, high, d, d))
        for low, high, d0, d in runs:
            a = max(min(low, d, d0) - reach, 0)
            b = max(high + k, d + len(template)) + reach
            match = SequenceMatcher(None, template, text[a:b].tolist(), autojunk=False)
            blocks = [x for x in match.get_matching_blocks() if x.size]
            found = sum(x.size for x in blocks)
            start, end = (a + blocks[0].b, a + blocks[-1].b + blocks[-1].size) if found else (0, 0)
            share = found / max(len(template), end - start)
            if share >= min_share:
                spans[label, start, end, share] = found
    return sorted(x for x, n in spans.items() if not any(_stands_for(y, m, x, n) for y, m in spans.items()))


def _stands_for(y, m, x, n) -> bool:
    """Whether span ``y`` (of ``m`` matched words) takes the place of span ``x`` (of ``n``), which it overlaps."""
    if y[1] >= x[2] or x[1] >= y[2]:
        return False
    if x[0] == y[0]:
        return (m, -y[1], -y[2]) > (n, -x[1], -x[2])
    return m >= n and y[3] > x[3]


_SCANNED = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
            "labels string, score double, spans array<struct<label:string,start:long,end:long,share:double>>")


def _verify(templates: dict[str, str], phrases: dict[str, str], k: int, min_share: float, near: int):
    def run(batches):
        words = _words()
        known = {label: _hashes_of(words, t).tolist() for label, t in templates.items()}
        wanted = [(_hashes_of(words, phrase), label) for phrase, label in phrases.items()]
        kind = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                                   ("share", pa.float64())]))
        for part, buf, offsets in slices(batches):
            starts, ends, first = words.split(buf, offsets)
            h = words.hashes(buf, starts, ends)
            n_base, low, high, base = _base(h, first, wanted)
            spans = [_spans(h[first[i]:first[i + 1]], hits, known, k, min_share, near) if hits else []
                     for i, hits in enumerate(part.column(1).to_pylist())]
            labels = [",".join(sorted(b | {s[0] for s in x})) for b, x in zip(base, spans)]
            score = [1.0 if b else max([0.0, *(s[3] for s in x)]) for b, x in zip(base, spans)]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(np.diff(first), pa.int64()), pa.array(n_base, pa.int64()),
                 pa.array(low, pa.int64()), pa.array(high, pa.int64()),
                 pa.array([",".join(sorted(b)) for b in base], pa.string()), pa.array(labels, pa.string()),
                 pa.array(score, pa.float64()),
                 pa.array([[dict(zip(("label", "start", "end", "share"), s)) for s in x] for x in spans], kind)],
                ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"])

    return run


def license_scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES, phrases: dict[str, str] = BASE_PHRASES,
                 k: int = K, min_share: float = MIN_SHARE, near: int = NEAR) -> DataFrame:
    """Per document: word count, base places, labels, score and verified
    ``spans`` (label, first word, end, share of the template or of the span, whichever is longer)."""
    rows = keyed(docs)
    lengths = gram_lengths(templates, k)
    grams = rows.select("doc_id", "text", "row_key").mapInArrow(
        _grams(lengths), "doc_id long, row_key long, grams array<struct<place:int,gram:long>>")
    places = grams.select("doc_id", "row_key", F.inline("grams"))
    at = template_grams(docs.sparkSession, templates, k)
    hits = places.join(F.broadcast(at) if sum(map(len, templates.values())) <= TEMPLATE_CHARS else at, "gram")
    hits = hits.select("doc_id", "row_key", "label", (F.col("place") - F.col("at")).alias("diagonal"), "place")
    votes = (hits.distinct().groupBy("doc_id", "row_key", "label", "diagonal")
             .agg(F.count("*").alias("votes"), F.min("place").alias("low"), F.max("place").alias("high"))
             .groupBy("doc_id", "row_key")
             .agg(F.collect_list(F.struct("label", "diagonal", "low", "high", "votes")).alias("hits")))
    side = checked_broadcast(staged(votes, "op8-votes"), F.size("hits") * 60)
    return by_key(rows, side).select("doc_id", "hits", "text").mapInArrow(
        _verify(templates, phrases, k, min_share, near), _SCANNED)


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
