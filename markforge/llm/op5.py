"""Benchmark decontamination with a generalised suffix automaton.

The benchmark is read in blocks of bounded text (``BLOCK_BYTES``); each block is
broadcast and turned into one generalised suffix automaton over word numbers in
every task. Documents stream past: a run of words whose neighbouring pairs all
occur in the block is fed to the automaton, which tracks the longest match that
ends at each word; a break in the pairs bounds any match, so the rest of the
text needs no automaton step. Where the match reaches a window's length, the
state of that length gives the items that hold the window. With more than one
block, hit intervals of a document are united over the blocks.

A window is ``width`` consecutive words of an item; a shorter item is one
window. Words inside any occurrence are hit. A document is contaminated if
``n_hit > 0`` and ``100 * n_hit >= min_percent * n_words``. ``remove_spans`` takes the hit
spans that exceed a length or coverage limit out of the texts.

Defined results: null or empty texts have no words; items without words and
items with a null id have no windows; repeated items count once; an empty
benchmark hits nothing; repeated documents are reported each.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from markforge.llm.common import by_key, keyed, staged
from markforge.llm.words import NOT_ALNUM, Words, slices

WIDTH = 13
MIN_PERCENT = 5
BLANKS = (b" ", b"\t", b"")  # or an end of the text
BLOCK_BYTES = 1 << 20


class Automaton:
    """Generalised suffix automaton of integer sequences, with the items that
    hold a state's strings and the short items that end in it."""

    def __init__(self, items: list[tuple[str, list[int]]], width: int):
        self.next, self.link, self.length = [{}], [-1], [0]
        holds = [set()]
        ends = []
        for name, (item, sequence) in enumerate(items):
            last = 0
            for word in sequence:
                last = self._extend(last, word)
                while len(holds) < len(self.length):
                    holds.append(set())
                holds[last].add(name)
            ends.append(last)
        # a state's items are also items of the states it links to
        for state in sorted(range(1, len(self.length)), key=self.length.__getitem__, reverse=True):
            holds[self.link[state]] |= holds[state]
        self.items = [frozenset(items[i][0] for i in h) if n >= width else None for h, n in zip(holds, self.length)]
        # whole short items, found from a state over its suffix links
        self.short: dict[int, set] = {}
        for (item, sequence), state in zip(items, ends):
            if sequence and len(sequence) < width:
                for s in self._up(state):
                    if self.length[self.link[s]] < len(sequence) <= self.length[s]:
                        self.short.setdefault(s, set()).add((len(sequence), item))
        self.shorter = [-1] * len(self.length)  # nearest state upwards with a short item, itself included
        for s in sorted(range(len(self.length)), key=self.length.__getitem__):
            self.shorter[s] = s if s in self.short else (self.shorter[self.link[s]] if s else -1)
        self.width = width

    def _up(self, state):
        while state > 0:
            yield state
            state = self.link[state]

    def _new(self, length, link, edges):
        self.next.append(edges)
        self.link.append(link)
        self.length.append(length)
        return len(self.length) - 1

    def _split(self, state, word, target):
        """The state of the string of ``state`` plus ``word``, split off ``target`` if that is longer."""
        if self.length[target] == self.length[state] + 1:
            return target
        part = self._new(self.length[state] + 1, self.link[target], dict(self.next[target]))
        self.link[target] = part
        while state >= 0 and self.next[state].get(word) == target:
            self.next[state][word] = part
            state = self.link[state]
        return part

    def _extend(self, last, word):
        if word in self.next[last]:
            return self._split(last, word, self.next[last][word])
        state = self._new(self.length[last] + 1, 0, {})
        while last >= 0 and word not in self.next[last]:
            self.next[last][word] = state
            last = self.link[last]
        if last >= 0:
            self.link[state] = self._split(last, word, self.next[last][word])
        return state

    def hits(self, sequence):
        """``(start, end, items)`` of windows that occur in a sequence."""
        state, match = 0, 0
        for at, word in enumerate(sequence):
            while state and word not in self.next[state]:
                state = self.link[state]
                match = self.length[state]
            if word in self.next[state]:
                state, match = self.next[state][word], match + 1
            if match >= self.width:
                window = state
                while self.length[self.link[window]] >= self.width:
                    window = self.link[window]
                yield at + 1 - self.width, at + 1, self.items[window]
            s = self.shorter[state]
            while s > 0:
                for n, item in self.short[s]:
                    if n <= match:
                        yield at + 1 - n, at + 1, (item,)
                s = self.shorter[self.link[s]]


def _match(items, width: int, keep_text: bool = False):
    """Arrow pass over documents for one block of ``(item id, text)``."""

    def run(batches):
        words = Words(NOT_ALNUM, lower=True)
        hashed = []
        for name, text in items.value:
            buf = np.frombuffer(text.encode(), np.uint8)
            hashed.append((name, words.hashes(buf, *words.split(buf, np.array([0, len(buf)]))[:2])))
        hashed = [(name, h) for name, h in hashed if len(h)]
        vocabulary = np.unique(np.concatenate([h for _, h in hashed])) if hashed else np.zeros(0, np.uint64)
        size = len(vocabulary)
        numbered = [(name, np.searchsorted(vocabulary, h)) for name, h in hashed]
        pairs = np.unique(np.concatenate([s[:-1] * size + s[1:] for _, s in numbered] or [np.zeros(0, np.int64)]))
        singles = np.zeros(size + 1, bool)  # words that are an item of their own
        for _, s in numbered:
            if len(s) == 1:
                singles[s] = True
        least = min([width, *(len(s) for _, s in numbered)])
        automaton = Automaton([(name, s.tolist()) for name, s in numbered], width)
        for part, buf, offsets in slices(batches):
            starts, ends, first = words.split(buf, offsets)
            h = words.hashes(buf, starts, ends)
            at = np.searchsorted(vocabulary, h)
            number = np.where((at < size) & (vocabulary[np.minimum(at, size - 1)] == h), at, size) if size else \
                np.full(len(h), size)
            linked = np.zeros(len(h) + 1, bool)  # word i and the one before occur side by side in the block
            if len(pairs) and len(h) > 1:
                code = np.where((number[:-1] < size) & (number[1:] < size), number[:-1] * size + number[1:], -1)
                pos = np.minimum(np.searchsorted(pairs, code), len(pairs) - 1)
                linked[1:-1] = pairs[pos] == code
                linked[first[first < len(h)]] = False
            # runs of linked words: [a, b)
            edge = np.diff(np.concatenate(([0], linked[1:].astype(np.int8), [0])))
            a, b = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) + 1
            long = b - a >= least
            runs = list(zip(a[long].tolist(), b[long].tolist()))
            if singles.any():
                alone = np.flatnonzero(singles[number])
                inside = np.searchsorted(a, alone, "right") - 1
                free = (inside < 0) | (alone >= b[np.maximum(inside, 0)]) if len(a) else np.ones(len(alone), bool)
                runs += [(i, i + 1) for i in alone[free].tolist()]
            spans, found = [[] for _ in range(part.num_rows)], [set() for _ in range(part.num_rows)]
            docs = (np.searchsorted(first, [r[0] for r in runs], "right") - 1).tolist() if runs else []
            for (s, e), d in sorted(zip(runs, docs)):
                base = s - int(first[d])
                for x, y, names in automaton.hits(number[s:e].tolist()):
                    if spans[d] and spans[d][-1][1] >= base + x >= spans[d][-1][0]:
                        spans[d][-1][1] = max(spans[d][-1][1], base + y)
                    else:
                        spans[d].append([base + x, base + y])
                    found[d].update(names)
            columns = {"doc_id": part.column(0), "row_key": part.column(2), "n_words": pa.array(np.diff(first), pa.int64()),
                       "spans": pa.array(spans, pa.list_(pa.list_(pa.int64()))),
                       "items": pa.array([sorted(f) for f in found], pa.list_(pa.string()))}
            if keep_text:
                columns["text"] = part.column(1)
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return run


def _blocks(items: DataFrame, limit: int):
    """The benchmark in blocks of about ``limit`` bytes, one at a time on the driver."""
    total = items.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    n = max(1, -(-total // limit))
    for b in range(n):
        yield [(r.item, r.text) for r in items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == b).collect()]


def _merged(spans):
    """Sorted spans united where they touch."""
    start = F.transform("spans", lambda s: F.struct(s[0].alias("a"), s[1].alias("b")))
    grown = F.aggregate(
        F.array_sort(start), F.expr("cast(array() as array<struct<a:bigint,b:bigint>>)"),
        lambda acc, x: F.when((F.size(acc) > 0) & (F.element_at(acc, -1)["b"] >= x["a"]), F.concat(
            F.slice(acc, F.lit(1), F.size(acc) - 1),
            F.array(F.struct(F.element_at(acc, -1)["a"].alias("a"),
                             F.greatest(F.element_at(acc, -1)["b"], x["b"]).alias("b")))))
        .otherwise(F.concat(acc, F.array(x))))
    return F.transform(grown, lambda s: F.array(s["a"], s["b"]))


def benchmark_hits(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, min_percent: int = MIN_PERCENT,
                   block_bytes: int = BLOCK_BYTES, item_col: str = "item_id", keep_text: bool = False) -> DataFrame:
    """Per document: ``doc_id, row_key, n_words, spans`` (united hit intervals of
    words)``, items`` (ids as strings, sorted)``, n_hit, contaminated``; with ``keep_text`` its ``text`` as well."""
    sc = docs.sparkSession.sparkContext
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col("text").cast("string").alias("text"))
    items = items.filter("item is not null and text is not null").distinct()
    rows = keyed(docs).select("doc_id", "text", "row_key")
    schema = "doc_id long, row_key long, n_words long, spans array<array<long>>, items array<string>"
    parts = [rows.mapInArrow(_match(sc.broadcast(block), width, keep_text and not i), schema + ", text string" * (keep_text and not i))
             for i, block in enumerate(_blocks(items, block_bytes))]
    found, text = parts[0], ["text"] if keep_text else []
    if len(parts) > 1:
        parts[0] = staged(parts[0], "op5-first-block")
        found = parts[0].drop("text")
        some = [p.filter("size(items) > 0") for p in parts[1:]]
        for p in some:
            found = found.union(p)
        merged = (found.filter("size(items) > 0").groupBy("doc_id", "row_key")
                  .agg(F.flatten(F.collect_set("spans")).alias("spans"),
                       F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items")))
        merged = staged(merged, "op5-blocks")
        found = by_key(parts[0].drop("spans", "items"), merged).select(
            "doc_id", "row_key", "n_words", F.coalesce("spans", F.expr("cast(array() as array<array<bigint>>)")).alias("spans"),
            F.coalesce("items", F.expr("cast(array() as array<string>)")).alias("items"), *text)
    found = found.withColumn("spans", F.when(F.size("spans") > 1, _merged("spans")).otherwise(F.col("spans")))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda acc, s: acc + s[1] - s[0])
    return found.withColumn("n_hit", n_hit).withColumn(
        "contaminated", (F.col("n_hit") > 0) & (100 * F.col("n_hit") >= min_percent * F.col("n_words")))


def _without(words: Words, text: str, spans) -> str:
    """``text`` without the words of sorted, separate ``spans`` and what stands between them."""
    raw = text.encode()
    buf = np.frombuffer(raw, np.uint8)
    starts, ends, _ = words.split(buf, np.array([0, len(buf)]))
    parts, at = [], 0
    for a, b in spans:
        parts.append(raw[at:starts[a]])
        at = int(ends[b - 1])
        if (not parts[-1] or parts[-1][-1:] in BLANKS) and raw[at:at + 1] in BLANKS:
            at += len(raw[at:at + 1])  # two blanks would meet
    return b"".join([*parts, raw[at:]]).decode()


def _cut(text, spans):
    @F.pandas_udf("string")
    def run(texts: pd.Series, spans: pd.Series) -> pd.Series:
        words = Words(NOT_ALNUM, lower=True)
        return pd.Series([None if t is None else _without(words, t, s) for t, s in zip(texts, spans)], dtype=object)

    return run(text, spans)


def remove_spans(hits: DataFrame, max_words: int = WIDTH, max_percent: float = MIN_PERCENT) -> DataFrame:
    """``hits`` (with ``text``) plus ``removed`` (spans), ``n_removed`` (words) and ``kept_text``.

    A span is removed if it has more than ``max_words`` words; every span is, if the hits cover ``max_percent`` percent of
    the document's words or more. A span goes from the first byte of its first word to the last of its last;
    all else stays as it is (punctuation, lines), but for one of two blanks that would meet. Texts without such spans,
    null and empty ones too, stay as they are."""
    covered = 100 * F.col("n_hit") >= max_percent * F.col("n_words")
    rows = hits.withColumn("removed", F.filter("spans", lambda s: covered | (s[1] - s[0] > max_words)))
    some = F.size("removed") > 0
    kept = F.when(some, _cut(F.when(some, F.col("text")), F.when(some, F.col("removed")))).otherwise(F.col("text"))
    n_removed = F.aggregate("removed", F.lit(0).cast("long"), lambda acc, s: acc + s[1] - s[0])
    return rows.withColumn("n_removed", n_removed).withColumn("kept_text", kept)


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = benchmark_hits(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"),
                          keep_text=True)
    return remove_spans(hits).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated", "n_removed",
        F.sha2(F.coalesce("kept_text", F.lit("")), 256).alias("kept_sha256"))
