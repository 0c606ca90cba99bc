"""Cross-tokenizer alignment: galloping intersection of token end offsets.

Each text is encoded by a byte-level BPE (A, with a blank before the text) and by a
SentencePiece BPE (B, which adds that blank itself). The ends of the tokens' byte ranges
are two sorted lists. In every document the shorter list drives: each of its ends
looks itself up in the longer list from a proportional first guess, in steps of doubling
size and then by halving, all ends of a slice in lockstep on NumPy arrays. Ends found in both lists
cut the tokens into groups; the difference of two neighbouring ranks is the range of
tokens that a token overlaps.

A link is a pair of tokens that end together. The links of a document leave as distinct
id pairs with their number; Spark sums them over the corpus and takes each B id's
highest count. Counts go back to the documents by a broadcast of at most ``MAX_PAIRS``
pairs, the most frequent ones; pairs beyond that, each less than one in ``MAX_PAIRS`` of all
links, are joined by a shuffle. Both ways are exact.

Defined results: texts that are null, empty or whose A or B tokens do not spell
blank + text have no tokens, no groups and an empty ``groups_sha256``; special tokens'
strings are plain text; repeated rows are aligned and counted each; an empty table gives an
empty table; other columns of the input are ignored, whatever their names; a long text is
a slice of its own.
"""

from __future__ import annotations

import hashlib
import json
import os
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from markforge.llm.common import keyed, staged
from markforge.llm.op12 import MODEL, ranges, read_model, vocabulary
from markforge.llm.words import slices, sums

BYTE_MODEL = "byte_bpe_50k.json"
MAX_PAIRS = 1 << 20
CACHED = 1 << 18, 1 << 25  # distinct words whose ids a Python worker keeps, and characters of them

# Fixed value: where byte-level pre-tokenizers cut a text into words.
WORD = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary: visible Latin-1
    characters for themselves, the others in order from U+0100 on."""
    seen = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(seen)]
    return {chr(b): b for b in seen} | {chr(0x100 + i): b for i, b in enumerate(hidden)}


class ByteTokens:
    """A byte-level BPE with the bytes of its entries.

    Merges stay inside the words that the pre-tokenizer cuts, so a word is encoded by the library
    once and its ids are kept for later texts. The words are cut here by the same pattern; each
    new character is tried in both, and texts with one that the two see differently (their
    Unicode tables differ) are encoded whole, as with a model of other rules."""

    def __init__(self, model: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task, one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(model.decode("utf-8"))
        self.tokenizer.encode_special_tokens = True
        byte = byte_alphabet()
        entries = self.tokenizer.get_vocab(with_added_tokens=True)
        self.size = max(entries.values(), default=-1) + 1
        spelled = [b""] * self.size
        for entry, i in entries.items():
            spelled[i] = bytes(byte[c] for c in entry) if all(c in byte for c in entry) else entry.encode("utf-8")
        self.surface = np.frombuffer(b"".join(spelled), np.uint8)
        self.width = np.array([len(s) for s in spelled], np.int64)
        self.offset = np.cumsum(self.width) - self.width

        rules = json.loads(model)
        cut = rules.get("pre_tokenizer") or {}
        self.by_word = (rules.get("normalizer") is None and cut.get("type") == "ByteLevel" and cut.get("use_regex")
                        and not cut.get("add_prefix_space") and not rules["model"].get("dropout"))
        self.word = regex.compile(WORD)
        self.tried, self.differ = set(), set()
        self._forget()

    def _forget(self) -> None:
        self.number: dict[str, int] = {}
        self.held = 0
        self.flat, self.counts = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        counts = np.array([len(x) for x in found], np.int64)
        return np.fromiter(chain.from_iterable(found), np.int64, counts.sum()), counts

    def _try(self, chars: set[str]) -> None:
        for c in chars - self.tried:
            text = f"a{c}a1{c}1!{c}!{c} {c}"  # tells letters, numbers, blanks and others apart
            if [m.span() for m in self.word.finditer(text)] != [span for _, span in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)]:
                self.differ.add(c)
        self.tried |= chars

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts: flat, and the number of each text."""
        if not self.by_word:
            return self._ids(texts)
        chars = set("".join(texts))
        self._try(chars)
        odd = chars & self.differ
        words, sizes = [], []
        for text in texts:
            # a whole text stands as one word
            found = [text] if odd and not odd.isdisjoint(text) else self.word.findall(text)
            words += found
            sizes.append(len(found))
        if len(self.number) > CACHED[0] or self.held > CACHED[1]:
            self._forget()
        new = list(set(words) - self.number.keys())
        if new:
            ids, counts = self._ids(new)
            self.held += sum(map(len, new))
            self.number.update(zip(new, range(len(self.counts), len(self.counts) + len(new))))
            self.flat, self.counts = np.concatenate([self.flat, ids]), np.concatenate([self.counts, counts])
        of = np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))
        n = self.counts[of]
        return (self.flat[ranges((np.cumsum(self.counts) - self.counts)[of], n)],
                sums(n, np.concatenate(([0], np.cumsum(np.array(sizes, np.int64))))))


def spelled(table, ids: np.ndarray) -> np.ndarray:
    """The bytes of the tokens, one after another."""
    return table.surface[ranges(table.offset[ids], table.width[ids])]


def gallop(driver: np.ndarray, longer: np.ndarray, first: np.ndarray, last: np.ndarray, guess: np.ndarray) -> np.ndarray:
    """For each value of ``driver``, the index of the first value of ``longer`` that is not
    smaller, looked for in [first, last] around ``guess``; ``longer[last]`` must not be smaller."""
    low, high = guess.copy(), guess.copy()
    right = longer[guess] < driver
    # invariant in the end: longer[low] < driver <= longer[high], where low may be first - 1
    at, step = np.flatnonzero(right), 1
    high[at] = np.minimum(high[at] + 1, last[at])
    while len(at):
        at = at[longer[high[at]] < driver[at]]
        step *= 2
        low[at] = high[at]
        high[at] = np.minimum(high[at] + step, last[at])
    at, step = np.flatnonzero(~right), 1
    low[at] -= 1
    at = at[low[at] >= first[at]]
    while len(at):
        at = at[longer[low[at]] >= driver[at]]
        step *= 2
        high[at] = low[at]
        low[at] = np.maximum(low[at] - step, first[at] - 1)
        at = at[low[at] >= first[at]]
    at = np.flatnonzero(high - low > 1)
    while len(at):
        mid = (low[at] + high[at]) >> 1
        under = longer[mid] < driver[at]
        low[at[under]] = mid[under]
        high[at[~under]] = mid[~under]
        at = at[high[at] - low[at] > 1]
    return high


def place(ends_a, first_a, ends_b, first_b) -> tuple[np.ndarray, np.ndarray]:
    """Ranks of A's ends in B and of B's ends in A (-1 where the list did not drive): the index of
    the first end that is not smaller. Lists are cut into documents at ``first_*``."""
    found = []
    n_a, n_b = np.diff(first_a), np.diff(first_b)
    for (ends, first, n), (others, first_o, n_o), drives in (
            ((ends_a, first_a, n_a), (ends_b, first_b, n_b), n_a <= n_b),
            ((ends_b, first_b, n_b), (ends_a, first_a, n_a), n_a > n_b)):
        of = np.repeat(np.arange(len(n)), n)
        mine = np.flatnonzero(drives[of])
        of = of[mine]
        low, size = first_o[of], n_o[of]
        guess = low + (mine - first[of]) * size // np.maximum(n[of], 1)
        rank = np.full(len(ends), -1)
        rank[mine] = gallop(ends[mine], others, low, low + size - 1, guess)
        found.append(rank)
    return found[0], found[1]


class Alignment:
    """Aligned tokens of a slice of documents."""

    def __init__(self, a, ids_a, counts_a, b, ids_b, counts_b):
        self.ids_a, self.ids_b, self.n_a, self.n_b = ids_a, ids_b, counts_a, counts_b
        self.first_a, self.first_b = (np.concatenate(([0], np.cumsum(n))) for n in (counts_a, counts_b))
        ends_a, ends_b = np.cumsum(a.width[ids_a]), np.cumsum(b.width[ids_b])
        self.rank_a, self.rank_b = place(ends_a, self.first_a, ends_b, self.first_b)
        # ends that both lists hold, as indexes into A and into B
        from_a = np.flatnonzero(self.rank_a >= 0)
        from_a = from_a[ends_b[self.rank_a[from_a]] == ends_a[from_a]]
        from_b = np.flatnonzero(self.rank_b >= 0)
        from_b = from_b[ends_a[self.rank_b[from_b]] == ends_b[from_b]]
        self.cut_a = np.sort(np.concatenate([from_a, self.rank_b[from_b]]))
        self.cut_b = np.sort(np.concatenate([self.rank_a[from_a], from_b]))
        self.bounds = np.searchsorted(self.cut_a, self.first_a)  # of the cuts, by document

    def overlaps(self) -> tuple[np.ndarray, np.ndarray]:
        """First and last B token (in the slice) that each A token overlaps: where A
        drove, from the rank of its predecessor's end to its own; where B drove, from the number of
        ends that its ranks put before each A token."""
        met = np.zeros(len(self.ids_a), np.int64)
        met[self.cut_a] = 1
        last = self.rank_a.copy()
        upto = np.cumsum(np.bincount(self.rank_b[self.rank_b >= 0], minlength=len(self.ids_a)))
        of = np.repeat(np.arange(len(self.n_a)), self.n_a)
        # B tokens of documents in which A drove are not counted by the ranks of B
        skipped = np.concatenate(([0], np.cumsum(np.where(self.n_a <= self.n_b, self.n_b, 0))))
        own = np.flatnonzero(last < 0)
        last[own] = upto[own] + skipped[of[own]] - met[own]
        first = np.concatenate(([0], last[:-1] + met[:-1]))[:len(last)]
        return first, last

    def spelling(self, digits: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The groups of all documents as text (A ids, ``|``, B ids; groups apart by ``;``)
        and the bounds of each document's part. ``digits``: see :func:`decimals`."""
        n_a, n_b = len(self.ids_a), len(self.ids_b)
        group_a, group_b = (np.cumsum(c) - c for c in (np.bincount(self.cut_a, minlength=n_a), np.bincount(self.cut_b, minlength=n_b)))
        before_b = np.concatenate(([0], self.cut_b + 1))
        at_a = np.arange(n_a) + before_b[group_a]
        at_b = np.arange(n_b) + self.cut_a[group_b] + 1 if n_b else np.zeros(0, np.int64)
        ids = np.empty(n_a + n_b, np.int64)
        ids[at_a], ids[at_b] = self.ids_a, self.ids_b
        mark = np.full(len(ids), ord(","), np.uint8)
        mark[at_a[self.cut_a]] = ord("|")
        mark[at_b[self.cut_b]] = ord(";")
        text = digits[ids]
        text[:, -1] = mark
        shown = text > 0
        ends = self.first_a + self.first_b
        closing = (ends[1:] - 1)[np.diff(ends) > 0]
        shown[closing, -1] = False  # nothing after a document's last group
        size = np.concatenate(([0], np.cumsum(shown.sum(axis=1))))
        return text[shown].tobytes(), size[ends]


def decimals(size: int) -> np.ndarray:
    """The decimal digits of 0 ... size - 1 as bytes, zero bytes before them and one place after."""
    power = 10 ** np.arange(len(str(size)) - 1, -1, -1)
    ids = np.arange(size)[:, None]
    text = np.zeros((size, len(power) + 1), np.uint8)
    text[:, :-1] = np.where((ids >= power) | (power == 1), ids // power % 10 + ord("0"), 0)
    return text


def align_slice(a: ByteTokens, b, part: pa.RecordBatch, buf: np.ndarray, offsets: np.ndarray) -> Alignment:
    texts = [t or "" for t in part.column(part.schema.get_field_index("text")).to_pylist()]
    sizes = np.diff(offsets)
    ids_a, n_a = a.encode([" " + t if t else "" for t in texts])
    ids_b, n_b = b.encode(buf, offsets)
    ids_b = ids_b.astype(np.int64)
    # tokens must spell blank + text
    wanted = np.insert(buf, offsets[:-1][sizes > 0], 0x20)
    length = np.where(sizes > 0, sizes + 1, 0)
    fine = np.ones(len(texts), bool)
    for table, ids, n in ((a, ids_a, n_a), (b, ids_b, n_b)):
        fits = sums(table.width[ids], np.concatenate(([0], np.cumsum(n)))) == length
        of = np.repeat(np.arange(len(n)), n)
        given = spelled(table, ids[fits[of]])
        bounds = np.concatenate(([0], np.cumsum(length[fits])))
        wrong = given != wanted[np.repeat(fits, length)]
        fits[np.flatnonzero(fits)[sums(wrong, bounds) > 0]] = False
        fine &= fits
    keep_a, keep_b = np.repeat(fine, n_a), np.repeat(fine, n_b)
    return Alignment(a, ids_a[keep_a], np.where(fine, n_a, 0), b, ids_b[keep_b], np.where(fine, n_b, 0))


_TOKENS: dict[str, ByteTokens] = {}


def byte_tokens(model) -> ByteTokens:
    key = hashlib.sha256(model.value).hexdigest()
    if key not in _TOKENS:
        _TOKENS.clear()
        _TOKENS[key] = ByteTokens(model.value)
    return _TOKENS[key]


def _lists(values: np.ndarray, bounds: np.ndarray, kind) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values.astype(kind)))


def token_groups(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """The alignment itself, per row: ``a_ids`` and ``b_ids``; ``a_cuts`` and ``b_cuts``, the places of the
    last token of each group; ``b_first`` and ``b_last``, the B tokens that each A token overlaps."""
    rows = keyed(docs)
    models = read_model(docs.sparkSession, a_path), read_model(docs.sparkSession, b_path)

    def run(batches):
        a, b = byte_tokens(models[0]), vocabulary(models[1])
        for part, buf, offsets in slices(batches):
            x = align_slice(a, b, part, buf, offsets)
            first, last = x.overlaps()
            base_a, base_b = (np.repeat(f[:-1], n) for f, n in ((x.first_b, x.n_a), (x.first_b, np.diff(x.bounds))))
            cuts_a = x.cut_a - np.repeat(x.first_a[:-1], np.diff(x.bounds))
            yield pa.RecordBatch.from_arrays(
                [part.column(part.schema.get_field_index(c)) for c in ("doc_id", "row_key")]
                + [_lists(v, n, np.int32) for v, n in ((x.ids_a, x.first_a), (x.ids_b, x.first_b), (cuts_a, x.bounds),
                                                      (x.cut_b - base_b, x.bounds), (first - base_a, x.first_a),
                                                      (last - base_a, x.first_a))],
                names=["doc_id", "row_key", "a_ids", "b_ids", "a_cuts", "b_cuts", "b_first", "b_last"])

    return rows.mapInArrow(run, "doc_id long, row_key long, a_ids array<int>, b_ids array<int>, a_cuts array<int>, "
                                "b_cuts array<int>, b_first array<int>, b_last array<int>")


def linked(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Per row: token, group and link numbers, ``groups_sha256``, and the distinct linked id
    pairs (``pairs``: A id * 2**32 + B id) with their number (``times``)."""
    rows = keyed(docs)
    models = read_model(docs.sparkSession, a_path), read_model(docs.sparkSession, b_path)

    def run(batches):
        a, b = byte_tokens(models[0]), vocabulary(models[1])
        digits = decimals(max(a.size, b.size))
        for part, buf, offsets in slices(batches):
            x = align_slice(a, b, part, buf, offsets)
            text, at = x.spelling(digits)
            digests = [hashlib.sha256(text[s:e]).hexdigest() if e > s else "" for s, e in zip(at[:-1], at[1:])]
            n = np.diff(x.bounds)
            of = np.repeat(np.arange(len(n)), n)
            pair = x.ids_a[x.cut_a] * b.size + x.ids_b[x.cut_b]
            span = max(a.size * b.size, 1)  # under 2**31 for these vocabularies
            keys, times = np.unique(of * span + pair, return_counts=True)
            bounds = np.searchsorted(keys, np.arange(len(n) + 1) * span)
            pair = keys % span
            pair = (pair // b.size << 32) + pair % b.size
            yield pa.RecordBatch.from_arrays(
                [part.column(part.schema.get_field_index(c)) for c in ("doc_id", "row_key")]
                + [pa.array(v.astype(np.int64)) for v in (x.n_a, x.n_b, n, n)]
                + [pa.array(digests, pa.string()), _lists(pair, bounds, np.int64), _lists(times, bounds, np.int32)],
                names=["doc_id", "row_key", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"])

    return rows.mapInArrow(run, "doc_id long, row_key long, n_a long, n_b long, n_groups long, n_links long, "
                                "groups_sha256 string, pairs array<long>, times array<int>")


def pair_counts(links: DataFrame) -> DataFrame:
    """``(pair, n, best)``: corpus-wide links of each id pair, and whether its B id has none higher."""

    def run(batches):
        held, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            pairs = np.concatenate([held, batch.column("pairs").flatten().to_numpy(zero_copy_only=False)])
            counts = np.concatenate([counts, batch.column("times").flatten().to_numpy(zero_copy_only=False)])
            held, at = np.unique(pairs, return_inverse=True)
            counts = np.bincount(at, counts, len(held)).astype(np.int64)
            if len(held) > MAX_PAIRS:  # a task holds a bounded table
                yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(counts)], names=["pair", "n"])
                held, counts = held[:0], counts[:0]
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(counts)], names=["pair", "n"])

    counts = links.select("pairs", "times").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    counts = staged(counts, "op13-counts")
    b_id = F.col("pair").bitwiseAND(F.lit((1 << 32) - 1))
    top = counts.groupBy(b_id.alias("b_id")).agg(F.max("n").alias("top"))  # one row a B id: at most the vocabulary
    return staged(counts.withColumn("b_id", b_id).join(F.broadcast(top), "b_id")
                  .select("pair", "n", (F.col("n") == F.col("top")).alias("best")), "op13-best")


def scored(links: DataFrame, counts: DataFrame, max_pairs: int = MAX_PAIRS) -> DataFrame:
    """``links`` (staged) with ``n_best`` and ``count_sum``."""
    size, total = counts.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    # fewer than max_pairs pairs can each have more than total / max_pairs links
    often = F.lit(True) if size <= max_pairs else F.col("n") > F.lit(total // max_pairs)
    table = counts.filter(often).toArrow()
    known = table["pair"].to_numpy()
    order = np.argsort(known)
    given = links.sparkSession.sparkContext.broadcast(
        (known[order], table["n"].to_numpy()[order], table["best"].to_numpy(zero_copy_only=False).astype(bool)[order]))
    plain = ["doc_id", "row_key", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]

    def run(batches):
        pairs, n, best = given.value
        for batch in batches:
            lists, times = batch.column("pairs"), batch.column("times").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            bounds = np.concatenate(([0], np.cumsum(np.diff(lists.offsets.to_numpy())))).astype(np.int64)
            mine = lists.flatten().to_numpy(zero_copy_only=False)
            at = np.minimum(np.searchsorted(pairs, mine), max(len(pairs) - 1, 0))
            hit = pairs[at] == mine if len(pairs) else np.zeros(len(mine), bool)
            many = np.where(hit, n[at], 0) if len(pairs) else np.zeros(len(mine), np.int64)
            top = hit & best[at] if len(pairs) else hit
            rest = np.concatenate(([0], np.cumsum(~hit)))[bounds]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in plain]
                + [pa.array(sums(np.where(top, times, 0), bounds)), pa.array(sums(many * times, bounds)),
                   _lists(mine[~hit], rest, np.int64), _lists(times[~hit], rest, np.int32)],
                names=[*plain, "n_best", "count_sum", "pairs", "times"])

    done = links.mapInArrow(run, "doc_id long, row_key long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
                                 "n_best long, count_sum long, pairs array<long>, times array<int>")
    if size <= max_pairs:
        return done.drop("pairs", "times")
    done = staged(done.withColumn("row", F.monotonically_increasing_id()), "op13-rows")
    rare = done.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("x")).select("row", "x.pairs", "x.times")
    rare = rare.join(counts.filter(~often), F.col("pairs") == F.col("pair")).groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"), F.sum(F.col("n") * F.col("times")).alias("more"))
    return done.join(rare, "row", "left").select(
        *plain, (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more", F.lit(0))).alias("count_sum"))


def alignment(docs: DataFrame, a_path: str, b_path: str, max_pairs: int = MAX_PAIRS) -> DataFrame:
    """Per row of ``docs``: token, group and link numbers, the digest of its groups, and what the
    corpus-wide counts say of its links."""
    links = staged(linked(docs, a_path, b_path), "op13-links")
    return scored(links, pair_counts(links), max_pairs)


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text of ``documents`` aligned between the two tokenizers."""
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = alignment(docs, public_tokenizers.path(BYTE_MODEL), public_tokenizers.path(MODEL))
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
