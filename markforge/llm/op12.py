"""SentencePiece BPE encoding and decoding in vectorised merge rounds.

The driver reads the model file (its path is a parameter) and broadcasts the
vocabulary tables; their size is that of the file and does not grow with the
documents. Each task cuts its texts into slices of about 1 MB and works on flat
NumPy arrays:

- a text becomes code points with the model's dummy prefix and escaped blanks;
- it is cut into words wherever two neighbouring characters stand together in no
  piece, so no merge can cross a cut; equal words of a slice are encoded once
  (told apart by hash, confirmed character by character);
- in each merge round every word finds its best pair (the smallest rank over the
  word's segment of a flat array) and merges all its occurrences at once, from
  the left; the array is then compacted, and words without a pair leave it.

A round gives the sequence of the one-by-one algorithm (best pair first, ties
from the left) if no new pair can be as good as the merged one. Where the
vocabulary holds such a pair, a round merges only the leftmost occurrence. Words
of more than ``LONG`` symbols run the same order from a heap, so a text
without any cut costs n log n and not n rounds.

Decoding gathers the bytes of the pieces, drops the dummy blank of the first
visible piece and replaces each byte that is no valid UTF-8.

Defined results: a null text is empty and an empty text has only the begin and
end ids; repeated rows are encoded each; an empty table gives an empty table;
other columns of the input are ignored, whatever their names; very long texts
are slices of their own (memory is about 60 bytes a byte of the longest text);
ties go to the left pair as in the library.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from markforge.llm.common import keyed
from markforge.llm.words import Powers, mix64, polynomial, slices

MODEL = "piece_bpe_32k.model"
LONG = 512
BLANK = 0x2581  # the character that stands for a blank in pieces
NONE = np.int32(2**31 - 1)
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6  # piece types of the model format

COLUMNS = {"n_tokens": pa.int64(), "ids": pa.list_(pa.int32()), "ids_sha256": pa.string(),
           "decoded": pa.string(), "decoded_sha256": pa.string()}
DDL = {"n_tokens": "long", "ids": "array<int>", "ids_sha256": "string", "decoded": "string", "decoded_sha256": "string"}


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indexes start, start + 1, ... of each range, one after another."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)


class Vocabulary:
    """Tables of a BPE model with byte fallback and without normalisation rules."""

    def __init__(self, model: bytes):
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(model)
        rules, trained = proto.normalizer_spec, proto.trainer_spec
        if (trained.model_type != 2 or not trained.byte_fallback or rules.precompiled_charsmap or trained.treat_whitespace_as_suffix
                or rules.remove_extra_whitespaces or not rules.escape_whitespaces or proto.denormalizer_spec.precompiled_charsmap
                or {p.type for p in proto.pieces} - {NORMAL, UNKNOWN, CONTROL, BYTE}):
            raise ValueError("only BPE models with byte fallback, escaped blanks and no normalisation rules are supported")
        self.prefix = rules.add_dummy_prefix
        kinds = np.array([p.type for p in proto.pieces])
        number = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == NORMAL}
        self.size = len(kinds)
        self.begin, self.end = (next((i for i, p in enumerate(proto.pieces) if p.piece == name and p.type == CONTROL), None)
                                for name in (trained.bos_piece, trained.eos_piece))
        scores = np.array([p.score for p in proto.pieces], np.float32)
        rank = np.unique(-scores, return_inverse=True)[1].astype(np.int32)
        # characters that are no piece but stand in one are symbols too
        letters = {c for piece in number for c in piece}
        symbol = dict(number)
        for c in sorted(letters - set(number)):
            symbol[c] = self.size + len(symbol) - len(number)
        self.symbols = self.size + len(symbol) - len(number)
        self.of_char = -1 - np.arange(0x110000, dtype=np.int32)  # unknown characters carry their code point
        for c in letters:
            self.of_char[ord(c)] = symbol[c]
        self.code_of = np.zeros(self.symbols, np.int64)
        for c in letters:
            self.code_of[symbol[c]] = ord(c)
        pairs, lone, beside = {}, np.zeros(self.size, bool), []
        for piece, i in number.items():
            beside += zip(map(ord, piece), map(ord, piece[1:]))
            for at in range(1, len(piece)):
                left, right = symbol.get(piece[:at]), symbol.get(piece[at:])
                if left is None or right is None:
                    continue
                pairs[left * self.symbols + right] = i
                for part, length in ((left, at), (right, len(piece) - at)):
                    if length > 1 and rank[i] <= rank[part]:
                        lone[part] = True
        self.keys = np.array(sorted(pairs), np.int64)
        self.merged = np.array([pairs[k] for k in self.keys], np.int32)
        self.ranks, self.lone, self.pairs = rank[self.merged], lone, pairs
        self._fill_slots()
        self.piece_rank = rank
        # neighbours that a piece may hold; a chance entry only leaves a cut out
        self.beside = np.zeros(1 << 20, bool)
        if beside:
            self.beside[self._slot(*np.array(beside, np.int64).T)] = True
        self.byte_id = np.zeros(256, np.int32)
        surface = []
        for i, p in enumerate(proto.pieces):
            if p.type == BYTE:
                self.byte_id[int(p.piece[3:5], 16)] = i
            surface.append(bytes([int(p.piece[3:5], 16)]) if p.type == BYTE else b"" if p.type == CONTROL else
                           trained.unk_surface.encode() if p.type == UNKNOWN else p.piece.replace(chr(BLANK), " ").encode())
        self.surface = np.frombuffer(b"".join(surface), np.uint8)
        self.width = np.array([len(s) for s in surface], np.int64)
        self.offset = np.cumsum(self.width) - self.width
        self.is_control, self.is_byte = kinds == CONTROL, kinds == BYTE
        self.blank_first = np.array([p.type == NORMAL and p.piece.startswith(chr(BLANK)) for p in proto.pieces])
        self.powers = Powers(0x9E3779B97F4A7C15)

    @staticmethod
    def _slot(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return (left * 0x9E3779B1 + right * 0x85EBCA77 >> 7) & ((1 << 20) - 1)

    def _start(self, key: np.ndarray) -> np.ndarray:
        return (key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(65 - len(self.slots).bit_length())).astype(np.int64)

    def _fill_slots(self) -> None:
        """An open hash table of the pairs, at most a quarter full."""
        self.slots = np.full(1 << (4 * len(self.keys) + 1).bit_length(), -1, np.int32)
        left = np.arange(len(self.keys), dtype=np.int32)
        slot = self._start(self.keys)
        while len(left):
            free = np.flatnonzero(self.slots[slot] < 0)
            taken, first = np.unique(slot[free], return_index=True)
            self.slots[taken] = left[free[first]]
            rest = np.ones(len(left), bool)
            rest[free[first]] = False
            left, slot = left[rest], (slot[rest] + 1) & (len(self.slots) - 1)

    def find(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (``NONE`` without a piece) and merged piece of neighbouring symbols."""
        if not len(self.keys):
            return np.full(len(left), NONE), np.zeros(len(left), np.int32)
        key = np.where((left >= 0) & (right >= 0), left.astype(np.int64) * self.symbols + right, -1)
        slot = self._start(key)
        at = self.slots[slot]
        open_ = np.flatnonzero((at >= 0) & (self.keys[at] != key))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & (len(self.slots) - 1)
            at[open_] = self.slots[slot[open_]]
            open_ = open_[(at[open_] >= 0) & (self.keys[at[open_]] != key[open_])]
        return np.where(at >= 0, self.ranks[at], NONE), self.merged[at]

    # -- encoding ---------------------------------------------------------

    def merge_rounds(self, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge each word (a run of ``lengths`` symbols) until no pair remains;
        returns the flat result and the words' new lengths."""
        number, done = np.arange(len(lengths)), []
        while len(number):
            starts = np.cumsum(lengths) - lengths
            rank = np.full(len(symbols), NONE)
            piece = np.zeros(len(symbols), np.int32)
            rank[:-1], piece[:-1] = self.find(symbols[:-1], symbols[1:])
            rank[starts + lengths - 1] = NONE  # no pair runs over a word's end
            best = np.minimum.reduceat(rank, starts)
            open_ = best < NONE
            if not open_.all():
                done.append((number[~open_], lengths[~open_], symbols[np.repeat(~open_, lengths)]))
                if not open_.any():
                    break
                stay = np.repeat(open_, lengths)
                symbols, rank, piece = symbols[stay], rank[stay], piece[stay]
                number, lengths, best = number[open_], lengths[open_], best[open_]
            word = np.repeat(np.arange(len(lengths)), lengths)
            at = np.flatnonzero(rank == best[word])
            # of overlapping occurrences every second one, counted from the left
            fresh = np.ones(len(at), bool)
            fresh[1:] = at[1:] != at[:-1] + 1
            first = np.flatnonzero(fresh)
            odd = (np.arange(len(at)) - first[np.cumsum(fresh) - 1]) & 1
            of = word[at]
            leftmost = np.ones(len(at), bool)
            leftmost[1:] = of[1:] != of[:-1]
            # a lone piece may make a pair as good as itself: one merge, then look again
            careful = np.zeros(len(lengths), bool)
            careful[of[self.lone[piece[at]]]] = True
            at = at[(odd == 0) & (leftmost | ~careful[of])]
            symbols[at] = piece[at]
            stay = np.ones(len(symbols), bool)
            stay[at + 1] = False
            symbols = symbols[stay]
            lengths = lengths - np.bincount(word[at], minlength=len(lengths))
        if not done:
            return symbols, lengths
        number, lengths, symbols = (np.concatenate(x) for x in zip(*done))
        order = np.argsort(number, kind="stable")
        starts = np.cumsum(lengths) - lengths
        return symbols[ranges(starts[order], lengths[order])], lengths[order]

    def merge_long(self, symbols: np.ndarray) -> np.ndarray:
        """The same order of merges for one long word, from a heap of (rank, place)."""
        rank, _ = self.find(symbols[:-1], symbols[1:])
        at = np.flatnonzero(rank < NONE)
        heap = list(zip(rank[at].tolist(), at.tolist(), symbols[at].tolist(), symbols[at + 1].tolist()))
        heapq.heapify(heap)
        n, s = len(symbols), symbols.tolist()
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while heap:
            _, i, left, right = heapq.heappop(heap)
            j = after[i] if s[i] == left else n
            if j >= n or s[j] != right:
                continue
            s[i], s[j], k = self.pairs[left * self.symbols + right], None, after[j]
            after[i] = k
            if k < n:
                before[k] = i
            for a, b in ((before[i], i), (i, k)):
                if 0 <= a and b < n and s[a] >= 0 and s[b] >= 0:
                    new = self.pairs.get(s[a] * self.symbols + s[b])
                    if new is not None:
                        heapq.heappush(heap, (int(self.piece_rank[new]), a, s[a], s[b]))
        return np.array([x for x in s if x is not None], np.int32)

    def words(self, codes: np.ndarray, cut: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and lengths of the words of ``codes`` and, for each, the first equal word."""
        starts = np.flatnonzero(cut)
        lengths = np.diff(np.append(starts, len(codes)))
        h = polynomial(mix64(codes.astype(np.uint64) + np.uint64(1)), starts, starts + lengths, self.powers)
        h = mix64(h + lengths.astype(np.uint64))
        _, first, group = np.unique(h, return_index=True, return_inverse=True)
        same = first[group]
        # confirmed on the characters: a word that only shares a hash is its own
        equal = lengths == lengths[same]
        both = np.flatnonzero(equal & (same != np.arange(len(same))))
        differ = codes[ranges(starts[both], lengths[both])] != codes[ranges(starts[same[both]], lengths[both])]
        if differ.any():
            ends = np.cumsum(lengths[both])
            equal[both[np.searchsorted(ends, np.flatnonzero(differ), "right")]] = False
        return starts, lengths, np.where(equal, same, np.arange(len(same)))

    def encode(self, buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of UTF-8 texts without begin and end ids: flat, and the number of each text."""
        raw = np.frombuffer(buf.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32).astype(np.int64)
        chars = np.concatenate(([0], np.cumsum((buf & 0xC0) != 0x80)))[offsets]
        sizes = np.diff(chars)
        filled = np.flatnonzero(sizes)
        codes = np.where(raw == 0x20, BLANK, raw)
        firsts = chars[filled]
        if self.prefix:
            codes = np.insert(codes, firsts, BLANK)
            firsts = firsts + np.arange(len(firsts))
        n_ids = np.zeros(len(sizes), np.int64)
        if not len(codes):
            return np.zeros(0, np.int32), n_ids
        cut = np.ones(len(codes), bool)
        cut[1:] = ~self.beside[self._slot(codes[:-1], codes[1:])]
        cut[firsts] = True
        starts, lengths, same = self.words(codes, cut)
        own = np.flatnonzero(same == np.arange(len(same)))
        symbols = self.of_char[codes[ranges(starts[own], lengths[own])]]
        own_lengths = lengths[own]
        long = np.flatnonzero(own_lengths > LONG)
        if len(long):
            at = np.cumsum(own_lengths) - own_lengths
            merged = [self.merge_long(symbols[at[i]:at[i] + own_lengths[i]]) for i in long]
            short = np.repeat(own_lengths <= LONG, own_lengths)
            rest = np.flatnonzero(own_lengths <= LONG)
            flat, counts = self.merge_rounds(symbols[short], own_lengths[rest]) if len(rest) else (symbols[:0], own_lengths[:0])
            flat = np.concatenate([flat, *merged])
            counts = np.concatenate([counts, [len(m) for m in merged]]).astype(np.int64)
            own = np.concatenate([own[rest], own[long]])
        else:
            flat, counts = self.merge_rounds(symbols, own_lengths)
        flat, counts = self._bytes_of_unknown(flat, counts)
        # every word takes the ids of its first equal word
        place = np.empty(len(starts), np.int64)
        place[own] = np.arange(len(own))
        of = place[same]
        at = np.cumsum(counts) - counts
        ids = flat[ranges(at[of], counts[of])]
        word_ids = np.concatenate(([0], np.cumsum(counts[of])))
        n_ids[filled] = np.diff(word_ids[np.searchsorted(starts, np.append(firsts, len(codes)))])
        return ids, n_ids

    def _bytes_of_unknown(self, flat: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Characters that are no piece become the ids of their UTF-8 bytes."""
        odd = np.flatnonzero((flat < 0) | (flat >= self.size))
        if not len(odd):
            return flat, counts
        code = np.where(flat[odd] < 0, -1 - flat[odd].astype(np.int64), self.code_of[np.maximum(flat[odd], 0)])
        size = 1 + (code > 0x7F) + (code > 0x7FF) + (code > 0xFFFF)
        width = np.ones(len(flat), np.int64)
        width[odd] = size
        out = np.repeat(flat, width)
        first = (np.cumsum(width) - width)[odd]
        lead = np.array([0, 0, 0xC0, 0xE0, 0xF0])
        for k in range(4):
            has = size > k
            shift = 6 * (size[has] - 1 - k)
            byte = np.where(k == 0, lead[size[has]] | code[has] >> shift, 0x80 | code[has] >> shift & 0x3F)
            out[first[has] + k] = self.byte_id[byte]
        bounds = np.concatenate(([0], np.cumsum(counts)))
        return out, np.diff(np.concatenate(([0], np.cumsum(width)))[bounds])

    # -- decoding ---------------------------------------------------------

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> list[bytes]:
        """UTF-8 texts of the id lists ``ids[bounds[i]:bounds[i + 1]]``."""
        start, width = self.offset[ids], self.width[ids].copy()
        seen = np.concatenate(([0], np.cumsum(~self.is_control[ids])))
        shown = np.flatnonzero(~self.is_control[ids])
        if self.prefix and len(shown):
            # the blank of each list's first visible piece is the dummy prefix
            has = seen[bounds[1:]] > seen[bounds[:-1]]
            first = shown[seen[bounds[:-1]][has]]
            first = first[self.blank_first[ids[first]]]
            start[first] += 1
            width[first] -= 1
        data = self.surface[ranges(start, width)].tobytes()
        ends = np.concatenate(([0], np.cumsum(width)))
        at = ends[bounds]
        # an invisible id after a byte ends the character there
        breaks = np.flatnonzero(self.is_control[ids[1:]] & self.is_byte[ids[:-1]]) + 1
        parts = np.split(ends[breaks], np.searchsorted(breaks, bounds[1:-1]))
        out = []
        for i in range(len(bounds) - 1):
            inner = [int(b) for b in parts[i] if at[i] < b < at[i + 1]]
            cuts = [int(at[i]), *inner, int(at[i + 1])]
            out.append(b"".join(_repaired(data[a:b]) for a, b in zip(cuts, cuts[1:])))
        return out


def _repaired(data: bytes) -> bytes:
    """Each byte that starts no valid character becomes U+FFFD."""
    try:
        data.decode("utf-8")
        return data
    except UnicodeDecodeError:
        out, at = [], 0
    while at < len(data):
        lead = data[at]
        size = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
        try:
            out.append(data[at:at + size].decode("utf-8"))
            at += size
        except UnicodeDecodeError:
            out.append("�")
            at += 1
    return "".join(out).encode("utf-8")


_TABLES: dict[str, Vocabulary] = {}


def vocabulary(model) -> Vocabulary:
    """The tables of a broadcast model file, built once per Python worker."""
    key = hashlib.sha256(model.value).hexdigest()
    if key not in _TABLES:
        _TABLES.clear()
        _TABLES[key] = Vocabulary(model.value)
    return _TABLES[key]


def read_model(spark: SparkSession, path: str):
    """A model file of the driver as a broadcast value."""
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def sentencepiece_codes(docs: DataFrame, model_path: str, columns: Sequence[str] = ("ids", "decoded"),
                        begin: bool = True, end: bool = True) -> DataFrame:
    """``(doc_id, row_key, *columns)`` of every whole text: ``n_tokens``, ``ids``,
    ``ids_sha256`` (little-endian unsigned 32-bit ids), ``decoded`` and
    ``decoded_sha256`` (UTF-8), as asked for."""
    rows = keyed(docs)
    model = read_model(docs.sparkSession, model_path)

    def run(batches):
        table = vocabulary(model)
        if begin and table.begin is None or end and table.end is None:
            raise ValueError("the model has no begin or end id")
        for part, buf, offsets in slices(batches):
            ids, counts = table.encode(buf, offsets)
            ends = np.cumsum(counts)
            if begin:
                ids = np.insert(ids, ends - counts, table.begin)
                ends = ends + np.arange(1, len(ends) + 1)
            if end:
                ids = np.insert(ids, ends, table.end)
                ends = ends + np.arange(1, len(ends) + 1)
            bounds = np.concatenate(([0], ends))
            found = {"n_tokens": np.diff(bounds)}
            if "ids" in columns:
                found["ids"] = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids.astype(np.int32)))
            if "ids_sha256" in columns:
                raw = ids.astype("<u4").tobytes()
                found["ids_sha256"] = [hashlib.sha256(raw[4 * a:4 * b]).hexdigest() for a, b in zip(bounds[:-1], bounds[1:])]
            if "decoded" in columns or "decoded_sha256" in columns:
                texts = table.decode(ids, bounds)
                found["decoded"] = pa.array(texts, pa.binary()).cast(pa.string())
                found["decoded_sha256"] = [hashlib.sha256(t).hexdigest() for t in texts]
            yield pa.RecordBatch.from_arrays(
                [part.column(part.schema.get_field_index(c)) for c in ("doc_id", "row_key")]
                + [pa.array(found[c], COLUMNS[c]) if not isinstance(found[c], pa.Array) else found[c] for c in columns],
                names=["doc_id", "row_key", *columns])

    return rows.mapInArrow(run, "doc_id long, row_key long, " + ", ".join(f"{c} {DDL[c]}" for c in columns))


def decode_ids(rows: DataFrame, model_path: str, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """``rows`` with ``out``, the text of the id list ``ids_col`` (null: an empty
    list). An id outside the vocabulary is an error. Null ids of a list are left out."""
    from pyspark.sql import functions as F

    model = read_model(rows.sparkSession, model_path)

    @F.pandas_udf("string")
    def decoded(lists):
        import pandas as pd

        table = vocabulary(model)
        arrays = [np.zeros(0, np.int64) if x is None else np.asarray(x, np.int64) for x in lists]
        bounds = np.concatenate(([0], np.cumsum([len(a) for a in arrays]))).astype(np.int64)
        flat = np.concatenate([*arrays, np.zeros(0, np.int64)])
        if len(flat) and not (0 <= flat.min() and flat.max() < table.size):
            raise ValueError("an id is outside the vocabulary")
        return pd.Series([t.decode("utf-8") for t in table.decode(flat, bounds)], dtype=object)

    ids = F.filter(F.col(ids_col).cast("array<bigint>"), lambda x: x.isNotNull())
    return rows.withColumn(out, decoded(ids))


def op12_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text of ``documents`` encoded with begin and end ids, and decoded again."""
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return sentencepiece_codes(docs, public_tokenizers.path(MODEL),
                               ("n_tokens", "ids_sha256", "decoded_sha256")).drop("row_key")
