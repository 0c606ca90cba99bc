"""Words of whole Arrow batches as NumPy arrays: boundaries and 64-bit hashes.

Texts arrive from Spark as Arrow string arrays. A slice of documents (about
``SLICE_BYTES`` of text; a longer document is a slice of its own) is one UTF-8
byte buffer, and everything below is vectorised over that buffer, so the memory
of a task is a fixed multiple of the slice.

A word hash is a polynomial over per-byte random values modulo 2**64, taken from
a prefix sum; a window hash is the same polynomial over word hashes (Rabin-Karp),
so every window of a slice costs two array look-ups whatever its length.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20

SPACE = bytes([0x20, *range(0x09, 0x0E)])  # separators of [^\x20\x09-\x0D]+
NOT_ALNUM = bytes([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])  # of [^\x00-\x2F\x3A-\x60\x7B-\x7F]+

_ODD = 0x9E3779B97F4A7C15


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def byte_values(lower: bool) -> np.ndarray:
    """A random-looking 64-bit value per byte; A-Z share those of a-z if ``lower``."""
    b = np.arange(256, dtype=np.uint64)
    if lower:
        b[65:91] += np.uint64(32)
    return mix64((b + np.uint64(1)) * np.uint64(_ODD))


class Powers:
    """Powers of an odd base and of its inverse modulo 2**64, grown on demand."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            self.up, self.down = (np.multiply.accumulate(np.concatenate(
                ([np.uint64(1)], np.full(size - 1, b, np.uint64)))) for b in (self.base, self.inverse))
        return self.up, self.down


def polynomial(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, powers: Powers) -> np.ndarray:
    """Sum of values[s + j] * base**j over each [s, e), modulo 2**64."""
    up, down = powers.get(len(values) + 1)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[:len(values)], out=total[1:])
    return (total[ends] - total[starts]) * down[starts]


def text_buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string array and its offsets (null: empty)."""
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    if len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(texts.buffers()[1], kind)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(batches, text: str = "text", size: int = SLICE_BYTES):
    """Cut record batches into runs of rows of about ``size`` bytes of text."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        offsets = text_buffer(column)[1]
        at = 0
        while at < batch.num_rows:
            to = int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1
            to = min(max(to, at + 1), batch.num_rows)
            part = batch.slice(at, to - at)
            yield part, *text_buffer(part.column(batch.schema.get_field_index(text)))
            at = to


class Words:
    """Word splitting and hashing with one set of separators."""

    def __init__(self, separators: bytes = SPACE, lower: bool = False):
        self.is_word = np.ones(256, bool)
        self.is_word[list(separators)] = False
        if lower:
            self.is_word[65:91] = True
        self.values = byte_values(lower)
        self.bytes, self.windows_of = Powers(0xC2B2AE3D27D4EB4F), Powers(0x165667B19E3779F9)

    def split(self, buf: np.ndarray, offsets: np.ndarray):
        """``(starts, ends, first)``: byte ranges of the words, in order, and
        the index of each document's first word (one entry more than documents)."""
        inside = np.zeros(len(buf) + 2, bool)
        inside[1:-1] = self.is_word[buf]
        cut = np.zeros(len(buf) + 1, bool)
        cut[offsets] = True
        before, here = inside[:-1], inside[1:]
        starts = np.flatnonzero(here & (cut | ~before))
        ends = np.flatnonzero(before & (cut | ~here))
        return starts, ends, np.searchsorted(starts, offsets)

    def hashes(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """A 64-bit hash per byte range."""
        h = polynomial(self.values[buf], starts, ends, self.bytes)
        return mix64(h + (ends - starts).astype(np.uint64) * np.uint64(_ODD))

    def spans(self, hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """A 64-bit hash per range of words."""
        h = polynomial(hashes, starts, ends, self.windows_of)
        return mix64(h + (ends - starts).astype(np.uint64) * np.uint64(_ODD))

    def deletions(self, hashes: np.ndarray) -> np.ndarray:
        """For each p, the hash (as of ``spans``) of the words without word p."""
        n = len(hashes)
        at = np.arange(n)
        left = polynomial(hashes, np.zeros(n, np.int64), at, self.windows_of)
        right = polynomial(hashes, at + 1, np.full(n, n), self.windows_of)
        h = left + self.windows_of.get(n + 1)[0][:n] * right
        return mix64(h + np.full(n, n - 1, np.uint64) * np.uint64(_ODD))

    def windows(self, hashes: np.ndarray, first: np.ndarray, width: int):
        """``(start, hash)`` of every window of ``width`` words inside one document."""
        n = len(hashes)
        fits = np.ones(max(n - width + 1, 0), bool)
        for d in range(1, width):  # a window may not run over a document's end
            bad = first[1:-1] - d
            fits[bad[(bad >= 0) & (bad < len(fits))]] = False
        start = np.flatnonzero(fits)
        return start, self.spans(hashes, start, start + width)


def document_of(first: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The document that holds each word index of ``at``."""
    return np.searchsorted(first, at, "right") - 1


def sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of ``values`` between neighbouring ``bounds``."""
    total = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
    return total[bounds[1:]] - total[bounds[:-1]]
