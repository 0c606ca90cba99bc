"""Hard negatives, SentencePiece codes and token alignment against brute force and the
libraries, on rows with nulls, empty and long texts, ties, repeats and clashing columns."""

import collections
import hashlib
import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from markforge.llm import op11, op12, op13

P = pytest.importorskip("public_tokenizers")
PIECES, BYTES = P.path(op12.MODEL), P.path(op13.BYTE_MODEL)


@pytest.fixture(scope="module")
def piece():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


def texts():
    rnd = random.Random(9)
    parts = ["a", "the", "ing", " ", "  ", "\n", "\t", "é", "ß", "▁", "😀", "中文", "ー", "12", "<s>", "</s>", "<unk>", "<0x0A>", "\0",
             "(", ");", "=", "--", "﻿", "é", "<|endoftext|>", "ا", " "]
    rows = ["".join(rnd.choice(parts) for _ in range(rnd.randrange(40))) for _ in range(400)]
    letters = "abcdefghijklmnopqrstuvwxyz"
    rows += [None, "", " ", "\n", " " * 700, "a" * 3000, "ab" * 900, "=-" * 800, "same text", "same text", "中" * 900,
             "".join(rnd.choice(letters) for _ in range(4000)), "long words here " * 4000]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t) for i, t in enumerate(texts())] + [(None, "no id"), (7, "another seven"), (8, None), (8, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return df.selectExpr("*", "1 as row_key", "2 as ids", "3 as n_tokens", "4 as pairs", "'x' as decoded").cache()


# ---- hard negatives ----------------------------------------------------------


def negatives_of(rows, anchor, n_pos=5, n_neg=10, low=30, high=90):
    fit = [(i, lab, [max(-2**22, min(2**22, math.floor(256 * float(np.float32(x))))) for x in v]) for i, lab, v in rows
           if None not in (i, lab, v) and all(x is not None and math.isfinite(x) for x in v)]
    out = set()
    for k, (i, lab, v) in enumerate(fit):
        if not anchor(i) or (i, lab, v) in fit[:k]:
            continue
        scores = [(sum(a * b for a, b in zip(v, w)), j, other) for j, other, w in fit if j != i and len(w) == len(v)]
        order = sorted(scores, key=lambda s: (-s[0], s[1]))
        for p, pid, _ in [s for s in order if s[2] == lab][:n_pos]:
            window = [s for s in order if s[2] != lab and low * p <= 100 * s[0] <= high * p][:n_neg]
            out |= {(i, pid, k, j, p, s) for k, (s, j, _) in enumerate(window, 1)}
    return out


@pytest.mark.parametrize("step,block,round_bytes", [(8, 1 << 19, 4 << 20), (1, 40, 2000)])
def test_hard_negatives(spark, monkeypatch, step, block, round_bytes):
    rnd = random.Random(4)
    rows = [(i, rnd.randrange(4), [rnd.uniform(-1, 1) for _ in range(9)]) for i in range(240)]
    rows += [(300 + i, i % 3, rows[5][2]) for i in range(30)]  # ties
    rows += [(400, 1, [0.0] * 9), (500, 2, [1.5] * 9), (501, 3, [1.5] * 9), (502, 2, [-1.5] * 9), (600, 0, [1e30] + [0.0] * 8),
             (601, 0, [1e30] + [0.1] * 8), (602, 1, [2.0] * 9), (700, 1, []), (701, 2, []), (702, 1, []), (710, 1, [0.5, 0.5]),
             (800, 1, [0.5, 0.25]), (711, 2, [0.4, 0.4]),
             (900, None, [0.1] * 9), (910, 1, None), (920, 1, [None] + [0.1] * 8), (930, 1, [float("nan")] * 9),
             (940, 2, [float("inf")] * 9), (None, 1, [0.1] * 9)]
    rows += [rows[100], rows[7]]  # an anchor row and another row, repeated
    for at, name in ((step, "STEP"), (block, "BLOCK_VALUES"), (round_bytes, "ROUND_BYTES")):
        monkeypatch.setattr(op11, name, at)
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>").selectExpr(
        "*", "1 as comps", "2 as score", "3 as anchor_key", "'z' as window").repartition(3)
    got = op11.hard_negatives(df, F.col("vec_id") % 10 == 0).collect()
    assert {tuple(r) for r in got} == negatives_of(rows, lambda i: i % 10 == 0)
    assert op11.hard_negatives(df.limit(0), F.col("vec_id") % 10 == 0).count() == 0


def test_bounds_leave_rows_out():
    """Rows leave the candidate set before all their columns are read, and the result stays exact."""
    rnd = np.random.default_rng(0)
    vectors = rnd.integers(-40, 40, (4000, 64)) // 8
    vectors[:, :8] *= 16  # a few columns decide
    low, high = np.array([op11.LEAST]), np.array([op11.MOST])
    x = op11.Anchors(np.arange(3), np.arange(3), np.zeros(3, int), vectors[:3], [low] * 3, [high] * 3, 5)
    for at in range(0, 4000, 500):
        x.scan(np.ascontiguousarray(vectors[at:at + 500].T), np.arange(at, at + 500), np.zeros(500, int), True)
    scores = vectors @ vectors[:3].T
    for a in range(3):
        want = sorted(((int(-s), i) for i, s in enumerate(scores[:, a]) if i != a))[:5]
        assert list(zip((-x.scores[a][0]).tolist(), x.ids[a][0].tolist())) == want
    assert x.read < 0.3 * 3 * 4000 * 64


# ---- SentencePiece -------------------------------------------------------------


def test_sentencepiece_equals_the_library(docs, piece):
    rows = docs.select("doc_id", "text").collect()
    got = op12.sentencepiece_codes(docs, PIECES, ("n_tokens", "ids", "ids_sha256", "decoded", "decoded_sha256")).collect()
    want = collections.Counter()
    for r in rows:
        ids = piece.encode(r.text or "", add_bos=True, add_eos=True)
        text = piece.decode(ids)
        want[(r.doc_id, len(ids), tuple(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), text,
              hashlib.sha256(text.encode()).hexdigest())] += 1
    assert collections.Counter((r.doc_id, r.n_tokens, tuple(r.ids), r.ids_sha256, r.decoded, r.decoded_sha256) for r in got) == want
    assert op12.sentencepiece_codes(docs.limit(0), PIECES).count() == 0
    bare = op12.sentencepiece_codes(docs.filter("doc_id < 40"), PIECES, ("ids",), begin=False, end=False).collect()
    text = {r.doc_id: r.text for r in rows if r.doc_id is not None and r.doc_id not in (7, 8)}
    assert all(list(r.ids) == piece.encode(text[r.doc_id] or "") for r in bare if r.doc_id in text)


def test_long_words_from_the_heap(piece, monkeypatch):
    monkeypatch.setattr(op12, "LONG", 2)
    with open(PIECES, "rb") as f:
        table = op12.Vocabulary(f.read())
    for text in texts():
        raw = (text or "").encode()
        ids, n = table.encode(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
        assert ids.tolist() == piece.encode(text or "") and n.tolist() == [len(ids)]


def test_words_that_share_a_hash_are_told_apart(piece, monkeypatch):
    monkeypatch.setattr(op12, "mix64", lambda x: np.zeros_like(x))
    with open(PIECES, "rb") as f:
        table = op12.Vocabulary(f.read())
    raw = b"one two six ten one two three seven eight one"
    ids, _ = table.encode(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
    assert ids.tolist() == piece.encode(raw.decode())


def test_decoding_of_any_ids(spark, piece):
    rnd = random.Random(2)
    lists = [[rnd.choice([rnd.randrange(3, 259), rnd.randrange(32000), 1, 2, 0, 28705]) for _ in range(rnd.randrange(12))]
             for _ in range(600)] + [[], None]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lists)], "n long, ids array<int>").repartition(2)
    for r in op12.decode_ids(df, PIECES).collect():
        assert r.decoded == piece.decode(list(r.ids or []))


def test_other_models_are_refused(piece):
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    with open(PIECES, "rb") as f:
        proto.ParseFromString(f.read())
    proto.normalizer_spec.remove_extra_whitespaces = True
    with pytest.raises(ValueError, match="byte fallback"):
        op12.Vocabulary(proto.SerializeToString())


# ---- alignment -------------------------------------------------------------------


def aligned(rows, piece):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(BYTES)
    tokenizer.encode_special_tokens = True
    byte = op13.byte_alphabet()
    entry = {i: bytes(byte[c] for c in s) for s, i in tokenizer.get_vocab().items()}

    def b_bytes(i):
        p = piece.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if piece.is_byte(i) else p.replace("▁", " ").encode()

    out, count = [], collections.Counter()
    for doc, text in rows:
        a = tokenizer.encode(" " + text, add_special_tokens=False).ids if text else []
        b = piece.encode(text) if text else []
        sa, sb = [entry[i] for i in a], [b_bytes(i) for i in b]
        if not text or not b"".join(sa) == b"".join(sb) == (" " + text).encode():
            a, b, sa, sb = [], [], [], []
        ea, eb = (list(itertools.accumulate(map(len, s))) for s in (sa, sb))
        links, groups, i, j = [], [], 0, 0
        at_b = {e: k for k, e in enumerate(eb)}
        for k, e in enumerate(ea):
            if e in at_b:
                links.append((a[k], b[at_b[e]]))
                groups.append(",".join(map(str, a[i:k + 1])) + "|" + ",".join(map(str, b[j:at_b[e] + 1])))
                i, j = k + 1, at_b[e] + 1
        count.update(links)
        out.append((doc, len(a), len(b), links, hashlib.sha256(";".join(groups).encode()).hexdigest() if a else "", (a, b, ea, eb)))
    top = collections.defaultdict(int)
    for (_, y), n in count.items():
        top[y] = max(top[y], n)
    return out, count, top


@pytest.mark.parametrize("max_pairs", [op13.MAX_PAIRS, 40])
def test_alignment(docs, piece, max_pairs):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    found, count, top = aligned(rows, piece)
    want = collections.Counter((d, a, b, len(x), len(x), sum(count[p] == top[p[1]] for p in x), sum(count[p] for p in x), h)
                               for d, a, b, x, h, _ in found)
    assert any(not a for _, a, *_ in want) and sum(n for _, _, _, n, *_ in want) > 1000
    cols = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    got = op13.alignment(docs, BYTES, PIECES, max_pairs).select(*cols).collect()
    assert collections.Counter(map(tuple, got)) == want
    assert op13.alignment(docs.limit(0), BYTES, PIECES, max_pairs).count() == 0


def test_groups_and_overlaps(docs, piece):
    few = docs.filter("doc_id % 9 = 0 and length(text) < 500")
    rows = [(r.doc_id, r.text) for r in few.select("doc_id", "text").collect()]
    found = {d: t for d, *_, t in aligned(rows, piece)[0]}
    for r in op13.token_groups(few, BYTES, PIECES).collect():
        a, b, ea, eb = found[r.doc_id]
        assert (list(r.a_ids), list(r.b_ids)) == (a, b)
        assert [ea[i] for i in r.a_cuts] == [eb[j] for j in r.b_cuts] == sorted(set(ea) & set(eb))
        for i, (s, e) in enumerate(zip([0, *ea], ea)):
            over = [j for j, (s2, e2) in enumerate(zip([0, *eb], eb)) if s2 < e and e2 > s]
            assert (r.b_first[i], r.b_last[i]) == (over[0], over[-1])


def test_words_are_cut_as_by_the_library():
    """Every character alone and between letters, digits, marks and blanks."""
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(BYTES)
    whole.encode_special_tokens = True
    with open(BYTES, "rb") as f:
        table = op13.ByteTokens(f.read())
    chars = [chr(c) for c in [*range(0x3100), *range(0xA000, 0xD800, 7), *range(0xE000, 0x11000, 3), *range(0x11000, 0x110000, 997)]
             if not 0xD800 <= c < 0xE000]
    rnd = random.Random(6)
    found = [f"a{c}b 1{c}2 !{c}? {c}{c}\n{c}'s" for c in chars] + ["".join(rnd.choice(chars) for _ in range(30)) for _ in range(500)]
    ids, n = table.encode(found)
    want = [e.ids for e in whole.encode_batch_fast(found, add_special_tokens=False)]
    assert n.tolist() == [len(x) for x in want] and ids.tolist() == [i for x in want for i in x]


def test_gallop():
    rnd = np.random.default_rng(1)
    for _ in range(200):
        longer = np.unique(rnd.integers(0, 300, rnd.integers(1, 120)))
        driver = np.sort(rnd.integers(0, longer[-1] + 1, 30))
        guess = rnd.integers(0, len(longer), 30)
        got = op13.gallop(driver, longer, np.zeros(30, int), np.full(30, len(longer) - 1), guess)
        assert (got == np.searchsorted(longer, driver)).all()
