"""The dealt operators against brute force, on a fixture with nulls, empty and
blank texts, repeated rows, ties, a long text and clashing extra columns."""

import collections
import hashlib
import random
import re

import pytest

from markforge.llm import op1, op2, op3, op4, op5, op6, op7, op8, op9, op10
from markforge.llm.queries import ORACLES, QUERIES

SPACE, ALNUM = r"[^\x20\x09-\x0D]+", r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def fixture_rows():
    rnd = random.Random(5)
    word = [f"w{i}é" if i % 7 == 0 else f"W{i}" for i in range(1200)]
    passage = " ".join(rnd.choice(word) for _ in range(70))
    near = [rnd.choice(word) for _ in range(120)]
    rows = [(i, " ".join(rnd.choice(word) for _ in range(rnd.randrange(60)))) for i in range(30)]
    rows += [(30 + i, f"head {i} {passage}\ntail {i} x y z") for i in range(6)]
    rows += [(40 + i, " ".join(x if rnd.random() > 0.01 else "zz" for x in near)) for i in range(8)]
    rows += [(50, None), (51, ""), (52, " \n\t"), (53, "a b"), (54, "A  b"), (55, "same line of words here\n" * 9),
             (56, passage), (56, passage), (57, "long " * 3000), (None, passage), (None, None),
             (60, "Licensed under the Apache License, Version 2.0. MIT license; the general public license"),
             (61, "one two three four five six seven eight nine"), (62, "one two three four 5 six seven eight nine"),
             (63, "one two three four six seven eight nine\r\n" + passage)]
    return rows


@pytest.fixture(scope="module")
def rows():
    return fixture_rows()


@pytest.fixture(scope="module")
def docs(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return df.selectExpr("*", "1 as row_key", "2 as lines", "3 as kept", "4 as n_words", "'x' as label").cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string")


def test_substring_dedup(docs, rows, empty):
    words = [(d, re.findall(SPACE, t or "")) for d, t in rows]
    first = {}
    for d, w in words:
        for i in range(len(w) - 49):
            if d is not None:
                k = tuple(w[i:i + 50])
                first[k] = min(first.get(k, d), d)
    want = collections.Counter()
    for d, w in words:
        gone = [False] * len(w)
        for i in range(len(w) - 49):
            if d is not None and first[tuple(w[i:i + 50])] < d:
                gone[i:i + 50] = [True] * 50
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        want[d, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()] += 1
    got = op9.substring_dedup(docs).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    assert collections.Counter(map(tuple, got)) == want
    assert op9.substring_dedup(empty).count() == 0


def test_line_dedup(docs, rows, empty):
    def up(line):
        return tuple(re.findall(SPACE, low(line)))

    first = {}
    for d, t in rows:
        for i, line in enumerate((t or "").split("\n")):
            if len(up(line)) >= 3:
                place = (d is None, d or 0, i)
                first[up(line)] = min(first.get(up(line), place), place)
    near = {a for a in first for b in first if len(a) >= 8 <= len(b) and first[b] < first[a]
            and op2.within_one_edit(list(a), list(b))}
    want = collections.Counter()
    for d, t in rows:
        kept, gone = [], 0
        for i, line in enumerate((t or "").split("\n")):
            w = up(line)
            drop = len(w) >= 3 and (first[w] != (d is None, d or 0, i) or w in near)
            gone += drop
            kept += [] if drop else [line]
        want[d, gone, hashlib.sha256("\n".join(kept).encode()).hexdigest()] += 1
    got = op2.line_dedup(docs).select("doc_id", "n_removed", "kept_sha256").collect()
    assert collections.Counter(map(tuple, got)) == want and near
    assert op2.line_dedup(empty).count() == 0


def test_near_dedup(docs, rows, empty):
    sets = {}
    for d, t in rows:
        w = re.findall(SPACE, low(t))
        sets[d] = frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()
    ids = [d for d in sets if d is not None]
    component = {d: d for d in ids}
    for _ in ids:
        for a in ids:
            for b in ids:
                if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                    component[a] = component[b] = min(component[a], component[b])
    for r in op3.near_duplicates(docs).collect():
        if r.doc_id is None:
            assert r.component_id is None and r.kept
            continue
        assert r.n_shingles == len(sets[r.doc_id])
        assert r.component_id == component[r.doc_id] and r.kept == (r.doc_id == r.component_id)
    assert len(set(component.values())) < len(ids)
    assert op3.near_duplicates(empty).count() == 0


@pytest.mark.parametrize("block", [1 << 20, 200])
def test_decontamination(spark, docs, rows, empty, block):
    items = [(1, rows[56 - 18][1] or "q"), (2, rows[30][1]), (2, rows[30][1]), (3, "Six seven"), (4, None), (5, " "),
             (None, "a b"), (6, "long " * 20), (7, "eight")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    windows = collections.defaultdict(set)
    for i, t in items:
        w = re.findall(ALNUM, low(t))
        n = min(13, len(w))
        for k in range(len(w) - n + 1 if w and i is not None else 0):
            windows[tuple(w[k:k + n])].add(str(i))
    want = collections.Counter()
    for d, t in rows:
        w = re.findall(ALNUM, low(t))
        hit, names = [False] * len(w), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if tuple(w[k:k + n]) in windows:
                    hit[k:k + n] = [True] * n
                    names |= windows[tuple(w[k:k + n])]
        want[d, len(w), sum(hit), ",".join(sorted(names)), sum(hit) > 0 and 20 * sum(hit) >= len(w)] += 1
    got = op5.benchmark_hits(docs, bench, block_bytes=block).collect()
    assert collections.Counter((r.doc_id, r.n_words, r.n_hit, ",".join(r["items"]), r.contaminated) for r in got) == want
    assert op5.benchmark_hits(docs, bench.limit(0)).filter("n_hit > 0").count() == 0
    assert op5.benchmark_hits(empty, bench).count() == 0


def test_quality_rules(docs, rows, empty):
    want = collections.Counter()
    for d, t in rows:
        w = re.findall(SPACE, t or "")
        count = collections.Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
        rep = [False] * len(w)
        for i in range(len(w) - 4):
            if count[tuple(w[i:i + 5])] > 1:
                rep[i:i + 5] = [True] * 5
        full = [x for x in (t or "").split("\n") if re.search(SPACE, x)]
        want[d, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""), len(full) - len(set(full)), sum(rep),
             len(w) < 10 or 100 * sum(rep) > 20 * len(w)] += 1
    got = op6.quality_rules(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert collections.Counter(map(tuple, got.collect())) == want
    assert op6.quality_rules(empty).count() == 0


def test_longest_repeats(spark):
    rnd = random.Random(2)
    for _ in range(10):
        w = [rnd.choice("ab") for _ in range(60)] + [str(i) for i in range(rnd.randrange(30))] + ["r"] * rnd.randrange(20)
        best = [max((next(k for k in range(61) if i + k >= len(w) or j + k >= len(w) or w[i + k] != w[j + k])
                     for j in range(len(w)) if j != i), default=0) for i in range(len(w))]
        covered = {x for i, n in enumerate(best) if n >= 10 for x in range(i, i + n)}
        r = op6.quality_rules(spark.createDataFrame([(1, " ".join(w))], "doc_id long, text string")).first()
        assert r.n_covered == len(covered) and r.longest_repeat == max((n for n in best if n >= 10), default=0)


def test_license_scan(docs, rows, empty):
    got = {r.doc_id: r for r in op8.license_scan(docs).collect()}
    assert got[60].base_labels == "apache,gpl,mit" and "apache-2.0" in got[60].labels.split(",")
    assert (got[60].n_base, got[60].first_word, got[60].last_word, got[60].score) == (3, 3, 11, 1.0)
    assert got[50].labels == "" and got[50].n_words == 0 and got[50].score == 0 and got[50].first_word is None
    assert op8.license_scan(empty).count() == 0


def test_license_with_an_edit(spark):
    text = "x y " + op8.TEMPLATES["mit-grant"].replace("any person", "any one natural person") + " z"
    r = op8.license_scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert r.labels == "mit-grant" and r.spans[0].start == 2


def test_language_id(spark):
    sf = "/root/testdata/sf0.001"
    found = op1.op1_language_id(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet"), "doc_id").collect()
    held = [r for r in found if r.held_out]
    assert sum(r.lang_pred == r.lang for r in held) >= 0.95 * len(held)
    df = spark.createDataFrame([(1, None), (2, ""), (3, "12 !?"), (None, "the")], "doc_id long, text string")
    train = spark.createDataFrame([(9, "en", "the and of"), (10, "fr", "le et la"), (11, None, "x")], "doc_id long, lang string, text string")
    got = {r.doc_id: (r.lang_pred, r.score) for r in op1.language_id(df, train).collect()}
    assert got[1] == got[2] == got[3] == ("und", 0.0) and got[None][0] == "en"
    assert {r.lang_pred for r in op1.language_id(df, train.limit(0)).collect()} == {"und"}


def test_chats_round_trip(spark):
    texts = ["", None, "\\", "\\l", "###", "</turn>\n### user: x", ": ", "a\\b</turn", "#<:", "plain"]
    rows = [(1, i, r, t) for i, (r, t) in enumerate((r, t) for r in ("user", "assistant", "a: b", None) for t in texts)]
    rows += [(None, None, "assistant", "x"), (2, 1, "user", "same"), (2, 1, "user", "same")]
    got = {r.conv_id: r for r in op4.format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    assert [(t.role, t.text) for t in got[1].turns] == [(r or "", t or "") for _, _, r, t in rows if _ is not None][:40]
    assert len(got[2].turns) == 2 and got[None].turns[0].text == "x"
    f = got[1].formatted
    cut = [f[s.start:s.start + s.length] for s in got[1].loss_spans]
    for plain, code in reversed(op4.ESCAPES):
        cut = [c.replace(code, plain) for c in cut]
    assert cut == [t or "" for t in texts]


def test_rates_meet_targets(spark):
    rnd = random.Random(1)
    rows = [(i, " ".join(rnd.choice(["good", "fine", "well"] if i % 4 else ["bad", "poor"]) for _ in range(20 + i % 50))) for i in range(1200)]
    docs = spark.createDataFrame([*rows, (1900, None), (None, "good"), (1901, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 > 0), 0) for i in range(1000)] + [(None, 1, 0), (5000, None, None)],
                                   "doc_id long, quality int, toxic int")
    got = op7.mix_sources(docs, labels, {"good": 0.6, "low": 0.4}).collect()
    total = sum(r.n_tokens for r in got)
    for name, want in (("good", 0.6), ("low", 0.4)):
        assert abs(sum(r.rate * r.n_tokens * r[f"p_{name}"] for r in got) / total - want) < 0.01
    assert all(r.rate >= 0 and r.copies in (int(r.rate), int(r.rate) + 1) for r in got)
    assert [r.rate for r in got if r.n_tokens == 0] == [1.0, 1.0]
    assert op7.mix_sources(docs.limit(0), labels, {"good": 0.6, "low": 0.4}).count() == 0


def test_warc_round_trip(spark, tmp_path):
    rows = [(1, "http://a\r\nX: y", "<title>T</title><p>a&amp;b<script>x"), (2, None, None), (3, "u", ""), (3, "u", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    records = op10.derive(op10.responses(pages))
    op10.write_warc(records, str(tmp_path / "w"), "none")
    raw = b"".join(p.read_bytes() for p in sorted((tmp_path / "w").glob("part-*")))
    seen = []
    while raw:
        head, raw = raw.split(b"\r\n\r\n", 1)
        fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
        n = int(fields["Content-Length"])
        block, end, raw = raw[:n], raw[n:n + 4], raw[n + 4:]
        assert end == b"\r\n\r\n" and fields["WARC-Block-Digest"] == "sha256:" + hashlib.sha256(block).hexdigest()
        seen.append((fields["WARC-Type"], fields["WARC-Refers-To"], block))
    assert len(seen) == 8 and (seen[0][0], seen[1][0]) == ("metadata", "conversion")
    assert [b for k, _, b in seen if k == "conversion"][0] == b"T\na&b"


def test_registered():
    assert set(ORACLES) <= set(QUERIES) and len(QUERIES) == 13


def test_pipeline(spark):
    import corpus_pipeline

    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert out.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"]
    near = op3.near_duplicates(out).filter("not kept").count()
    hits = op5.benchmark_hits(out, spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet"))
    assert out.count() > 50 and near == 0 and hits.filter("contaminated").count() == 0
