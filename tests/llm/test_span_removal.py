import random
import re

import pytest

from markforge.llm import op5

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def removed_by_hand(text, items, max_words, percent):
    """Hit words found window by window, then cut from the text."""
    places = [m.span() for m in WORD.finditer(low(text))]
    words = [low(text)[a:b] for a, b in places]
    hit = set()
    for item in items:
        w = WORD.findall(low(item))
        n = min(13, len(w))
        for j in range(len(w) - n + 1 if n else 0):
            for i in range(len(words) - n + 1):
                if words[i:i + n] == w[j:j + n]:
                    hit.update(range(i, i + n))
    windows = sorted(hit)
    spans = []
    for i in windows:
        if spans and spans[-1][1] == i:
            spans[-1][1] = i + 1
        else:
            spans.append([i, i + 1])
    covered = bool(hit) and 100 * len(hit) >= percent * len(words)
    gone = [s for s in spans if covered or s[1] - s[0] > max_words]
    out, at = "", 0
    for a, b in gone:
        piece = text[at:places[a][0]]
        out, at = out + piece, places[b - 1][1]
        if (piece == "" or piece[-1] in " \t") and text[at:at + 1] in (" ", "\t", ""):
            at += len(text[at:at + 1])
    return out + text[at:], sum(b - a for a, b in gone)


@pytest.mark.parametrize("block", [1 << 20, 200])
def test_spans_are_cut_by_their_bytes(spark, block):
    rnd = random.Random(11)
    filler = [f"W{i}é" if i % 5 == 0 else f"w{i}" for i in range(400)]
    items = [" ".join(f"q{i}_{j}" if j % 3 else f"Q{i}, x{j}" for j in range(18)) for i in range(6)] + ["Short item!", "", None]
    texts = [None, "", "?!", "no hit here at all", items[0], f"\t{items[1]}\n", f"{items[2]} {items[3]}", "short  ITEM", items[4] * 2]
    for n in (0, 5, 60, 900):
        for i in range(4):
            body = [" ".join(rnd.choice(filler) for _ in range(n)) for _ in range(2)]
            texts.append(f"{body[0]}: {items[i].upper()}.\n\n{body[1]}  short item; {' '.join(items[i + 1].split()[:11])} end")
    rows = [(i, t, "clash", -1) for i, t in enumerate(texts)] + [(None, items[0], "x", 0), (4, items[0], "clash", -1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept_text string, n_removed long")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    hits = op5.benchmark_hits(docs, bench, block_bytes=block, keep_text=True)
    for max_words, percent in ((13, 5), (13, 100), (0, 1000)):
        got = op5.remove_spans(hits, max_words, percent).collect()
        assert len(got) == len(rows)
        for r in got:
            if r.text is None:
                assert r.kept_text is None and r.n_removed == 0
                continue
            expected = removed_by_hand(r.text, [x for x in items if x], max_words, percent)
            assert (r.kept_text, r.n_removed) == expected
    assert op5.remove_spans(op5.benchmark_hits(docs.limit(0), bench, keep_text=True)).count() == 0
