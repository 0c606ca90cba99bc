import random
import re

from markforge.llm import op8

WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text):
    return re.findall(WORDS, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def scan(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r for _, r in sorted((r.doc_id, r) for r in op8.license_scan(df).collect())]


def places(text, template):
    w, t = words(text), words(template)
    return [i for i in range(len(w) - len(t) + 1) if w[i:i + len(t)] == t]


def test_every_template_is_found_at_its_places(spark):
    rnd = random.Random(3)
    filler = [f"w{i}" for i in range(300)]
    texts = []
    for label, template in op8.TEMPLATES.items():
        parts = [" ".join(rnd.choice(filler) for _ in range(rnd.randrange(1, 30))) for _ in range(3)]
        texts.append(f"{parts[0]}\n{template}\n{parts[1]} {template}. {parts[2]}")
    for (label, template), text, r in zip(op8.TEMPLATES.items(), texts, scan(spark, texts)):
        n = len(words(template))
        assert [(s.start, s.end, s.share) for s in r.spans if s.label == label] == [(i, i + n, 1.0) for i in places(text, template)], label
        # any other label is that of a template which stands whole in this one, or nearly so
        for s in r.spans:
            assert s.share == 1.0 and places(template, op8.TEMPLATES[s.label]), (label, s.label)
        assert r.score == 1.0


def test_base_counts_by_brute_force(spark):
    rnd = random.Random(4)
    bag = ["MIT", "license", "Apache", "general", "public", "license,", "x", "GNU", "\n", "é"]
    texts = [" ".join(rnd.choice(bag) for _ in range(rnd.randrange(40))) for _ in range(200)] + [None, "", "!?"]
    for text, r in zip(texts, scan(spark, texts)):
        at = [(i, label) for phrase, label in op8.BASE_PHRASES.items() for i in places(text, phrase)]
        assert (r.n_words, r.n_base, r.base_labels) == (len(words(text)), len(at), ",".join(sorted({x for _, x in at})))
        assert (r.first_word, r.last_word) == ((min(at)[0], max(at)[0]) if at else (None, None))


def test_near_texts_and_neighbours(spark):
    t = op8.TEMPLATES
    reworded = t["mit"].replace("any person", "any natural person").replace("substantial portions", "large portions")
    texts = ["he said all rights reserved seats are taken", reworded, t["agpl-3.0"], t["lgpl-2.1"], t["gpl-2.0"],
             "// SPDX-License-Identifier: MIT\n// SPDX-License-Identifier: MIT\n// SPDX-License-Identifier: GPL-3.0-or-later",
             t["isc"].replace("any purpose", "every purpose"), "this program is free software and so is that one"]
    got = scan(spark, texts)
    assert got[0].labels == "" and got[0].score == 0.0 and got[7].labels == ""
    assert "mit" in got[1].labels.split(",") and 0.9 < [s for s in got[1].spans if s.label == "mit"][0].share < 1
    assert [set(r.labels.split(",")) for r in got[2:5]] == [{"agpl-3.0"}, {"lgpl-2.1"}, {"gpl", "gpl-2.0", "gpl-notice"}] or \
        [set(r.labels.split(",")) - {"gpl"} for r in got[2:5]] == [{"agpl-3.0"}, {"lgpl-2.1"}, {"gpl-2.0", "gpl-notice"}]
    assert [(s.label, s.start) for s in sorted(got[5].spans, key=lambda s: s.start)] == [("spdx:mit", 0), ("spdx:mit", 4), ("spdx:gpl-3.0-or-later", 8)]
    assert got[6].labels == "isc"
    found = scan(spark, [t["bsl-1.0"], t["cc0-1.0"], t["unlicense"], t["bsd-3-clause"], t["zlib"]])
    assert [r.labels for r in found] == ["bsl-1.0", "cc0-1.0", "unlicense", "bsd-3-clause", "zlib"]
