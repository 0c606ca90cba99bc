"""Bundled n-gram vectors against a loop over the n-grams, and their memory on a long text of many letters."""

import tracemalloc

import numpy as np
import pytest

from markforge.llm import op1


def looped(text, dimensions, n):
    """Bundle of one text, n-gram by n-gram."""
    profiles = op1.Profiles(dimensions, n)
    codes, out = [0], np.zeros(dimensions)
    for c in text.lower() + " ":
        code = ord(c) if c.isalpha() else 0
        if code or codes[-1]:
            codes.append(code)
    letters = {c: profiles.vectors(np.array([c], np.uint32))[0] for c in set(codes)}
    for i in range(len(codes) - n + 1):
        bound = np.ones(dimensions)
        for j in range(n):
            bound = bound * np.roll(letters[codes[i + j]], n - 1 - j)
        out += bound
    return out


@pytest.mark.parametrize("chunk", [op1.CHUNK, 3])
def test_bundle_agrees_with_a_loop(monkeypatch, chunk):
    monkeypatch.setattr(op1, "CHUNK", chunk)
    for text in ("abc", "Die Katze sitzt, die Katze schl\u00e4ft.", "\u4f60\u597d \u4e16\u754c abc abc", "a1b2  c3"):
        got, has = op1.Profiles(64, 3).bundle([text])
        assert has[0]
        assert got[0].tolist() == looped(text, 64, 3).tolist()


def test_texts_of_a_slice_do_not_mix():
    texts = ["abc def", None, "", "xyz " * 50, "123"]
    together, has = op1.Profiles(64, 3).bundle(texts)
    assert has.tolist() == [True, False, False, True, False]
    assert not together[[1, 2, 4]].any()


def test_a_long_text_of_many_letters_is_bounded():
    text = "".join(map(chr, np.random.default_rng(1).integers(0x4E00, 0x9FA5, 600_000)))  # 1.8 MB
    profiles = op1.Profiles(512, 3)
    tracemalloc.start()
    _, has = profiles.bundle([text])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert has[0] and peak < 300 << 20
