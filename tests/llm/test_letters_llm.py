import random
import unicodedata

import numpy as np
import pytest

from grainmill.llm import letters as L


def fold(text):
    out = []
    for ch in unicodedata.normalize("NFC", text or ""):
        kind = unicodedata.category(ch)
        if kind[0] in "LM" or kind == "Nd":
            low = "i" if ch in "Iıİ" else ch.lower()[0]
            if low == "̇" and out and out[-1] == "i":
                continue
            out.append(low)
    return "".join(out)


TEXTS = ["İstanbul IŞIK ışık i̇x", None, "", "  ", "a-b_c 12½", "Perché?", "Perché", "हिन्दी की", "ที่นี้", "🙂x🙂", "İ"]


def test_letters():
    codes, ends = L.letters(TEXTS)
    got = ["".join(map(chr, codes[a:b])) for a, b in zip(ends, ends[1:])]
    assert got == [fold(t) for t in TEXTS]
    assert got[5] == got[6]


@pytest.mark.parametrize("k", [1, 2, 3, 7, 11, 12, 25, 30])
def test_gram_hashes_tell_runs_apart(k):
    draw = random.Random(k)
    codes = np.array([draw.randrange(97, 100) for _ in range(400)], np.uint32)
    h = L.gram_hashes(codes, k)
    grams = [bytes(codes[i : i + k]) for i in range(len(codes) - k + 1)]
    assert len(h) == len(grams)
    by = {}
    for g, x in zip(grams, h.tolist()):
        assert by.setdefault(g, x) == x
    assert len(set(by.values())) == len(by)


def test_slices_cover_all_texts_whatever_their_length():
    texts = ["a" * n for n in (5, 0, 900, 3, 3, 3, 2000, 1)] + [None]
    got = list(L.slices(texts, 1000))
    assert [i for a, b in got for i in range(a, b)] == list(range(len(texts)))
    assert all(b - a == 1 or sum(len(t or "") for t in texts[a:b]) <= 1000 for a, b in got)
    assert list(L.slices([])) == []
