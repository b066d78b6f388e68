import random

import numpy as np

from grainmill.llm import leaks as K
from grainmill.llm.letters import gram_hashes, letters


def words(draw, n):
    return " ".join("".join(draw.choice("abcdefghilmnoprstuvz") for _ in range(draw.randrange(2, 9))) for _ in range(n))


def brute(docs, items):
    out = {}
    for d, text in docs:
        doc = set(gram_hashes(letters([text])[0], K.SPAN).tolist())
        for i, item in items:
            codes = letters([item])[0]
            covered = np.zeros(len(codes), bool)
            for p, h in enumerate(gram_hashes(codes, K.SPAN).tolist()):
                if h in doc:
                    covered[p : p + K.SPAN] = True
            if d is not None and i is not None and len(codes) and covered.mean() >= K.FOUND_SHARE:
                out[d, i] = covered.mean()
    return out


def data():
    draw = random.Random(8)
    head = "leggi il brano e scegli la risposta corretta tra quelle date "
    items = [(i, (head if i % 2 else "") + words(draw, draw.randrange(20, 70))) for i in range(25)]
    docs = []
    for d in range(80):
        item = draw.choice(items)[1]
        a, b = sorted((draw.randrange(len(item)), draw.randrange(len(item))))
        part = draw.choice([item, item[a:b], item.upper().replace(" ", " - "), item[: len(item) // 3] + " xq " + item[len(item) // 3 :], head])
        docs.append((d, words(draw, draw.randrange(0, 40)) + " " + part + " " + words(draw, draw.randrange(0, 40))))
    docs += [(900, None), (901, ""), (902, items[3][1] * 30), (None, items[3][1]), docs[0]]
    items += [(500, None), (501, ""), (502, "breve"), (503, items[3][1]), items[3], (None, items[4][1])]
    return docs, items


def frames(spark, docs, items):
    d = spark.createDataFrame(docs, "doc_id bigint, text string").selectExpr("*", "1 as item_id", "2 as share")
    return d, spark.createDataFrame(items, "item_id bigint, text string").selectExpr("*", "1 as doc_id", "'s' as suite")


def test_every_leak_is_found(spark, monkeypatch):
    docs, items = data()
    want = brute(docs, items)
    assert len(want) > 40
    for size in (K.BLOCK_BYTES, 3000):  # in one block and in several
        monkeypatch.setattr(K, "BLOCK_BYTES", size)
        got = {(r.doc_id, r.item_id): r.share for r in K.leaks(*frames(spark, docs, items)).collect() if r.doc_id is not None and r.share >= K.FOUND_SHARE}
        assert got.keys() == want.keys()
        assert all(abs(got[k] - want[k]) < 1e-9 for k in want)
    assert K.leaks_found(*frames(spark, docs, items)).where("doc_id = 902").count() == 2


def test_winnowing_keeps_a_fingerprint_of_every_span():
    draw = random.Random(3)
    codes, ends = letters([words(draw, 80), words(draw, 80)])
    _, place, _ = K.winnow(codes, ends)
    for a, b in zip(ends, ends[1:]):
        for s in range(a, b - K.SPAN + 1):
            assert ((place >= s) & (place <= s + K.SPAN - K.K)).any()


def test_empty_tables(spark):
    docs, items = data()
    assert K.leaks_found(*frames(spark, [], items)).count() == 0
    assert K.leaks_found(*frames(spark, docs, [])).count() == 0
