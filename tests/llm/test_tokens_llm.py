import random

import numpy as np
import pyarrow as pa
import pytest
import regex

from grainmill.llm import budget as B
from grainmill.llm import encode as E
from grainmill.llm.pretokens import cut

PATTERN = regex.compile(r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")
MODEL = f"{E.TOKENIZERS}/piece_bpe_32k.model"
TEXTS = ["Ciao, il mondo!", None, "", "  due  spazi\n\n\tfine ", "हिन्दी की किताब", "ที่นี้ไม่มี", "أن هذا", "🙂🙂 emojí", "<|endoftext|> ordinario", "I'll don't we've 's", "a" * 3000, " x y", "▁▁ già", "x\x00y", "   ", "parola " * 400]


def fuzz(n, seed=4):
    draw = random.Random(seed)
    alphabet = "ab 's''t re'ves ll 'll  \n\n\t é1२４क़्ी'd'm'M'S!?..,\xa0   ’ʼ▁ที่"
    return ["".join(draw.choice(alphabet) for _ in range(draw.randrange(0, 25))) for _ in range(n)]


def test_pretokens_against_the_pattern():
    texts = [t or "" for t in TEXTS] + fuzz(8000)
    joined, at, first, hashes = cut(texts)
    words = {}
    for i, t in enumerate(texts):
        bounds = at[first[i] : first[i + 1] + 1]
        got = [joined[a:b] for a, b in zip(bounds, bounds[1:])]
        assert got == PATTERN.findall(t)
        for w, h in zip(got, hashes[first[i] : first[i + 1]].tolist()):
            assert words.setdefault(h, w) == w
    assert len(set(words.values())) == len(words)


def slices_of(texts, limit):
    from grainmill.llm.letters import slices

    return slices(texts, limit)


def test_packing():
    for n in (0, 1, 1000):
        x = np.random.default_rng(n).integers(0, 1 << 20, n).astype(np.uint32)
        assert (E.unpack(E.pack(x)) == x).all()


def table(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").selectExpr("*", "1 as chunk", "2 as kind", "'z' as data", "'s' as source", "'it' as lang", "cast(null as string) as domain")


def test_ids_are_those_of_the_tokenizer(spark):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(f"{E.TOKENIZERS}/byte_bpe_50k.json")
    t.encode_special_tokens = True
    texts = [*TEXTS, *fuzz(400), TEXTS[0]]
    df = table(spark, texts).repartition(5)
    got = {r.doc_id: r.ids for r in E.encode(df).collect()}
    assert got == {i: t.encode(x or "", add_special_tokens=False).ids for i, x in enumerate(texts)}
    assert all(r.same for r in E.round_trip(df).collect())


def test_encode_empty_table(spark):
    assert E.encode(table(spark, [])).count() == 0
    assert E.encode(table(spark, [None, ""])).where("size(ids) = 0").count() == 2


def test_reassembly_over_small_batches():
    words = [b"x", b"yy", b"zzz"]
    rows = [(1, 0, i, np.array([i] * len(w), np.int32).tobytes()) for i, w in enumerate(words)] + [(1, 1, 77, E.pack(np.array([2, 0, 1, 2])))] + [(2, 1, 78, E.pack(np.zeros(0, np.uint32)))]
    for size in (1, 2, 5):
        batches = [E._rows(r[0], r[1], [r[2]], [r[3]]) for r in rows]
        merged = [pa.Table.from_batches(batches[i : i + size]).combine_chunks().to_batches()[0] for i in range(0, len(batches), size)]
        out = [row for b in E._reassemble(iter(merged)) for row in b.to_pylist()]
        assert out == [{"doc_id": 77, "ids": [2, 2, 2, 0, 1, 1, 2, 2, 2]}, {"doc_id": 78, "ids": []}]


@pytest.fixture(scope="module")
def pieces():
    with open(MODEL, "rb") as f:
        return B.sentencepiece_vocabulary(f.read())


def test_bpe_counts_are_the_tokenizers(pieces):
    import sentencepiece

    vocabulary, model = pieces
    own, whole = sentencepiece.SentencePieceProcessor(model_proto=model), sentencepiece.SentencePieceProcessor(model_file=MODEL)
    texts = [*TEXTS, *fuzz(2000)]
    got, estimate = B.count_tokens(vocabulary, texts, lambda parts: [len(x) for x in own.encode(parts, num_threads=1)])
    want = [len(whole.encode(t)) if t else 0 for t in texts]
    assert got.tolist() == want
    assert abs(estimate.sum() / sum(want) - 1) < 0.05


def slow_viterbi(word, scores, unknown):
    best = [(0.0, 0)] + [(-1e18, 0)] * len(word)
    for j in range(1, len(word) + 1):
        for i in range(j):
            s = scores.get(word[i:j], unknown if j - i == 1 else None)
            if s is not None:
                c = 1 if word[i:j] in scores else len(word[i:j].encode())
                old = best[j]
                new = (best[i][0] + s, best[i][1] + c)
                if new[0] > old[0] + 1e-9 or (abs(new[0] - old[0]) <= 1e-9 and new[1] < old[1]):
                    best[j] = new
    return best[-1][1]


def unigram(seed):
    draw = random.Random(seed)
    pieces = {"".join(draw.choice("abcè") for _ in range(draw.randrange(1, 5))) for _ in range(40)} | {"a", "b", "▁", "▁a", "▁ab", "▁▁"}
    return {p: -draw.random() * 5 - 0.1 for p in pieces}


@pytest.mark.parametrize("seed", range(4))
def test_viterbi_against_brute_force_and_a_unigram_tokenizer(seed):
    from tokenizers import Tokenizer, models

    scores = unigram(seed)
    v = B.Vocabulary(scores)
    draw = random.Random(seed + 50)
    texts = ["".join(draw.choice("abcè d\n") for _ in range(draw.randrange(0, 30))) for _ in range(300)] + ["ab" * 700, None]
    _, got = B.count_tokens(v, texts)
    want = [slow_viterbi("▁" + t.replace(" ", "▁"), scores, v.unknown) if t else 0 for t in texts]
    assert got.tolist() == want
    known = [t for t in texts if t and not set(t) - set("ab ")]
    model = Tokenizer(models.Unigram([("<unk>", -100.0), *scores.items()], unk_id=0, byte_fallback=False))
    for t in known:
        path = model.encode("▁" + t.replace(" ", "▁")).tokens
        assert "".join(path) == "▁" + t.replace(" ", "▁")
        mine = B.count_tokens(v, [t])[1][0]
        assert sum(scores[x] for x in path) <= 0
        assert mine == len(path) or abs(mine - len(path)) <= 1  # ties


def test_trie():
    values = {"a": 1, "ab": 2, "abc": 3, "b": 4, "ç": 5, "zz": 6}
    t = B.DoubleArray(values)
    for word in [*values, "ac", "abcd", "z", "q", "bb"]:
        state = np.zeros(1, np.int32)
        for ch in word:
            if state[0] >= 0:
                state = t.walk(state, t.symbol(np.array([ord(ch)])))
        got = t.value[state[0]] if state[0] >= 0 else -1
        assert got == values.get(word, -1)


def test_budget_by_slice(spark):
    rows = [("uno due", "a", "it", "x"), ("uno", "a", "it", "x"), (None, "a", "it", None), ("", None, None, ""), ("tre", "A ", "it-IT", "x")]
    df = spark.createDataFrame(rows, "text string, source string, lang string, domain string").selectExpr("*", "1 as tokens")
    got = {(r.source, r.lang, r.domain): (r.records, r.tokens) for r in B.token_budget(df).collect()}
    assert {k: v[0] for k, v in got.items()} == {("a", "it", "x"): 2, ("a", "it", None): 1, (None, None, ""): 1, ("A ", "it-IT", "x"): 1}
    assert got["a", "it", None][1] == 0
    slices = {(r.slice, r.key): r.records for r in B.token_slices(df).collect()}
    assert slices == {("source", "a"): 4, ("source", None): 1, ("lang", "it"): 4, ("lang", "und"): 1, ("domain", "x"): 3, ("domain", None): 2}
    assert B.token_budget(df.limit(0)).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_long_segments_go_through_blocks(seed, monkeypatch):
    monkeypatch.setattr(B, "BLOCK", 16)
    monkeypatch.setattr(B, "TABLE", 2000)
    scores = unigram(seed)
    v = B.Vocabulary(scores)
    draw = random.Random(seed)
    texts = ["".join(draw.choice("abcè") for _ in range(draw.randrange(1, 400))) for _ in range(60)]
    _, got = B.count_tokens(v, texts)
    assert got.tolist() == [slow_viterbi("▁" + t, scores, v.unknown) for t in texts]


def test_a_million_letters_without_a_blank(pieces):
    import time

    draw = np.random.default_rng(2)
    text = "".join(map(chr, draw.integers(97, 123, 1_000_000).tolist()))
    began = time.perf_counter()
    _, got = B.count_tokens(pieces[0], [text])
    assert time.perf_counter() - began < 20  # seconds, where a pass by place would take minutes
    assert 300_000 < got[0] < 700_000


def test_chunks_end_after_so_many_characters(spark, monkeypatch):
    """Long texts make more chunks, not larger ones, and the ids are the same."""
    df = table(spark, [f"parola{i % 7} " * (i % 50) for i in range(300)] + ["x y " * 3000, None, ""])
    want = {r.doc_id: r.ids for r in E.encode(df).collect()}
    chunks = []
    monkeypatch.setattr(E, "CHUNK_CHARS", 500)
    monkeypatch.setattr(E, "MOST_WORDS", 40)
    monkeypatch.setattr("grainmill.llm.letters.SLICE_CHARS", 300)

    class Context:
        partitionId = staticmethod(lambda: 3)

    monkeypatch.setattr(E.TaskContext, "get", lambda: Context)
    monkeypatch.setattr(E, "slices", lambda texts: slices_of(texts, 300))
    batch = pa.RecordBatch.from_pandas(df.select("doc_id", "text").toPandas())
    rows = [r for b in E._to_words(iter([batch])) for r in b.to_pylist()]
    chunks = sorted({r["chunk"] for r in rows})
    assert len(chunks) > 20
    texts = {r["doc_id"]: len(r["text"] or "") for r in batch.to_pylist()}
    for c in chunks:
        held = [texts[r["number"]] for r in rows if r["chunk"] == c and r["kind"] == 1]
        assert sum(held) - max(held) < 1000
    got = {r.doc_id: r.ids for r in E.encode(df).collect()}
    assert got == want
