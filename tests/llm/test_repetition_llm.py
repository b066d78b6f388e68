import math
import random

import numpy as np
import pytest

from grainmill.llm import repetition as R
from grainmill.llm.letters import letters


def words(draw, n):
    return " ".join("".join(draw.choice("abcdefghilmnoprstuvz") for _ in range(draw.randrange(2, 9))) for _ in range(n))


def brute_share(text, run=R.RUN):
    codes, _ = letters([text])
    t = codes.tolist()
    covered = [False] * len(t)
    for p in range(len(t) - run + 1):
        if any(t[q : q + run] == t[p : p + run] for q in range(p)):
            covered[p : p + run] = [True] * run
    return sum(covered) / max(1, len(t))


def texts():
    draw = random.Random(5)
    out = [words(draw, 60) for _ in range(40)]
    for i in range(12):
        a = words(draw, 12)
        out.append(words(draw, 12) + (". " + a) * (2 + i % 4))
    return [*out, "ab" * 60, None, "", "...", "corto", "a" * 20_000]


def test_repeated_letters_against_brute_force():
    sample = [t for t in texts() if t is None or len(t) < 2000]
    codes, ends = letters(sample)
    got = R.repeated_letters(codes, ends) / np.maximum(1, np.diff(ends))
    assert got.tolist() == pytest.approx([brute_share(t) for t in sample])


def table(spark, rows):
    return spark.createDataFrame(rows, "rec_id bigint, text string, lang string").selectExpr("*", "1 as n", "'x' as gram", "2 as bits")


def test_found(spark):
    sample = texts()
    rows = [(i, t, ("it", "tr_TR", None)[i % 3]) for i, t in enumerate(sample)] + [(None, sample[0], "it"), (41, sample[41], "it")]
    got = {r.rec_id for r in R.repetition_found(table(spark, rows)).collect()}
    assert got == {i for i, t in enumerate(sample) if t and (i == len(sample) - 1 or brute_share(t) >= R.FOUND_SHARE)}
    out = {r.rec_id: r for r in R.repetition(table(spark, rows)).collect()}
    assert out[len(sample) - 5].repeated_share == 0.0
    assert out[len(sample) - 5].perplexity is None


def test_found_where_most_of_a_language_repeats(spark):
    """What is found depends on a text alone: copies of one heavily repeated text don't hide milder repetition."""
    draw = random.Random(9)
    a = words(draw, 12)
    heavy = words(draw, 2) + (". " + a) * 20
    mild = [words(draw, 4) + (". " + b) * 2 for b in (words(draw, 16) for _ in range(10))]
    plain = [words(draw, 60) for _ in range(20)]
    rows = [(i, t, "it") for i, t in enumerate([heavy] * 60 + mild + plain)]
    want = {i for i, t, _ in rows if brute_share(t) >= R.FOUND_SHARE}
    assert set(range(60)) < want  # some mild ones as well
    assert {r.rec_id for r in R.repetition_found(table(spark, rows)).collect()} == want
    verdicts = {r.rec_id: r.verdict for r in R.repetition(table(spark, rows)).collect()}
    assert all(verdicts[i] == "low" for i in want)
    assert not any(verdicts[i] == "low" for i in range(70, 90))


def test_empty(spark):
    assert R.repetition_found(table(spark, [])).count() == 0


def test_model_is_a_distribution():
    """Over all letters that can follow, the probabilities of a context add up to one (but for the share of the unseen)."""
    codes, ends = letters(["abracadabra abba", "cabab", "bac"])
    grams, counts = np.unique(R.trigrams(codes, ends), return_counts=True)
    m = R.KneserNey(grams, counts)
    symbols = R.symbol_table()
    seen = sorted({int(symbols[c]) for c in codes.tolist()})
    for x, y in ["ab", "br", "zz", "  "]:
        a, b = (0, 0) if x == " " else (int(symbols[ord(x)]), int(symbols[ord(y)]))
        packed = np.array([(a << 14) | (b << 7) | c for c in seen], np.int64)
        total = float(np.exp2(m.log2p(packed)).sum())
        assert 0.9 < total <= 1.0 + 1e-9


def test_discounts():
    n = np.array([1] * 10 + [2] * 5 + [3] * 3 + [4] * 2)
    d = R.KneserNey.discounts(n)
    y = 10 / 20
    assert d[1:].tolist() == pytest.approx([1 - 2 * y * 5 / 10, 2 - 3 * y * 3 / 5, 3 - 4 * y * 2 / 3])


def test_history_makes_repeats_cheap():
    draw = random.Random(1)
    a = words(draw, 30)
    codes, ends = letters([words(draw, 60), a + " " + a])
    base = np.full(len(codes), math.log2(1 / 20))
    full = R.history_share(codes, ends, base)
    first, second = (-full[x:y].mean() for x, y in zip(ends, ends[1:]))
    assert first == pytest.approx(math.log2(20), rel=0.02)
    assert second < 0.62 * first


def test_symbols_keep_the_letters_of_an_alphabet_apart():
    table = R.symbol_table()
    assert 0 < table.min() and table.max() < R.SYMBOLS
    for letters_of in ("abcdefghijklmnopqrstuvwxyz0123456789çğöşüàèéìòù", "".join(map(chr, range(0x0E01, 0x0E4F))), "".join(map(chr, range(0x0905, 0x094E))), "".join(map(chr, range(0x0621, 0x0653)))):
        assert len({int(table[ord(c)]) for c in letters_of}) == len(letters_of)


def test_millions_of_letter_trigrams(spark):
    """A large alphabet has more trigrams than any table of them could hold; nothing is pruned and the rows are the same."""
    draw = np.random.default_rng(3)
    plain = ["".join(map(chr, draw.integers(0x4E00, 0x9FA5, 4000).tolist())) for _ in range(550)]
    twice = ["".join(map(chr, draw.integers(0x4E00, 0x9FA5, 60).tolist())) * 2 for _ in range(10)]
    codes, _ = letters(plain)
    wide = codes.astype(np.int64)
    assert len(np.unique(wide[:-2] << 42 | wide[1:-1] << 21 | wide[2:])) > 2_000_000
    df = table(spark, [(i, t, "zh") for i, t in enumerate(plain + twice)])
    assert {r.rec_id for r in R.repetition_found(df).collect()} == set(range(550, 560))
    model = R.fit(df)[R.LANGS.index("und")]
    assert 500_000 < len(model.tri) <= R.SYMBOLS**3


def test_a_predictable_half_beside_a_random_one(spark):
    """A run of one letter costs few bits even without history; the text is still reached."""
    draw = random.Random(4)
    runs = [words(draw, 20) + " " + "a" * 120 for _ in range(60)]
    plain = [words(draw, 60) for _ in range(60)]
    rows = [(i, t, "it") for i, t in enumerate(runs + plain)]
    want = {i for i, t, _ in rows if brute_share(t) >= R.FOUND_SHARE}
    assert len(want) > 50
    assert {r.rec_id for r in R.repetition_found(table(spark, rows)).collect()} == want


def test_languages_have_models_of_their_own(spark):
    draw = random.Random(8)
    rows = [(i, words(draw, 30), ("it", "tr")[i % 2]) for i in range(10)] + [(20, "में है और " * 9, "it")]
    models = R.fit(table(spark, rows))
    assert [len(m.tri) > 0 for m in models] == [True, True, False, True, False, False]
