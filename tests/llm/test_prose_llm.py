import random

import numpy as np
import pytest

from grainmill.llm import prose as P
from grainmill.llm.examples import EXAMPLES
from grainmill.llm.stats import NAMES, Parsed, statistics

PROSE = [t for c, t in EXAMPLES if c == "prose"]
OTHER = [t for c, t in EXAMPLES if c != "prose"]


def stat(text):
    return dict(zip(NAMES, statistics(Parsed([text]))[0]))


def test_simple_statistics():
    s = stat("Il gatto dorme.\nLa casa è grande 12")
    assert s["words"] == pytest.approx(np.log1p(7))
    assert s["word_length"] == pytest.approx((2 + 5 + 5 + 2 + 4 + 1 + 6) / 7)
    assert s["ended_lines"] == 0.5
    assert s["ends_per_word"] == pytest.approx(1 / 7)
    assert s["digit_share"] == pytest.approx(2 / 28)
    assert s["common_share"] == pytest.approx(3 / 7)
    assert s["word_variety"] == 1.0
    assert stat("a_b c1 d")["odd_tokens"] == pytest.approx(2 / 3)


@pytest.mark.parametrize("text", [None, "", " \n ", "...", "​"])
def test_nothing_gives_zeros(text):
    assert not np.any([v for k, v in stat(text).items() if k in ("words", "word_length", "common_share", "prose_share")])


@pytest.mark.parametrize("text", PROSE[:5])
def test_sentences_stand_among_common_words(text):
    assert stat(text)["prose_share"] > 0.7


@pytest.mark.parametrize("text", OTHER)
def test_other_texts_do_not(text):
    assert stat(text)["prose_share"] < 0.4


def test_texts_do_not_touch_each_other():
    texts = [PROSE[0], OTHER[0], None, PROSE[3], OTHER[5], ""]
    together = statistics(Parsed(texts))
    assert np.allclose(together, np.concatenate([statistics(Parsed([t])) for t in texts]))


def test_a_repeated_phrase_weighs_once():
    assert stat(PROSE[0] + " tavolo rosso pane vino sale" * 60)["prose_share"] > 0.6


def corpus():
    rows = []
    for i in range(30):
        for j, (_, t) in enumerate(EXAMPLES):
            half = len(t) * 2 // 3
            rows.append((1000 * i + j, t[i % 5 : half + 3 * i] if j else t))
    return rows


def table(spark, rows):
    return spark.createDataFrame(rows, "rec_id bigint, text string").selectExpr("*", "1 as words", "'x' as class")


def test_found(spark):
    extra = [(1, None), (2, ""), (3, "—"), (4, "▲▼ *#|<+ ★★ ◆/"), (5, " "), (6, PROSE[0].lower().replace(".", "").replace(" ", "\n", 3)), (None, OTHER[0]), (7, OTHER[0]), (7, OTHER[0])]
    rows = [(i + 100, t) for i, t in corpus()] + extra
    got = {r.rec_id for r in P.not_prose_found(table(spark, rows)).collect()}
    assert {4, 7} <= got
    assert not got & {1, 2, 3, 5, 6}
    kinds = {c: set() for c in ("prose", "other")}
    for i, _ in corpus():
        kinds["prose" if EXAMPLES[i % 1000][0] == "prose" else "other"].add(i + 100)
    assert len(got & kinds["prose"]) <= 0.05 * len(kinds["prose"])
    assert len(got & kinds["other"]) >= 0.95 * len(kinds["other"])
    assert {r["class"] for r in P.classify(table(spark, rows)).collect()} <= {*P.CLASSES, "none"}


def test_small_and_empty_tables(spark):
    assert P.not_prose_found(table(spark, [])).count() == 0
    assert P.not_prose_found(table(spark, [(1, None), (2, "")])).count() == 0
    assert [r.rec_id for r in P.not_prose_found(table(spark, [(1, OTHER[0]), (2, PROSE[0])])).collect()] == [1]


NAMES_OF_THINGS = ["".join(random.Random(i).choice("bcdfghklmnprstvw") + random.Random(i + 7).choice("aeiou") + random.Random(i + k).choice("bdglmnrst") for k in range(2)) + str.lower("SHIP"[i % 4]) for i in range(900)]
VERBS = "crosses follows watches carries reaches opens leaves finds keeps paints".split()


def english(draw):
    noun, verb = (lambda: draw.choice(NAMES_OF_THINGS)), (lambda: draw.choice(VERBS))
    return " ".join(f"The {noun()} of the {noun()} {verb()} a {noun()} and it {verb()} the {noun()} in the {noun()}." for _ in range(draw.randrange(3, 8)))


def test_another_language_is_no_junk(spark):
    """Its common words are learned from the corpus; its lists are still lists."""
    draw = random.Random(12)
    rows = [(i + 100, t, "it") for i, t in corpus()] + [(100_000 + i, english(draw), ("en", "EN-us")[i % 2]) for i in range(120)]
    rows += [(200_000 + i, "\n".join(f"• {draw.choice(NAMES_OF_THINGS)} {draw.choice(NAMES_OF_THINGS)}" for _ in range(9)), "en") for i in range(20)]
    df = spark.createDataFrame(rows, "rec_id bigint, text string, lang string")
    learned = P.learned_words(df)
    assert 0 < len(learned) <= 1 / P.LEAST_WORDS
    got = {r.rec_id for r in P.not_prose_found(df).collect()}
    assert len([i for i in got if 100_000 <= i < 200_000]) <= 6
    assert len([i for i in got if i >= 200_000]) >= 18
    assert len(P.learned_words(df.where("lang = 'it'"))) == len(P.learned_words(df.limit(0))) == 0
