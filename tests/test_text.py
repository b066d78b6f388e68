import hashlib

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from grainmill.functions import text as T

BLANKS = [chr(c) for c in range(0x3001) if chr(c).isspace()]


def column(spark, values, make):
    return [r[0] for r in spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string").coalesce(1).sortWithinPartitions("i").select(make(F.col("s"))).collect()]


def identity(t):
    return hashlib.md5(" ".join(t.lower().split()).encode()).hexdigest()[:12]


def test_blanks_are_those_of_python(spark):
    assert len(BLANKS) == 29
    got = column(spark, [f"{b}a{b}{b}b{b}" for b in BLANKS], T.collapse)
    assert got == ["a b"] * 29


def test_doc_id(spark):
    cases = ["Ciao  Mondo", "ciao mondo", "İstanbul ΟΔΟΣ", "", "  x ", "हिंदी की", None]
    got = column(spark, cases, T.doc_id)
    assert got == [identity(c) if c is not None else None for c in cases]
    assert got[0] == got[1]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet=st.sampled_from("aZ ğé\t \n1."), max_size=12), min_size=1, max_size=20))
def test_words_and_lines_as_in_python(spark, values):
    assert column(spark, values, T.words) == [v.split() for v in values]
    assert column(spark, values, T.word_count) == [len(v.split()) for v in values]
    assert column(spark, values, T.lines) == [[x.strip() for x in v.split("\n") if x.strip()] for v in values]
    assert column(spark, values, T.doc_id) == [identity(v) for v in values]


@pytest.mark.parametrize(("text", "expected"), [("aaaaaa", True), ("aaaaa", False), ("......", False), ("------", False), ("a      b", True), ("\n\n\n\n\n\n", False), ("!!!!!!", True), ("\r" * 6, True), ("", False)])
def test_runs_of_a_character(spark, text, expected):
    assert column(spark, [text], T.has_char_run) == [expected]


def test_duplicate_chars(spark):
    df = spark.createDataFrame([(["ab", "cd", "ab", "ab"],), ([],)], "k array<string>")
    assert [r[0] for r in df.select(T.duplicate_chars(F.col("k"))).collect()] == [4, 0]


def test_ngrams(spark):
    df = spark.createDataFrame([("a b c".split(),), ("a b c d".split(),), ([],)], "w array<string>")
    assert [r[0] for r in df.select(T.ngrams(F.col("w"), 3)).collect()] == [["a b c"], ["a b c", "b c d"], []]


def test_sources_as_list_and_text(spark):
    assert column(spark, ["c4", "", None], T.source_list) == [["c4"], ["unknown"], ["unknown"]]
    df = spark.createDataFrame([(["a", "b"],), ([],), (None,), ([None],), (["a", None],)], "s array<string>")
    assert [r[0] for r in df.select(T.flat_sources(F.col("s"))).collect()] == ["a,b", "consensus", "consensus", "consensus", "a"]


def test_pair_key(spark):
    df = spark.createDataFrame([("b", "a"), ("a", "b")], "x string, y string")
    assert {r[0] for r in df.select(T.pair_key(F.col("x"), F.col("y"))).collect()} == {"a|b"}
