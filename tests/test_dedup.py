import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from grainmill.functions import text as T
from grainmill.operators import components as C
from grainmill.operators import consensus, dedup, overlap, relational


def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, text string, source string")


def brute_components(edges):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return {x: find(x) for x in list(parent)}


def labels(spark, edges):
    df = spark.createDataFrame(edges, "a bigint, b bigint")
    return {r.v: r.label for r in C.components(df).collect()}


@pytest.mark.parametrize(
    "edges",
    [
        [],
        [(1, 1), (None, 2)],
        [(1, 2), (2, 1), (1, 2)],
        [(i, i + 1) for i in range(40)],
        [(0, i) for i in range(1, 30)],
        [(i, j) for i in range(5) for j in range(i)] + [(10 + i, 10 + j) for i in range(4) for j in range(i)],
    ],
)
def test_components(spark, edges):
    assert labels(spark, edges) == brute_components(edges)


@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30)), max_size=40))
def test_components_of_any_graph(spark, edges):
    assert labels(spark, edges) == brute_components(edges)


def test_hot_keys_are_joined_apart(spark):
    from grainmill.operators.joins import join_unique

    rows = spark.createDataFrame([(1, i) for i in range(50)] + [(2, 99)], "k int, v int")
    one = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, n string")
    plain, split = (sorted(map(tuple, join_unique(rows, one, ["k"], hot).collect())) for hot in (1000, 10))
    assert plain == split
    assert len(plain) == 51


@pytest.mark.parametrize("few", [0, 1000])
def test_wide_rows_and_lists_of_keys(spark, monkeypatch, few):
    from grainmill.operators import joins

    monkeypatch.setattr(joins, "FEW_KEYS", few)
    rows = spark.createDataFrame([(i % 50 if i % 7 else None, f"t{i}") for i in range(200)], "k bigint, text string").selectExpr("*", "1 as place", "2 as word", "3 as maybe", "4 as bit")
    keys = spark.createDataFrame([(k,) for k in (0, 3, 3, 49, 77, None)], "k bigint")
    got = lambda df: sorted((-1 if r.k is None else r.k, r.text) for r in df.select("k", "text").collect())
    every = got(rows)
    assert got(joins.semi_join_wide(rows, keys, ["k"])) == [r for r in every if r[0] in (0, 3, 49)]
    assert got(joins.anti_join_wide(rows, keys, ["k"])) == [r for r in every if r[0] not in (0, 3, 49)]
    one = keys.where("k is not null").distinct().withColumn("n", F.col("k") * 2)
    met = joins.left_join_wide(rows, one, ["k"])
    assert got(met) == every
    assert {r.k: r.n for r in met.where("n is not null").collect()} == {0: 0, 3: 6, 49: 98}
    assert joins.semi_join_wide(rows, keys.limit(0), ["k"]).count() == 0


def test_no_text_moves_with_the_near_duplicates(spark, tmp_path, monkeypatch):
    """Texts are signed where they are read, and no exchange holds them."""
    from grainmill.operators import joins

    from grainmill import session

    docs(spark, [(i, " ".join(words(i % 3, 30)), "a") for i in range(9)]).write.parquet(str(tmp_path / "t"))
    monkeypatch.setattr(session, "SMALL_TABLE", 0)
    monkeypatch.setattr(session, "BUSY_SHARE", 0)
    monkeypatch.setattr(joins, "FEW_KEYS", 0)
    df = spark.read.parquet(str(tmp_path / "t"))
    assert "Exchange" not in dedup.signatures(df)._jdf.queryExecution().executedPlan().toString()
    assert {r.doc_id for r in dedup.minhash_dedup(df).collect()} == {0, 1, 2}


def words(seed, n=60):
    draw = random.Random(seed)
    return ["".join(draw.choice("abcdefghilmnoprstuvz") for _ in range(5)) for _ in range(n)]


def test_exact_dedup_counts_copies(spark):
    df = docs(spark, [(3, "Uno  due", "a"), (1, "uno due", "b"), (2, "tre", "a"), (4, None, "a"), (5, "", "a"), (6, " ", "b")])
    got = sorted((r.kept, r.copies) for r in dedup.exact_dedup(df).collect())
    assert got == [(1, 2), (2, 1), (5, 2)]


def test_minhash_finds_edited_texts_and_keeps_the_smallest(spark):
    base = words(1, 120)
    edited = [*base]
    edited[50] = "altro"
    rows = [(10, " ".join(base), "a"), (3, " ".join(edited), "b"), (7, " ".join(base).upper(), "c"), (8, " ".join(words(2, 120)), "a"), (9, "a b c d", "a"), (11, "a b c d", "a"), (12, None, "a")]
    kept = {r.doc_id for r in dedup.minhash_dedup(docs(spark, rows)).collect()}
    assert kept == {3, 8, 9, 12}


def test_band_collisions_follow_the_curve(spark):
    """Share of colliding pairs at a similarity against 1 - (1 - s**8)**14."""
    rows, pairs = [], 60
    for i in range(pairs):
        base = words(100 + i, 104)
        edited = [*base]
        for at in (20, 60):  # each changed word changes five of a hundred 5-grams
            edited[at] = "zzzzz"
        rows += [(2 * i, " ".join(base), "a"), (2 * i + 1, " ".join(edited), "b")]
    edges = {(r.a, r.b) for r in dedup.minhash_edges(docs(spark, rows)).collect()}
    met = sum((2 * i, 2 * i + 1) in edges for i in range(pairs)) / pairs
    s = 90 / 110
    assert abs(met - (1 - (1 - s**8) ** 14)) < 0.12
    assert len(edges) <= pairs + 2


def test_cross_source_only(spark):
    base = " ".join(words(5, 80))
    rows = [(1, base, "a"), (2, base, "a"), (3, base, "b"), (4, " ".join(words(6, 80)), "a"), (5, " ".join(words(6, 80)), "a"), (6, base, None)]
    edges = {(r.a, r.b) for r in consensus.cross_source_edges(docs(spark, rows)).collect()}
    assert edges == {(1, 3), (2, 3)}
    got = consensus.minhash_consensus(docs(spark, rows)).collect()
    assert [(r.text, r.source) for r in got] == [(base, ["a", "b"])]


def test_hash_consensus(spark):
    rows = [(1, "Uno due", "b"), (2, "uno  DUE", "a"), (3, "tre", "a"), (4, "tre", "a"), (5, "", "a"), (6, "", "b"), (7, None, "b"), (8, "uno due", None)]
    got = consensus.hash_consensus(docs(spark, rows)).collect()
    assert [(r.text, r.source) for r in got] == [("uno  DUE", ["a", "b"])]
    assert [(r.source, r.documents) for r in consensus.participation(consensus.hash_consensus(docs(spark, rows))).orderBy("source").collect()] == [("a", 1), ("b", 1)]


def test_sentence_dedup(spark):
    shared = [f"questa frase condivisa numero {k} si ripete sempre." for k in ("uno", "due", "tre")]
    own = lambda i: [" ".join(words(1000 + 10 * i + k, 8)) + "." for k in range(8)]
    rows = [(i, " ".join(own(i)[:4] + shared + own(i)[4:]), "a") for i in range(3)] + [(7, " ".join(own(7) + shared[:2]), "a"), (8, " ".join(shared), "a"), (9, None, "a")]
    got = {r.doc_id: r for r in dedup.sentence_dedup(docs(spark, rows)).collect()}
    assert set(got) == {0, 1, 2, 7}  # 8 loses everything, 9 has nothing
    assert got[0].text == " ".join(own(0))
    assert got[0].dropped == 3
    assert got[7].dropped == 0


def test_contents_with_the_same_short_id_stay_apart(spark, monkeypatch):
    """What is written of an id may collide; what is grouped by doesn't."""
    monkeypatch.setattr(T, "doc_id", lambda text, length=12: F.substring(F.concat(F.lit("0" * 12), F.md5(text.cast("binary"))), 1, length))
    df = spark.createDataFrame([(1, "uno", "a"), (2, "due", "a"), (3, "uno", "b"), (4, "tre", "b")], "doc_id bigint, text string, source string")
    zero = "0" * 12
    assert sorted(map(tuple, dedup.exact_dedup(df).collect())) == [(zero, 1, 2), (zero, 2, 1), (zero, 4, 1)]
    assert sorted(map(tuple, relational.keep_first(df).collect())) == [(1, zero), (2, zero), (4, zero)]
    assert [tuple(r) for r in consensus.hash_consensus(df).collect()] == [(zero, "uno", ["a", "b"])]
    assert sorted(map(tuple, consensus.hash_sources(df).collect())) == [(zero, ["a"], 1), (zero, ["a", "b"], 2), (zero, ["b"], 1)]
    assert [(r.overlap, r.pct_of_a) for r in overlap.pairwise_overlap(df).collect()] == [(1, 50.0)]
    assert {r.source: r.documents for r in overlap.unique_documents(df).collect()} == {"a": 2, "b": 2}
    assert [tuple(r) for r in overlap.source_intersect(df, "a", "b").collect()] == [(zero,)]
    assert [tuple(r) for r in overlap.source_except(df, "a", "b").collect()] == [(zero,)]
