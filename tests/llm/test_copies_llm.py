import json
import random

import pytest

from grainmill.llm import copies as C
from grainmill.llm import near as N
from grainmill.llm.fields import fields_of
from grainmill.llm.letters import gram_hashes, letters

FIELDS = [("nome", "Rossi Mario"), ("città", "Torino"), ("anno", "1968")]


def notations(fields):
    return ["\n".join(f"{n}: {v}" for n, v in fields), "; ".join(f"{n} = {v}" for n, v in fields), json.dumps(dict(fields), ensure_ascii=False), "\n".join(f"| {n} | {v} |" for n, v in fields), "\n".join(f"{n}\t{v}" for n, v in fields), json.dumps(dict(fields), indent=2).replace(" ", " ")]


@pytest.mark.parametrize("text", notations(FIELDS))
def test_fields_in_every_notation(text):
    assert sorted((n.replace(" ", " "), v.replace(" ", " ")) for n, v in fields_of(text)) == sorted(FIELDS)


@pytest.mark.parametrize("text", [None, "", "una frase sola", "a: b", "riga uno\nriga due", "a | b | c\nd | e | f", "{", "{}", "x\n: y\nz: w"])
def test_no_fields(text):
    assert fields_of(text) is None


SENTENCE = "Il gatto dorme, la notte è lunga e nessuno parla."
ROWS = [
    (5, SENTENCE), (2, SENTENCE.upper()), (9, "il\tgatto dorme la  notte è lunga e nessuno parla"), (7, SENTENCE), (1, "altro testo"),
    *((20 + i, t) for i, t in enumerate(notations(FIELDS))), (40, notations(FIELDS[::-1])[0]), (41, notations(FIELDS[:2])[0]),
    (50, None), (51, ""), (52, "..."), (53, "—"), (None, SENTENCE), (5, SENTENCE),
]


def table(spark, rows, extra=True):
    df = spark.createDataFrame(rows, "rec_id bigint, text string")
    return df.selectExpr("*", "'x' as key", "1 as copies", "'y' as letters_key", "3 as bucket") if extra else df


def test_copies_found(spark):
    got = {(r.keep_rec_id, r.rec_id) for r in C.copies_found(table(spark, ROWS)).collect()}
    assert got == {(2, 5), (2, 9), (2, 7), *((20, 20 + i) for i in range(1, 6)), (20, 40)}


def test_counts(spark):
    got = {r.keep_rec_id: r.copies for r in C.collapse_copies(table(spark, ROWS)).collect()}
    assert got == {2: 6, 1: 1, 20: 7, 41: 1}


def test_one_letter_string_read_as_two_field_sets(spark):
    rows = [(1, "ab: c\nd: e"), (2, "a: bc\nd: e"), (3, "d: e\na: bc"), (4, "d: e\nab: c"), (9, "x: y\nz: w")]
    got = {(r.keep_rec_id, r.rec_id) for r in C.copies_found(table(spark, rows)).collect()}
    assert got == {(1, 2), (1, 3), (1, 4)}


def test_empty(spark):
    assert C.copies_found(table(spark, [])).count() == 0
    assert N.near_found(table(spark, [])).count() == 0


def test_buckets_split_until_they_fit(spark):
    draw = random.Random(3)
    keys = [bytes([0, draw.randrange(2), draw.randrange(3), *range(13)]) for _ in range(300)] + [bytes(16)] * 200
    rows = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "key binary, keep_id bigint")
    want = {}
    for i, k in enumerate(keys):
        n, least = want.get(k, (0, i))
        want[k] = (n + 1, min(least, i))
    for size in (7, 50, 10_000):
        assert {bytes(r.key): (r.copies, r.keep_id) for r in C.radix_count(rows, size).collect()} == want


def test_hot_groups_join_by_broadcast(spark, monkeypatch):
    monkeypatch.setattr(C, "HOT_COPIES", 2)
    got = {(r.keep_rec_id, r.rec_id) for r in C.copies_found(table(spark, ROWS)).collect()}
    assert (2, 9) in got
    assert (20, 40) in got
    assert len(got) == 9


def words(draw, n):
    return ["".join(draw.choice("abcdefghilmnoprstuvz") for _ in range(draw.randrange(2, 9))) for _ in range(n)]


def near_rows():
    draw, rows = random.Random(11), []
    for i in range(60):
        base = words(draw, draw.randrange(12, 120))
        rows.append((10 * i, " ".join(base)))
        for j in range(draw.randrange(0, 4)):
            edited = [*base]
            for _ in range(draw.randrange(1, 6)):
                edited[draw.randrange(len(edited))] = draw.choice(["", "nuovo", words(draw, 1)[0]])
            rows.append((10 * i + 1 + j, " ".join(edited).title() if j % 2 else " ".join(edited)))
    return [*rows, (9001, rows[0][1] + "!"), (9002, None), (9003, ""), (9004, "corto"), (9005, "corto"), (None, rows[0][1]), rows[1]]


def brute_pairs(rows, least=N.LEAST):
    sets = {}
    for i, t in rows:
        if i is not None and t:
            codes, _ = letters([t])
            sets[i] = (bytes(codes), set(gram_hashes(codes, N.RUN).tolist()))
    out, close = set(), 0
    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            (ca, ga), (cb, gb) = sets[a], sets[b]
            if ga and gb and ca != cb:
                s = len(ga & gb) / len(ga | gb)
                close += 0.55 < s < 0.65
                if s >= least:
                    out.add((a, b))
    return out


@pytest.mark.parametrize("bucket", [1000, 3])
def test_near_pairs_against_all_pairs(spark, monkeypatch, bucket):
    """With tiny buckets the pairs come from the chunked join, and none is lost."""
    monkeypatch.setattr(N, "BUCKET_ROWS", bucket)
    rows = near_rows()
    got = {(r.rec_id_a, r.rec_id_b) for r in N.near_found(table(spark, rows)).collect()}
    sure = brute_pairs(rows, 0.65)
    assert len(sure) > 40
    assert sure <= got
    assert got <= brute_pairs(rows)


def test_reordered_fields_are_no_near_pair(spark):
    many = [(f"nome{i}", f"valore numero {i} della lista") for i in range(12)]
    changed = [*many[:-1], ("nome11", "qualcosa di diverso")]
    rows = [(1, notations(many)[0]), (2, notations(many[::-1])[0]), (3, notations(changed)[0])]
    got = {(r.rec_id_a, r.rec_id_b) for r in N.near_found(table(spark, rows)).collect()}
    assert (1, 2) not in got
    assert (1, 3) in got


def test_block_pairs_over_batches():
    """A bucket that spans batches is one bucket."""
    import numpy as np
    import pyarrow as pa

    keys = np.sort(np.random.default_rng(5).integers(0, 40, 400))
    ids = np.arange(400)
    want = {(a, b) for a in range(400) for b in range(a + 1, 400) if keys[a] == keys[b]}
    for size in (1, 7, 400):
        batches = [pa.RecordBatch.from_arrays([pa.array(keys[i : i + size]), pa.array(ids[i : i + size])], ["key", "id"]) for i in range(0, 400, size)]
        got = {(a, b) for out in N._bucket_pairs(iter(batches)) for a, b in zip(out.column(0).to_pylist(), out.column(1).to_pylist())}
        assert got == want


def test_pairs_of_representatives_and_members(spark, monkeypatch):
    """A text of very many copies gives one representative; the pairs don't grow with the square of the copies."""
    from grainmill.operators import joins

    monkeypatch.setattr(C, "HOT_COPIES", 100)
    monkeypatch.setattr(joins, "FEW_KEYS", 0)
    draw = random.Random(21)
    base = words(draw, 40)
    edited = " ".join([*base[:20], "altro", *base[21:]])
    df = table(spark, [(9, edited), (8, edited.upper()), *near_rows()[:40]])
    copies = spark.range(20_000).selectExpr("id + 100000 as rec_id", f"'{' '.join(base)}' as text")
    df = df.select("rec_id", "text").unionByName(copies)
    pairs = {(r.rec_id_a, r.rec_id_b) for r in N.near_pairs(df).collect()}
    assert (8, 100000) in pairs
    assert not any(a > 100000 or b > 100000 for a, b in pairs)
    of = {r.rec_id: (r.class_id, r.links) for r in N.near_members(df).collect()}
    assert of[9] == (8, 1) and of[100000 + 19_999] == (100000, 1)
