"""Near-duplicate texts: fingerprints cut into blocks, joined on blocks, verified by Hamming distance.

A text is its set of distinct runs of ``RUN`` letters, similarity is the Jaccard share of two sets. The
fingerprint has ``BLOCKS * WIDTH`` components of 16 bits (one-permutation min-hash, empty bins filled from
others), so that the share of agreeing components estimates the similarity. By the pigeonhole principle two
fingerprints at a Hamming distance below ``BLOCKS`` components agree on a whole block; of pairs further apart a
share (1 - s**WIDTH) ** BLOCKS is missed, 7e-5 at similarity 0.65. Where the distance does not decide, the runs
of both texts are compared.

Equal letters are collapsed before the join and expanded after it. A block bucket of more than ``BUCKET_ROWS``
texts is not held by one task: it is cut into chunks and every pair of chunks is joined by itself. Records of very many
copies, and representatives with very many partners, are joined by broadcast, apart from the others.

Defined results: null texts and texts of fewer than ``RUN`` letters are similar to nothing; repeated rows of an
id give one pair; pairs that are the same record but for formatting are left out; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import join_unique, semi_join_wide
from ..session import drop_steps, materialize, write_step
from .copies import field_digests, join_hot, letter_digests, same_records
from .frames import fixed_binary, map_texts, named
from .letters import U64, gram_hashes, gram_owner, letters, mix

RUN = 12
BLOCKS = 30
WIDTH = 3
SIZE = BLOCKS * WIDTH
LEAST = 0.6
#: Estimates outside this band decide without the texts, if both sets have MANY runs at least.
SURE_NO, SURE_YES, MANY = 0.38, 0.78, 4 * SIZE
SHORT_NO, SHORT_YES = 0.15, 0.97
BUCKET_ROWS = 1000
_NO_ID = (1 << 63) - 1  # the head of records without an id
_EMPTY = np.uint32(0xFFFFFFFF)
_ROUNDS = 24


def fingerprints(codes: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One row of ``SIZE`` 16-bit components per text, and the number of runs of each."""
    n = len(ends) - 1
    place, owner = gram_owner(ends, RUN, len(codes))
    h = mix(gram_hashes(codes, RUN)[place]) if len(place) else np.zeros(0, U64)
    low = np.full(n * SIZE, _EMPTY, np.uint32)
    np.minimum.at(low, owner * SIZE + ((h >> U64(32)) % U64(SIZE)).astype(np.int64), (h & U64(0xFFFFFFFE)).astype(np.uint32))
    low = low.reshape(n, SIZE)
    runs = np.bincount(owner, minlength=n)
    full = low.copy()
    draw = np.random.default_rng(20240607)
    for _ in range(_ROUNDS):  # an empty bin borrows from the same drawn bin in every text
        lender = draw.integers(0, SIZE, SIZE)
        np.copyto(full, low[:, lender], where=full == _EMPTY)
    rest = np.flatnonzero((full == _EMPTY).any(axis=1) & (runs > 0))
    for i in rest:  # very few runs: the next filled bin
        filled = np.flatnonzero(low[i] != _EMPTY)
        at = np.flatnonzero(full[i] == _EMPTY)
        full[i, at] = low[i, filled[np.searchsorted(filled, at) % len(filled)]]
    return (mix(full.astype(U64)) & U64(0xFFFF)).astype(np.uint16), runs


def signatures(df: DataFrame, id_col: str = "rec_id", text_col: str = "text") -> DataFrame:
    """``rec_id, letters_key, fields_key, runs, print`` of every record with at least one letter."""

    def work(rest: dict, texts: list) -> dict:
        codes, ends = letters(texts)
        prints, runs = fingerprints(codes, ends)
        keep = pa.array(np.diff(ends) > 0)
        made = {"rec_id": rest["rec_id"], "letters_key": pa.array(letter_digests(codes, ends), pa.binary()), "fields_key": pa.array(field_digests(texts), pa.binary()), "runs": pa.array(runs.astype(np.int32)), "print": pa.array([p.tobytes() if r else b"" for p, r in zip(prints, runs)], pa.binary())}
        return {k: v.filter(keep) for k, v in made.items()}

    return map_texts(named(df, rec_id=id_col, text=text_col), work, "rec_id bigint, letters_key binary, fields_key binary, runs int, print binary")


def _block_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per text and block; the key is the block's number and its components."""
    for batch in batches:
        n = batch.num_rows
        if n:
            prints = np.frombuffer(fixed_binary(batch.column("print")), np.uint16).reshape(n, BLOCKS, WIDTH).astype(np.int64)
            keys = np.broadcast_to(np.arange(BLOCKS, dtype=np.int64), (n, BLOCKS)).copy()
            for w in range(WIDTH):
                keys = keys << 16 | prints[:, :, w]
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(np.repeat(batch.column("rec_id").to_numpy(), BLOCKS))], ["key", "id"])


_PAIRS_ARROW = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("large", pa.int64())])


def _bucket_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by key. Pairs (a < b) of the small buckets; members of large ones as (id, null, key)."""
    key, large, held = None, False, np.zeros(0, np.int64)

    def out(a: np.ndarray, b: np.ndarray | None, key: int | None = None) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(a), pa.nulls(len(a), pa.int64()) if b is None else pa.array(b), pa.nulls(len(a), pa.int64()) if key is None else pa.array(np.full(len(a), key))], schema=_PAIRS_ARROW)

    def close() -> pa.RecordBatch | None:
        if large:
            return out(held, None, key) if len(held) else None
        return out(*_all_pairs(held)) if len(held) > 1 else None

    for batch in batches:
        if not batch.num_rows:
            continue
        keys, ids = batch.column("key").to_numpy(), batch.column("id").to_numpy()
        first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        sizes = np.diff(np.r_[first, len(keys)])
        inner = np.zeros(len(first), bool)
        inner[1:-1] = sizes[1:-1] <= BUCKET_ROWS
        if (pairs := _grouped_pairs(ids, first[inner & (sizes > 1)], sizes[inner & (sizes > 1)])) is not None:
            yield out(*pairs)
        for g in np.flatnonzero(~inner):  # the buckets at the batch's ends, and large ones
            own = ids[first[g] : first[g] + sizes[g]]
            if keys[first[g]] != key:
                if (rows := close()) is not None:
                    yield rows
                key, large, held = int(keys[first[g]]), False, own[:0]
            held = np.concatenate([held, own])
            if len(held) > BUCKET_ROWS or large:
                large = True
                yield out(held, None, key)
                held = held[:0]
    if key is not None and (rows := close()) is not None:
        yield rows


def _all_pairs(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    i, j = np.triu_indices(len(ids), 1)
    return np.minimum(ids[i], ids[j]), np.maximum(ids[i], ids[j])


def _grouped_pairs(ids: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    found = []
    for size in np.unique(sizes):
        rows = ids[first[sizes == size][:, None] + np.arange(size)]
        i, j = np.triu_indices(size, 1)
        found.append((np.minimum(rows[:, i], rows[:, j]).ravel(), np.maximum(rows[:, i], rows[:, j]).ravel()))
    return tuple(np.concatenate(x) for x in zip(*found)) if found else None


def block_join(prints: DataFrame) -> DataFrame:
    """Distinct pairs ``a, b`` (a < b) of rows ``rec_id, print`` that agree on at least one block."""
    rows = prints.select("rec_id", "print").mapInArrow(_block_rows, "key bigint, id bigint")
    met = materialize(rows.repartition("key").sortWithinPartitions("key").mapInArrow(_bucket_pairs, "a bigint, b bigint, large bigint"), "met")
    pairs = met.where("large is null").select("a", "b")
    members = met.where("large is not null").select(F.col("large").alias("key"), F.col("a").alias("id"))
    if not members.isEmpty():
        pairs = pairs.unionByName(_chunk_pairs(members))
    return pairs.where("a <> b").distinct()


def _chunk_pairs(members: DataFrame) -> DataFrame:
    """All pairs of large buckets, joined chunk by chunk: a group holds two chunks, whatever the bucket's size."""
    chunks = members.groupBy("key").agg(F.ceil(F.count("*") / BUCKET_ROWS).cast("int").alias("n"))
    rows = members.join(chunks, "key").withColumn("own", F.pmod(F.xxhash64("id"), F.col("n")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    rows = rows.select("key", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", "id")
    left, right = rows.withColumnRenamed("id", "a").withColumnRenamed("own", "own_a"), rows.withColumnRenamed("id", "b").withColumnRenamed("own", "own_b")
    met = left.join(right, ["key", "low", "high"]).where("a < b and (own_a <> own_b or low = high)")
    return met.select("a", "b")


def _add_brief(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The low byte of each component is enough to count the agreeing ones."""
    for batch in batches:
        if batch.num_rows:
            low = np.frombuffer(fixed_binary(batch.column("print")), np.uint8)[::2].reshape(batch.num_rows, SIZE)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([x.tobytes() for x in low], pa.binary())], ["rec_id", "runs", "print", "brief"])


def _share(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Share of agreeing components of each pair."""
    for batch in batches:
        if batch.num_rows:
            x, y = (np.frombuffer(fixed_binary(batch.column(c)), np.uint8).reshape(-1, SIZE) for c in ("brief_a", "brief_b"))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), batch.column("runs"), pa.array((x == y).mean(axis=1))], ["a", "b", "runs", "share"])


def jaccard_of_runs(left: list[str | None], right: list[str | None], k: int = RUN) -> np.ndarray:
    """Exact share of distinct runs that both texts of each pair hold."""
    out = np.zeros(len(left))
    for i, (x, y) in enumerate(zip(left, right)):
        codes, ends = letters([x, y])
        p, q = (np.unique(gram_hashes(codes[a:b], k)) for a, b in zip(ends, ends[1:]))
        both = len(np.intersect1d(p, q, assume_unique=True))
        out[i] = both / max(1, len(p) + len(q) - both)
    return out


def _check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = pa.array(jaccard_of_runs(batch.column("text_a").to_pylist(), batch.column("text_b").to_pylist()) >= LEAST)
        yield pa.RecordBatch.from_arrays([batch.column(c).filter(keep) for c in ("a", "b")], ["a", "b"])


def similar_representatives(df: DataFrame, signed: DataFrame, reps: DataFrame, id_col: str = "rec_id", text_col: str = "text") -> DataFrame:
    """Pairs ``a, b`` of representatives (one of each letter class) with at least ``LEAST`` of their runs in common."""
    prints = materialize(reps.where("runs > 0").select("rec_id", "runs", "print").mapInArrow(_add_brief, "rec_id bigint, runs int, print binary, brief binary"), "prints")
    a, b = (prints.select(F.col("rec_id").alias(s), F.col("brief").alias(f"brief_{s}"), F.col("runs").alias(f"runs_{s}")) for s in "ab")
    pairs = materialize(block_join(prints), "candidates")
    both = join_unique(join_unique(pairs, a, ["a"]), b, ["b"]).withColumn("runs", F.least("runs_a", "runs_b"))
    shares = materialize(both.select("a", "b", "runs", "brief_a", "brief_b").mapInArrow(_share, "a bigint, b bigint, runs int, share double"), "shares")
    drop_steps(prints, pairs)
    long = F.col("runs") >= MANY
    sure = shares.where(F.col("share") > F.when(long, SURE_YES).otherwise(SHORT_YES))
    open_ = shares.where((F.col("share") <= F.when(long, SURE_YES).otherwise(SHORT_YES)) & (F.col("share") >= F.when(long, SURE_NO).otherwise(SHORT_NO)))
    named_texts = named(df, rec_id=id_col, text=text_col)
    needed = materialize(open_.select(F.explode(F.array("a", "b")).alias("rec_id")).distinct(), "needed")
    texts = materialize(semi_join_wide(named_texts, needed, ["rec_id"]).dropDuplicates(["rec_id"]), "texts")  # only these are moved
    ta, tb = (texts.select(F.col("rec_id").alias(s), F.col("text").alias(f"text_{s}")) for s in "ab")
    checked = join_unique(join_unique(open_.select("a", "b"), ta, ["a"]), tb, ["b"]).select("a", "b", "text_a", "text_b").mapInArrow(_check, "a bigint, b bigint")
    return sure.select("a", "b").unionByName(checked)


def _classes(df: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """``rec_id, member, keep_id`` of all records, and the similar pairs ``a, b`` of their representatives ``rec_id``."""
    signed = materialize(signatures(df, id_col, text_col), "signed")
    sets, classes = write_step(same_records(df, keys=signed).select("letters_key", "head", "keep_id", "copies"), "sets", n=F.count_if(F.col("head") < _NO_ID))
    met = join_hot(signed.where("rec_id is not null"), sets, "letters_key")
    met, rows = write_step(met.select("head", "rec_id", "keep_id", "runs", F.when(F.col("head") == F.col("rec_id"), F.col("print")).alias("print")), "classes", n=F.count("print"))
    drop_steps(signed, sets)
    reps = met.where("print is not null").select("rec_id", "runs", "print")
    if rows["n"] != classes["n"]:  # rows repeated under one id
        reps = reps.dropDuplicates(["rec_id"])
    return met.select(F.col("head").alias("rec_id"), F.col("rec_id").alias("member"), "keep_id").distinct(), similar_representatives(df, signed, reps, id_col, text_col)


def near_pairs(df: DataFrame, id_col: str = "rec_id", text_col: str = "text") -> DataFrame:
    """``rec_id_a, rec_id_b`` (a < b): similar pairs of representatives, the smallest record of each letter string. With
    ``near_members`` they say all that ``near_found`` does, without its square of the copies."""
    members, pairs = _classes(df, id_col, text_col)
    sets = members.where("rec_id = member").select("rec_id", "keep_id")
    a, b = (sets.select(F.col("rec_id").alias(s), F.col("keep_id").alias(f"set_{s}")) for s in "ab")
    return pairs.join(a, "a").join(b, "b").where("set_a <> set_b").select(F.least("a", "b").alias("rec_id_a"), F.greatest("a", "b").alias("rec_id_b")).distinct()


def near_members(df: DataFrame, id_col: str = "rec_id", text_col: str = "text") -> DataFrame:
    """``rec_id, class_id, links`` of every record with letters: its representative and how many others that is similar to."""
    members, pairs = _classes(df, id_col, text_col)
    links = pairs.select(F.explode(F.array("a", "b")).alias("class_id")).groupBy("class_id").agg(F.count("*").alias("links"))
    return members.select(F.col("member").alias("rec_id"), F.col("rec_id").alias("class_id")).join(links, "class_id", "left").select("rec_id", "class_id", F.coalesce("links", F.lit(0)).cast("bigint").alias("links"))


def near_found(df: DataFrame, id_col: str = "rec_id", text_col: str = "text") -> DataFrame:
    """``rec_id_a, rec_id_b`` (a < b) of all similar records that are not the same record."""
    members, pairs = _classes(df, id_col, text_col)
    ma, mb = (members.select(F.col("rec_id").alias(s), F.col("member").alias(f"m_{s}"), F.col("keep_id").alias(f"set_{s}")) for s in "ab")
    met = pairs.join(ma, "a").join(mb, "b").where("set_a <> set_b")
    return met.select(F.least("m_a", "m_b").alias("rec_id_a"), F.greatest("m_a", "m_b").alias("rec_id_b")).distinct()
