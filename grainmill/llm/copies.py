"""Copies hidden by formatting: canonical bytes, recursive radix partitioning, counting tries.

Two records are the same if their letters are equal in order, or if both are lists of named fields with the
same set of (name, value) pairs. The canonical bytes of a record are the 128-bit digest of its letters (and
of its sorted field set): every key has the same length and the radix buckets are even however alike the
texts begin, and 16 bytes a record move through the cluster, not the text.

Defined results: a null, empty or letterless text is no copy of anything; a row with a null id counts as a
copy but is not listed; rows repeated under one id count once in the listing; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import join_unique
from ..session import materialize, write_step
from .fields import fields_of
from .frames import fixed_binary, map_texts, named
from .letters import letters

KEY_BYTES = 16
#: Rows of one radix bucket; what one trie may hold at a time.
BUCKET_ROWS = 2_000_000
#: Groups with more copies than this are joined by broadcast: there are at most (rows / HOT_COPIES) of them.
HOT_COPIES = 100_000


def digest(data: bytes) -> bytes:
    return blake2b(data, digest_size=KEY_BYTES).digest()


def letter_digests(codes: np.ndarray, ends: np.ndarray) -> list[bytes | None]:
    raw = memoryview(np.ascontiguousarray(codes)).cast("B")
    return [digest(raw[4 * a : 4 * b]) if b > a else None for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]


def field_digests(texts: list[str | None]) -> list[bytes | None]:
    found = [(i, pairs) for i, t in enumerate(texts) if (pairs := fields_of(t))]
    flat = [s for _, pairs in found for pair in pairs for s in pair]
    codes, ends = letters(flat)
    raw, at = codes.tobytes(), (4 * ends).tolist()
    out: list[bytes | None] = [None] * len(texts)
    j = 0
    for i, pairs in found:
        own = sorted({(raw[at[j + 2 * k] : at[j + 2 * k + 1]], raw[at[j + 2 * k + 1] : at[j + 2 * k + 2]]) for k in range(len(pairs))})
        j += 2 * len(pairs)
        if any(n for n, _ in own):
            out[i] = digest(b"".join(len(x).to_bytes(4, "little") + x for pair in own for x in pair))
    return out


def canonical_keys(df: DataFrame, id_col: str = "rec_id", text_col: str = "text") -> DataFrame:
    """``rec_id, letters_key, fields_key``; the keys are null for texts without letters or without fields."""

    def work(rest: dict, texts: list) -> dict:
        codes, ends = letters(texts)
        return {"rec_id": rest["rec_id"], "letters_key": pa.array(letter_digests(codes, ends), pa.binary()), "fields_key": pa.array(field_digests(texts), pa.binary())}

    return map_texts(named(df, rec_id=id_col, text=text_col), work, "rec_id bigint, letters_key binary, fields_key binary")


class CountingTrie:
    """Trie over keys of ``KEY_BYTES``, two bytes a level, whose terminals count copies and keep the smallest id.

    The levels are built for all keys at once: a node is the rank of its (parent, symbol) pair.
    """

    def __init__(self) -> None:
        self.keys = np.zeros(0, f"V{KEY_BYTES}")
        self.copies = self.least = np.zeros(0, np.int64)

    def add(self, keys: np.ndarray, copies: np.ndarray, least: np.ndarray) -> None:
        keys, copies, least = np.concatenate([self.keys, keys]), np.concatenate([self.copies, copies]), np.concatenate([self.least, least])
        symbols = keys.view(">u2").reshape(len(keys), -1)
        node = np.zeros(len(keys), np.int64)
        for level in range(symbols.shape[1]):
            _, first, node = np.unique(node * 65536 + symbols[:, level], return_index=True, return_inverse=True)
        self.keys = keys[first]
        self.copies = np.zeros(len(first), np.int64)
        np.add.at(self.copies, node, copies)
        self.least = np.full(len(first), np.iinfo(np.int64).max)
        np.minimum.at(self.least, node, least)

    def batch(self, schema: pa.Schema) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(self.keys.tolist(), pa.binary()), pa.array(self.copies), pa.array(self.least)], schema=schema)


_COUNTED = "key binary, copies bigint, keep_id bigint"
_COUNTED_ARROW = pa.schema([("key", pa.binary()), ("copies", pa.int64()), ("keep_id", pa.int64())])


def _arrays(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    keys = np.frombuffer(fixed_binary(batch.column("key")), f"V{KEY_BYTES}")
    return keys, batch.column("copies").to_numpy(), batch.column("keep_id").to_numpy()


def _combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per key and batch, so that a hot key reaches the shuffle a batch's times less often."""
    for batch in batches:
        if batch.num_rows:
            (trie := CountingTrie()).add(*_arrays(batch))
            yield trie.batch(_COUNTED_ARROW)


def _count_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows come sorted by bucket; a bucket's trie is emitted as soon as the next bucket begins."""
    trie, bucket, waiting, rows = CountingTrie(), None, [], 0

    def flush() -> None:
        nonlocal waiting, rows
        if waiting:
            trie.add(*(np.concatenate(x) for x in zip(*waiting)))
            waiting, rows = [], 0

    for batch in batches:
        if not batch.num_rows:
            continue
        own = batch.column("bucket").to_pylist()
        cuts = [0, *(i for i in range(1, len(own)) if own[i] != own[i - 1]), len(own)]
        arrays = _arrays(batch)
        for a, b in zip(cuts, cuts[1:]):
            if own[a] != bucket:
                flush()
                if bucket is not None:
                    yield trie.batch(_COUNTED_ARROW)
                trie, bucket = CountingTrie(), own[a]
            waiting.append(tuple(x[a:b] for x in arrays))
            rows += b - a
            if rows > BUCKET_ROWS:  # only copies of one key can come to this; they collapse
                flush()
    flush()
    if bucket is not None:
        yield trie.batch(_COUNTED_ARROW)


def radix_count(rows: DataFrame, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``key, copies, keep_id`` of rows ``key, keep_id`` with a non-null key of ``KEY_BYTES`` bytes.

    Buckets are key prefixes: those of one byte that hold too many rows are split by the second byte, and so on. The
    oversized prefixes of a level, at most (rows / bucket_rows), are a table that is joined by broadcast.
    """
    combined = materialize(rows.where("key is not null").selectExpr("key", "1L as copies", "coalesce(keep_id, 9223372036854775807L) as keep_id").mapInArrow(_combine, _COUNTED), "radix")
    cut = combined.withColumn("bucket", F.substring("key", 1, 1))
    for depth in range(1, KEY_BYTES):
        of_depth = cut.where(F.length("bucket") == depth)
        large, seen = write_step(of_depth.groupBy("bucket").count().where(F.col("count") > bucket_rows).select("bucket", F.lit(True).alias("large")), "large", n=F.count("*"))
        if not seen["n"]:
            break
        cut = cut.join(F.broadcast(large), "bucket", "left").withColumn("bucket", F.when(F.col("large"), F.substring("key", 1, depth + 1)).otherwise(F.col("bucket"))).drop("large")
    spread = cut.select("key", "copies", "keep_id", "bucket").repartition("bucket").sortWithinPartitions("bucket")
    return spread.mapInArrow(_count_buckets, _COUNTED)


def join_hot(rows: DataFrame, groups: DataFrame, on: str, copies: str = "copies") -> DataFrame:
    """Inner join of rows with their groups; the groups of very many copies don't gather their rows in a task."""
    hot, cold = groups.where(F.col(copies) > HOT_COPIES), groups.where(F.col(copies) <= HOT_COPIES)
    return rows.join(F.broadcast(hot), on).unionByName(rows.join(cold, on))


def same_records(df: DataFrame, id_col: str = "rec_id", text_col: str = "text", keys: DataFrame | None = None) -> DataFrame:
    """``letters_key, head, keep_id, copies`` for every letter class: its own and its set's smallest id, its own copies."""
    keys = materialize(canonical_keys(df, id_col, text_col), "keys") if keys is None else keys
    classes = materialize(radix_count(keys.selectExpr("letters_key as key", "rec_id as keep_id")), "classes").withColumnRenamed("key", "letters_key")
    links = keys.where("letters_key is not null and fields_key is not null").select("letters_key", "fields_key").distinct()
    links = materialize(links.join(classes.select("letters_key", F.col("keep_id").alias("label")), "letters_key"), "links")
    while True:  # a second round is needed only where one letter string can be read as several field sets
        sets = materialize(radix_count(links.selectExpr("fields_key as key", "label as keep_id")).select(F.col("key").alias("fields_key"), F.col("keep_id").alias("set_label")), "sets")
        moved = join_unique(links, sets, ["fields_key"]).groupBy("letters_key").agg(F.min("set_label").alias("new_label"))
        moved = materialize(links.join(moved, "letters_key").select("letters_key", "fields_key", "label", "new_label"), "labels")
        links = moved.select("letters_key", "fields_key", F.col("new_label").alias("label"))
        several = moved.groupBy("letters_key").agg(F.countDistinct("fields_key").alias("n")).where("n > 1").select("letters_key")
        if moved.where("new_label < label").join(several, "letters_key", "left_semi").isEmpty():
            break
    labels = links.groupBy("letters_key").agg(F.min("label").alias("label"))
    return classes.join(labels, "letters_key", "left").select("letters_key", F.col("keep_id").alias("head"), F.coalesce("label", "keep_id").alias("keep_id"), "copies")


def collapse_copies(df: DataFrame, id_col: str = "rec_id", text_col: str = "text") -> DataFrame:
    """``keep_rec_id, copies``: one row per distinct record and how many rows hold it."""
    sets = same_records(df, id_col, text_col)
    return sets.groupBy(F.col("keep_id").alias("keep_rec_id")).agg(F.sum("copies").alias("copies"))


def copies_found(df: DataFrame, id_col: str = "rec_id", text_col: str = "text") -> DataFrame:
    """``keep_rec_id, rec_id`` of every record that is not the smallest id of its set."""
    keys = materialize(canonical_keys(df, id_col, text_col), "keys")
    sets = same_records(df, id_col, text_col, keys)
    rows = join_hot(keys.where("rec_id is not null and letters_key is not null").select("rec_id", "letters_key"), sets, "letters_key")
    return rows.where("rec_id <> keep_id").select(F.col("keep_id").alias("keep_rec_id"), "rec_id").distinct()
