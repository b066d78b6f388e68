"""Exact, near and sentence-level duplicates.

Near duplicates are MinHash-LSH: ``BANDS`` bands of ``ROWS`` minima over hashed word shingles; sharing a band is the
verdict, there is no further check. A word's hash comes from its md5 and a shingle's is a sum of its words' with factors, so
any SQL engine can reproduce them and a batch's distinct words are hashed once. A text is signed
within its row, in one pass over the texts; what is shuffled afterwards are keys and 16-byte digests.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from hashlib import md5

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.text import bind
from ..session import materialize, spread
from .components import components
from .joins import anti_join_wide, join_unique, left_join_wide

#: Values that results depend on; fixed values.
SHINGLE, BANDS, ROWS = 5, 14, 8
PRIME = (1 << 31) - 1
SPAN, SPAN_COUNT, SENTENCE_WORDS, DOCUMENT_WORDS = 3, 3, 5, 50
#: What separates sentences, besides a line's end.
SENTENCE_END = r"[.!?؟۔।…]+"


def permutations(n: int = BANDS * ROWS, seed: int = 1) -> list[tuple[int, int]]:
    draw = random.Random(seed)
    return [(draw.randrange(1, PRIME), draw.randrange(PRIME)) for _ in range(n)]


def exact_dedup(df: DataFrame, key: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, kept, copies``: of each content the smallest key. Partial aggregation, so copies don't meet in a task."""
    rows = spread(df.where(f"{text_col} is not null").select(key, text_col)).select(T.content(F.col(text_col)).alias("id"), key)
    return rows.groupBy("id").agg(F.min(key).alias("kept"), F.count("*").alias("copies")).select(T.short_id(), "kept", "copies")


def shingles(df: DataFrame, key: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc, s``: the distinct word n-grams of every text."""
    rows = bind(spread(df.where(f"{text_col} is not null").select(F.col(key).alias("doc"), text_col)), w=T.words(F.lower(text_col)))
    return rows.select("doc", F.explode(F.array_distinct(T.ngrams(F.col("w"), SHINGLE))).alias("s"))


#: Hashes that are permuted at a time.
_AT_ONCE = 400_000


def shingle_factors() -> list[int]:
    """What the hashes of a shingle's words are multiplied by before they are added up."""
    return [a for a, _ in permutations(SHINGLE, seed=2)]


def _minima(h: np.ndarray, first: np.ndarray) -> np.ndarray:
    """By text and permutation the least hash; ``first`` is where each text's hashes begin, none is empty."""
    out = np.empty((len(first), BANDS * ROWS), np.int64)
    for i, (a, b) in enumerate(permutations()):
        out[:, i] = np.minimum.reduceat((h * a + b) % PRIME, first)
    return out


def _word_hashes(words: pa.Array) -> np.ndarray:
    """31 bits of the md5 of each word; a batch's distinct words are hashed once."""
    coded = words.dictionary_encode()
    own = np.frombuffer(b"".join([md5(w.encode()).digest()[:4] for w in coded.dictionary.to_pylist()]), ">u4").astype(np.int64) & PRIME
    return own[coded.indices.to_numpy(zero_copy_only=False)] if len(own) else np.zeros(0, np.int64)


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replaces the words ``w`` by the ``signature``, null for fewer words than SHINGLE."""
    for batch in batches:
        lists = batch.column("w")
        sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        h, first = _word_hashes(lists.flatten()), np.cumsum(sizes) - sizes
        shingles = np.zeros(max(0, len(h) - SHINGLE + 1), np.int64)  # also across texts; those are never looked at
        for k, factor in enumerate(shingle_factors()):
            shingles += h[k : k + len(shingles)] * factor % PRIME
        shingles %= PRIME
        some = sizes >= SHINGLE
        begin, number = first[some], sizes[some] - SHINGLE + 1
        made = np.zeros((len(begin), BANDS * ROWS), np.int64)
        group = (np.cumsum(number) - number) // _AT_ONCE  # texts that are worked on together
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(begin)]
        for a, b in zip(cuts, cuts[1:]):
            if b > a:
                at = np.cumsum(number[a:b]) - number[a:b]
                made[a:b] = _minima(shingles[np.repeat(begin[a:b] - at, number[a:b]) + np.arange(number[a:b].sum())], at)
        ends = np.r_[0, np.cumsum(np.where(some, BANDS * ROWS, 0))].astype(np.int32)
        signature = pa.ListArray.from_arrays(pa.array(ends), pa.array(made.ravel()), mask=pa.array(~some))
        rest = [n for n in batch.schema.names if n != "w"]
        yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in rest), signature], [*rest, "signature"])


def signed(df: DataFrame, key: str = "doc_id", text_col: str = "text", **more: Column) -> DataFrame:
    """``doc``, the columns of ``more`` and the ``signature`` (null for short texts) of every text. No shuffle."""
    rows = spread(df.where(f"{text_col} is not null"))
    rows = rows.select(F.col(key).alias("doc"), *(c.alias(n) for n, c in more.items()), T.words(F.lower(text_col)).alias("w"))
    schema = ", ".join(f"`{n}` {t}" for n, t in rows.dtypes if n != "w") + ", signature array<bigint>"
    return rows.mapInArrow(_sign, schema)


def signatures(df: DataFrame, key: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc, signature`` of every text of at least SHINGLE words."""
    return signed(df, key, text_col).where("signature is not null")


def buckets(signature: Column) -> Column:
    """By band the digest of its minima."""
    part = lambda b: F.unhex(F.md5(F.array_join(F.slice(signature, b * ROWS + 1, ROWS).cast("array<string>"), ",").cast("binary")))
    return F.when(signature.isNotNull(), F.array(*(part(b) for b in range(BANDS))))


def bands(rows: DataFrame, *keep: str) -> DataFrame:
    """``doc``, the columns of ``keep``, ``band`` and ``bucket`` from rows with ``buckets``."""
    return rows.select("doc", *keep, F.posexplode("buckets").alias("band", "bucket"))


def minhash_edges(df: DataFrame, key: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``a, b`` (a < b): each member of a band's bucket with its smallest member, and each copy with its first.

    Only one text of each content goes into the bands, so a content of very many copies fills no bucket.
    """
    prints = signed(df, key, text_col, id=F.unhex(T.content(F.col(text_col))))
    prints = materialize(prints.select("doc", "id", buckets(F.col("signature")).alias("buckets")), "prints")
    several = prints.groupBy("id").agg(F.min("doc").alias("a"), F.count("*").alias("n")).where("n > 1").drop("n")
    copies = materialize(join_unique(prints.select("doc", "id"), several, ["id"]).where("doc <> a").select("a", F.col("doc").alias("b")), "copies")
    rows = materialize(bands(anti_join_wide(prints.select("doc", "buckets"), copies.select(F.col("b").alias("doc")), ["doc"])), "bands")
    least = rows.groupBy("band", "bucket").agg(F.min("doc").alias("a"), F.count("*").alias("n")).where("n > 1").drop("n")
    stars = join_unique(rows, least, ["band", "bucket"]).where("doc <> a").select("a", F.col("doc").alias("b"))
    return stars.unionByName(copies).distinct()


def minhash_clusters(df: DataFrame, key: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``v, label`` of every text with a near duplicate."""
    return components(minhash_edges(df, key, text_col))


def minhash_dedup(df: DataFrame, key: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows without the near duplicates of a smaller key. Texts that surely stay are not moved."""
    gone = materialize(minhash_clusters(df, key, text_col).where("v <> label").select(F.col("v").alias(key)), "gone")
    return anti_join_wide(df, gone, [key])


def sentences(s: Column) -> Column:
    """Sentences of a text, blanks collapsed."""
    marked = F.regexp_replace(s, f"({SENTENCE_END})([{T.WS}]+)", "$1\n")
    return F.filter(F.transform(F.split(marked, "\n"), T.collapse), lambda x: x != "")


def _spans(rows: DataFrame) -> DataFrame:
    """``doc, at, h``: the digest of every span of SPAN sentences that are all long enough."""
    places = F.transform(F.sequence(F.lit(1), F.greatest(F.size("s") - (SPAN - 1), F.lit(1))), lambda i: F.slice("s", i, SPAN))
    spans = rows.where(F.size("s") >= SPAN).select("doc", F.posexplode(places).alias("at", "span"))
    digest = F.unhex(F.md5(F.array_join(F.transform("span", F.lower), "\n").cast("binary")))
    spans = spans.select("doc", "at", F.transform("span", T.word_count).alias("w"), digest.alias("h"))
    return spans.where(F.expr(f"forall(w, x -> x >= {SENTENCE_WORDS})")).select("doc", "at", "h")


def sentence_dedup(df: DataFrame, key: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """``key, text, dropped`` and the columns of ``keep``: texts without the sentences of spans seen SPAN_COUNT times or
    more (all occurrences go).

    Only sentences of SENTENCE_WORDS words or more form spans; texts left with fewer than DOCUMENT_WORDS words go. Spans
    are written once as digests. Texts stay where they are: only those that may lose a sentence meet their places.
    """
    split = lambda t: bind(spread(t), s=sentences(F.coalesce(F.col(text_col), F.lit(""))))
    spans = materialize(_spans(split(df.select(F.col(key).alias("doc"), text_col)).select("doc", "s")), "spans")
    often = spans.groupBy("h").agg(F.count("*").alias("n")).where(F.col("n") >= SPAN_COUNT).select("h")
    places = join_unique(spans, often, ["h"]).groupBy("doc").agg(F.collect_set("at").alias("starts"))  # at most one entry per sentence of a text
    places = materialize(places, "places")
    rows = split(df.select(F.col(key).alias("doc"), text_col, *keep)).select("doc", *keep, "s")
    met = left_join_wide(rows, places, ["doc"]).withColumn("starts", F.coalesce("starts", F.array().cast("array<int>")))
    kept = F.expr(f"filter(s, (x, i) -> NOT exists(starts, j -> i >= j AND i < j + {SPAN}))")
    out = bind(met, kept=kept)
    text = F.array_join("kept", " ")
    return out.where(T.word_count(text) >= DOCUMENT_WORDS).select(F.col("doc").alias(key), text.alias("text"), *keep, (F.size("s") - F.size("kept")).alias("dropped"))
