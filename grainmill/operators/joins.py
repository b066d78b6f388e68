"""Joins whose keys may hold any share of the rows, and joins of wide rows with lists of keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import write_step

#: A key with more rows than this is joined apart from the others.
HOT_ROWS = 100_000
#: Keys of at most this number are broadcast as they are.
FEW_KEYS = 100_000
#: Bits of a key map for each key, and of the largest map (4 M words of 64 bits).
BITS_PER_KEY, MOST_BITS = 16, 1 << 28
MAYBE = "__maybe"


def join_unique(rows: DataFrame, unique: DataFrame, on: list[str], hot_rows: int = HOT_ROWS, n_rows: int | None = None, how: str = "inner") -> DataFrame:
    """Inner or left join with a side that has one row per key.

    The at most (rows / hot_rows) hot keys are joined by broadcast, so their rows stay where they are. With ``n_rows`` of
    no more than ``hot_rows`` no key can be hot and none is looked for.
    """
    if n_rows is not None and n_rows <= hot_rows:
        return rows.join(unique, on, how)
    hot, seen = write_step(rows.dropna(subset=on).groupBy(*on).count().where(F.col("count") > hot_rows).select(*on), "hot", n=F.count("*"))
    if not seen["n"]:
        return rows.join(unique, on, how)
    keys = F.broadcast(hot)
    hot_rows_ = rows.join(keys, on, "left_semi").join(F.broadcast(unique.join(keys, on, "left_semi")), on, how)
    return rows.join(keys, on, "left_anti").join(unique, on, how).unionByName(hot_rows_)


def _place(on: list[str], bits: int) -> Column:
    return F.pmod(F.xxhash64(*on), F.lit(bits))


def _marked(rows: DataFrame, keys: DataFrame, on: list[str], n: int) -> DataFrame:
    """Adds MAYBE: false for rows whose key is not among the keys, true for all others and few besides.

    The map of the keys' bits is broadcast as words, so its size is bound; above its bound more rows than needed are true.
    """
    bits = 1 << 10
    while bits < min(BITS_PER_KEY * n, MOST_BITS):
        bits *= 2
    at = _place(on, bits)
    words = keys.dropna(subset=on).select(at.alias("place")).select(F.shiftright("place", 6).alias("map_at"), F.expr("shiftleft(1L, cast(place & 63 as int))").alias("bit"))
    words = words.groupBy("map_at").agg(F.bit_or("bit").alias("map_word"))
    some = F.lit(True)
    for c in on:
        some = some & F.col(c).isNotNull()
    # names that no column of the rows has
    place, word_at, word = "__map_place", "__map_at", "__map_word"
    met = rows.withColumn(place, F.when(some, at)).withColumn(word_at, F.shiftright(place, 6)).join(F.broadcast(words.select(F.col("map_at").alias(word_at), F.col("map_word").alias(word))), word_at, "left")
    hit = F.expr(f"shiftright({word}, cast({place} & 63 as int)) & 1L = 1L")
    return met.withColumn(MAYBE, F.coalesce(hit, F.lit(False))).drop(word_at, word, place)


def semi_join_wide(rows: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """The rows whose key is among ``keys`` (a written table): only those, and few others, are moved."""
    n = keys.count()
    if n <= FEW_KEYS:
        return rows.join(F.broadcast(keys), on, "left_semi")
    return _marked(rows, keys, on, n).where(MAYBE).drop(MAYBE).join(keys, on, "left_semi")


def anti_join_wide(rows: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """The rows whose key is not among ``keys`` (a written table); rows that surely aren't stay where they are."""
    n = keys.count()
    if n <= FEW_KEYS:
        return rows.join(F.broadcast(keys), on, "left_anti")
    marked = _marked(rows, keys, on, n)
    return marked.where(f"not {MAYBE}").drop(MAYBE).unionByName(marked.where(MAYBE).drop(MAYBE).join(keys, on, "left_anti"))


def left_join_wide(rows: DataFrame, unique: DataFrame, on: list[str]) -> DataFrame:
    """Left join with a written table of one row per key; rows that surely have no partner stay where they are."""
    n = unique.count()
    if n <= FEW_KEYS:
        return rows.join(F.broadcast(unique), on, "left")
    marked = _marked(rows, unique.select(*on), on, n)
    return marked.where(MAYBE).drop(MAYBE).join(unique, on, "left").unionByName(marked.where(f"not {MAYBE}").drop(MAYBE), allowMissingColumns=True)
