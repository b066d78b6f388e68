"""How much the sources overlap."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..session import spread


def source_contents(df: DataFrame) -> DataFrame:
    """``id, source, tokens``: each content once per source, the id of all 32 digits. Texts of one content have equally many words."""
    rows = spread(df.where("text <> '' and source <> ''").select("text", "source")).select(T.content(F.col("text")).alias("id"), "source", T.word_count(F.col("text")).alias("tokens"))
    return rows.groupBy("id", "source").agg(F.max("tokens").cast("bigint").alias("tokens"))


def unique_documents(df: DataFrame) -> DataFrame:
    return source_contents(df).groupBy("source").agg(F.count("*").alias("documents"))


def pairwise_overlap(df: DataFrame) -> DataFrame:
    """``source_a, source_b, overlap, tokens, pct_of_a, pct_of_b`` of every pair of sources, pairs without overlap too.

    The sources of a content are gathered once and its pairs made from the list; there is no self-join. The list of all
    sources is one row: a corpus has a handful of them.
    """
    contents = source_contents(df)
    sizes = contents.groupBy("source").agg(F.count("*").alias("n"))
    lists = contents.groupBy("id").agg(F.array_sort(F.collect_set("source")).alias("s"), F.max("tokens").alias("tokens")).where(F.size("s") > 1)
    pairs = "flatten(transform(s, (a, i) -> transform(slice(s, i + 2, size(s)), b -> struct(a AS source_a, b AS source_b))))"
    found = lists.select(F.expr(f"inline({pairs})"), "tokens").groupBy("source_a", "source_b").agg(F.count("*").alias("overlap"), F.sum("tokens").alias("tokens"))
    every = sizes.agg(F.array_sort(F.collect_list("source")).alias("s")).select(F.expr(f"inline({pairs})"))
    a, b = (sizes.select(F.col("source").alias(f"source_{x}"), F.col("n").alias(f"n_{x}")) for x in "ab")
    met = every.join(found, ["source_a", "source_b"], "left").join(a, "source_a").join(b, "source_b")
    n = F.coalesce("overlap", F.lit(0)).cast("bigint")
    share = lambda of: F.round(F.coalesce(T.ratio(n * 100, F.col(of)), F.lit(0.0)), 6)
    return met.select("source_a", "source_b", n.alias("overlap"), F.coalesce("tokens", F.lit(0)).cast("bigint").alias("tokens"), share("n_a").alias("pct_of_a"), share("n_b").alias("pct_of_b"))


def source_intersect(df: DataFrame, a: str, b: str) -> DataFrame:
    """``id`` of the contents that both sources hold."""
    contents = source_contents(df)
    return contents.where(F.col("source") == a).select("id").intersect(contents.where(F.col("source") == b).select("id")).select(T.short_id())


def source_except(df: DataFrame, a: str, b: str) -> DataFrame:
    """``id`` of the contents of ``a`` that ``b`` lacks."""
    contents = source_contents(df)
    return contents.where(F.col("source") == a).select("id").join(contents.where(F.col("source") == b).select("id"), "id", "left_anti").select(T.short_id())
