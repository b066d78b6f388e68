"""Texts that several sources hold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..session import materialize, spread
from .components import components
from .dedup import bands, buckets, signed
from .joins import join_unique, semi_join_wide


def _sourced(df: DataFrame, key: str) -> DataFrame:
    """Rows with a text and a source."""
    return spread(df.where("text <> '' and source <> ''").select(F.col(key).alias("doc"), "text", "source"))


def hash_sources(df: DataFrame, key: str = "doc_id") -> DataFrame:
    """``id, sources, n_sources``: which sources hold each content."""
    rows = _sourced(df, key).select(T.content(F.col("text")).alias("id"), "source")
    return rows.groupBy("id").agg(F.array_sort(F.collect_set("source")).alias("sources")).select(T.short_id(), "sources", F.size("sources").alias("n_sources"))


def hash_consensus(df: DataFrame, min_sources: int = 2, key: str = "doc_id") -> DataFrame:
    """``id, text, source``: contents of at least ``min_sources`` sources, the text of the first source and key.

    The sources are gathered by id alone; only the texts that are returned are moved. Rows without a key take no part.
    """
    rows = _sourced(df, key).where("doc is not null")
    ids = rows.select(T.content(F.col("text")).alias("id"), "source", "doc")
    groups = ids.groupBy("id").agg(F.min(F.struct("source", "doc")).alias("first"), F.array_sort(F.collect_set("source")).alias("source"))
    groups = materialize(groups.where(F.size("source") >= min_sources).select("id", "first.doc", "source"), "several")
    texts = semi_join_wide(rows.select("doc", "text"), groups.select("doc"), ["doc"]).join(groups, "doc")
    same = texts.where(T.content(F.col("text")) == F.col("id"))  # a key may stand at several texts
    return same.groupBy("id").agg(F.min("text").alias("text"), F.first("source").alias("source")).select(T.short_id(), "text", "source")


def participation(consensus: DataFrame) -> DataFrame:
    """``source, documents``: how many consensus texts each source takes part in."""
    return consensus.select(F.explode(F.array_distinct("source")).alias("source")).groupBy("source").agg(F.count("*").alias("documents"))


def cross_source_edges(df: DataFrame, key: str = "doc_id") -> DataFrame:
    """``a, b``: near-duplicate links between documents of different sources.

    All pairs of a bucket with different sources form a complete multipartite graph; the same components come from
    linking every member to the bucket's first document of another source, which is linear in the bucket.
    """
    prints = signed(_sourced(df, key), "doc", source=F.col("source")).select("doc", "source", buckets(F.col("signature")).alias("buckets"))
    met = materialize(bands(prints, "source"), "source-bands")
    per = met.groupBy("band", "bucket", "source").agg(F.min("doc").alias("first"))
    order = F.array_sort(F.collect_list(F.struct("first", "source")))  # one entry per source
    hubs = per.groupBy("band", "bucket").agg(order.alias("o")).where(F.size("o") > 1).select("band", "bucket", F.col("o")[0].alias("hub"), F.col("o")[1].alias("other"))
    linked = join_unique(met, hubs, ["band", "bucket"])
    to = F.when(F.col("source") == F.col("hub.source"), F.col("other.first")).otherwise(F.col("hub.first"))
    return linked.select(F.least("doc", to).alias("a"), F.greatest("doc", to).alias("b")).distinct()


def minhash_consensus(df: DataFrame, min_sources: int = 2, key: str = "doc_id") -> DataFrame:
    """``id, text, source``: one document (the smallest key) of each cross-source cluster, with the cluster's sources."""
    rows = _sourced(df, key)
    labels = materialize(components(cross_source_edges(df, key)), "labels")
    sources = labels.join(df.where("text <> '' and source <> ''").select(F.col(key).alias("v"), "source"), "v").groupBy("label", "source").count()
    groups = materialize(sources.groupBy("label").agg(F.array_sort(F.collect_set("source")).alias("source")).where(F.size("source") >= min_sources), "groups")
    heads = groups.select(F.col("label").alias("doc"), F.col("source").alias("sources"))
    texts = semi_join_wide(rows.select("doc", "text"), heads.select("doc"), ["doc"]).join(heads, "doc")
    return texts.select(T.doc_id(F.col("text")).alias("id"), "text", F.col("sources").alias("source"))
