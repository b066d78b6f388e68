"""The named queries of this folder over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import budget, copies, encode, groups, leaks, near, oracle, prose, reading, repetition


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _matches(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return tuple(table(spark, sf_dir, name) for name in ("dup_pairs", "file_info", "standard_docs"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "p1_token_budget": lambda s, d: budget.token_budget(table(s, d, "standard_docs")),
        "p1_token_slices": lambda s, d: budget.token_slices(table(s, d, "standard_docs")),
        "p1_documents_budget": lambda s, d: budget.token_budget(table(s, d, "documents")),
        "p2_found": lambda s, d: copies.copies_found(table(s, d, "standard_docs")),
        "p4_found": lambda s, d: groups.groups_found(*_matches(s, d)),
        "p4_group_sources": lambda s, d: groups.group_sources(*_matches(s, d)).withColumn("source", F.array_join("source", ",")),
        "p5_found": lambda s, d: prose.not_prose_found(table(s, d, "standard_docs")),
        "p5_classes": lambda s, d: prose.classify(table(s, d, "standard_docs")),
        "p7_found": lambda s, d: near.near_found(table(s, d, "standard_docs")),
        "p7_pairs": lambda s, d: near.near_pairs(table(s, d, "standard_docs")),
        "p7_members": lambda s, d: near.near_members(table(s, d, "standard_docs")),
        "p3_found": lambda s, d: repetition.repetition_found(table(s, d, "standard_docs")),
        "p3_repetition": lambda s, d: repetition.repetition(table(s, d, "standard_docs")),
        "p3_shares": lambda s, d: repetition.repetition(table(s, d, "standard_docs")).select("rec_id", F.round("repeated_share", 6).alias("repeated_share")),
        "p8_ids": lambda s, d: encode.encode(table(s, d, "documents")),
        "p8_round_trip": lambda s, d: encode.round_trip(table(s, d, "documents")),
        "p9_found": lambda s, d: leaks.leaks_found(table(s, d, "documents"), table(s, d, "eval_items")),
        "p10_found": lambda s, d: reading.demanding_found(table(s, d, "documents"), table(s, d, "reading_labels")),
        "p10_levels": lambda s, d: reading.levels(table(s, d, "documents"), table(s, d, "reading_labels")),
        "p2_copies": lambda s, d: copies.collapse_copies(table(s, d, "standard_docs")),
    }


def oracle_sql() -> dict[str, str]:
    return oracle.sql()
