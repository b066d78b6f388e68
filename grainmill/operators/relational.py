"""Unions, addresses and windows over tables of documents and files."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..session import materialize

STANDARD = ["text", "id", "source"]
#: Documents of a task that are looked up together.
ADDRESS_BLOCK = 1024
#: Parts a content's copies are dealt to before they meet.
SALTS = 64


def standardize(df: DataFrame, source: str | None = None) -> DataFrame:
    """The standard columns: text, its content id and the source. Rows without a text are left out."""
    name = F.lit(source) if source is not None else F.col("source")
    return df.where("text <> ''").select("text", T.doc_id(F.col("text")).alias("id"), name.alias("source"))


def union_null_fill(*tables: DataFrame) -> DataFrame:
    """Rows of all tables in the standard columns; what a table lacks is null, what it has besides is dropped."""
    out = None
    for t in tables:
        part = t.select(*(F.col(c).cast("string").alias(c) if c in t.columns else F.lit(None).cast("string").alias(c) for c in STANDARD))
        out = part if out is None else out.unionByName(part)
    return out


def keep_first(df: DataFrame, key: str = "doc_id") -> DataFrame:
    """The first row of each content by a window; ``dedup.exact_dedup`` gives the same keys.

    The window sees SALTS rows of a content at most, the firsts of its parts, however many copies it has.
    """
    w = Window.partitionBy("id").orderBy(key)
    rows = df.where("text is not null").select(key, T.content(F.col("text")).alias("id"))
    parts = rows.groupBy("id", F.pmod(F.xxhash64(key), F.lit(SALTS)).alias("part")).agg(F.min(key).alias(key))
    return parts.withColumn("n", F.row_number().over(w)).where("n = 1").select(key, T.short_id())


def cumulative_starts(files: DataFrame) -> DataFrame:
    """``task_rank, filepath, num_rows, start``: where each file's rows begin among those of its task.

    The files are ordered over all tasks and cut into blocks of like size; a block starts at the sum of the blocks before
    it, so the files of one large task are not added up in one place.
    """
    rows = files.select("task_rank", "filepath", "num_rows").distinct()
    rows = materialize(rows.repartitionByRange("task_rank", "filepath").withColumn("block", F.spark_partition_id()), "blocks")
    before = Window.partitionBy("task_rank").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = rows.groupBy("task_rank", "block").agg(F.sum("num_rows").alias("sum")).select("task_rank", "block", F.sum("sum").over(before).alias("base"))  # a row by partition and task
    inside = Window.partitionBy("task_rank", "block").orderBy("filepath").rowsBetween(Window.unboundedPreceding, -1)
    start = lambda c: F.coalesce(c, F.lit(0))
    own = rows.withColumn("own", F.sum("num_rows").over(inside)).alias("r")
    met = own.join(blocks.alias("b"), F.expr("r.block = b.block and r.task_rank <=> b.task_rank"))
    return met.select("r.task_rank", "filepath", "num_rows", (start(F.col("own")) + start(F.col("base"))).cast("bigint").alias("start"))


def look_up(points: DataFrame, files: DataFrame) -> DataFrame:
    """``task, doc, source, filepath, row`` of the addresses ``task, doc`` that a file holds.

    A range join as an equi-join: a file is listed under every block of positions it touches.
    """
    f = files.where("num_rows > 0").select(F.col("task_rank").cast("bigint").alias("task"), "filepath", "source", "num_rows", "cumulative_start").distinct()
    f = f.withColumn("block", F.explode(F.sequence(F.expr(f"cumulative_start div {ADDRESS_BLOCK}"), F.expr(f"(cumulative_start + num_rows - 1) div {ADDRESS_BLOCK}"))))
    p = points.where("task is not null and doc >= 0").select("task", "doc").distinct().withColumn("block", F.expr(f"doc div {ADDRESS_BLOCK}"))
    met = p.join(f, ["task", "block"]).where("doc >= cumulative_start and doc < cumulative_start + num_rows")
    return met.select("task", "doc", "source", "filepath", (F.col("doc") - F.col("cumulative_start")).alias("row"))
