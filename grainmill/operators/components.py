"""Connected components by minimum propagation with alternating stars (Kiveris et al. 2014).

Rounds grow with the logarithm of a component's length, so long chains don't matter. Each round's edges are written
to the shared folder: lineage stays short and a lost executor costs one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import drop_steps, write_step
from .joins import join_unique


def both_ways(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("a").alias("src"), F.col("b").alias("dst")).unionAll(edges.select(F.col("b").alias("src"), F.col("a").alias("dst")))


def _large_star(edges: DataFrame, n: int) -> DataFrame:
    ways = both_ways(edges)
    least = ways.groupBy("src").agg(F.least(F.min("dst"), F.col("src")).alias("m"))
    return join_unique(ways.where("dst > src"), least, ["src"], n_rows=n).where("dst <> m").select(F.col("m").alias("a"), F.col("dst").alias("b")).distinct()


def _small_star(edges: DataFrame, n: int) -> DataFrame:
    down = edges.select(F.col("b").alias("src"), F.col("a").alias("dst"))
    least = down.groupBy("src").agg(F.min("dst").alias("m"))
    met = join_unique(down, least, ["src"], n_rows=n).where("dst <> m").select(F.col("m").alias("a"), F.col("dst").alias("b"))
    return met.unionAll(least.select(F.col("m").alias("a"), F.col("src").alias("b"))).distinct()


def _written(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """The edges written, with their number and an order-free checksum taken on the way."""
    out, seen = write_step(edges, "stars", n=F.count("*"), sum=F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")))
    return out, (seen["n"], seen["sum"])


def propagate_minimum(edges: DataFrame) -> DataFrame:
    """``v, label`` of every vertex of the edges ``a, b`` (a < b). Two jobs a round; a round's tables go with the next."""
    edges, before = _written(edges)
    down = False  # whether the last small star changed nothing
    while before[0]:
        large, mid = _written(_large_star(edges, 2 * before[0]))
        if down and mid == before:  # neither star changes anything
            break
        small, now = _written(_small_star(large, mid[0]))
        drop_steps(edges, large)
        edges, before, down = small, now, now == mid
    return edges.select(F.col("b").alias("v"), F.col("a").alias("label")).unionAll(edges.select(F.col("a").alias("v"), F.col("a").alias("label")).distinct())


def components(edges: DataFrame) -> DataFrame:
    """``v, label`` of any edges ``a, b``: nulls and self loops link nothing, direction and repeats don't matter."""
    clean = edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    return propagate_minimum(clean)
