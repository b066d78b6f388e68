"""Pairwise matches consolidated into groups.

Matches address documents by task and position; ``FileInfo.cumulative_start`` turns them into records by an equi-join
on file and block of rows. The graph's giant component is peeled off breadth-first from the vertex of the highest
degree: the hub's neighbours are the frontier, a join puts the hub in their place in the edges that are left, and so
they are gone from the table; the next frontier are the hub's neighbours in what is left. One job a layer, over fewer
edges each time. After ``LAYERS`` of them what still hangs on the hub (a long chain) goes with the other components,
which are labelled by minimum propagation in its large-star / small-star form, in a logarithmic number of rounds.

Defined results: pairs with a null, self pairs and positions that no file holds link nothing; repeated, reversed or
transitive pairs change nothing; records without a partner have no group; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.components import both_ways, propagate_minimum
from ..operators.joins import join_unique
from ..session import drop_steps, materialize, write_step
from .frames import named

#: Rows of a file that are joined together; a file of more rows is spread over more keys.
ROW_BLOCK = 100_000
#: Layers of the giant component that are peeled off one by one.
LAYERS = 4


def addresses(files: DataFrame, docs: DataFrame) -> DataFrame:
    """``task, doc, rec_id``: the address of every record that lies in a listed file."""
    f = named(files, task="task_rank", filepath="filepath", num_rows="num_rows", start="cumulative_start").where("task is not null and filepath is not null and num_rows > 0 and start is not null").distinct()
    f = f.withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(f"(num_rows - 1) div {ROW_BLOCK}"))))
    d = named(docs, rec_id="rec_id", filepath="filepath", row="row_in_file").where("rec_id is not null and filepath is not null and row >= 0").withColumn("block", F.expr(f"row div {ROW_BLOCK}"))
    return d.join(f, ["filepath", "block"]).where("row < num_rows").select(F.col("task").cast("bigint").alias("task"), (F.col("start") + F.col("row")).alias("doc"), "rec_id").distinct()


def record_edges(pairs: DataFrame, files: DataFrame, docs: DataFrame) -> DataFrame:
    """``a, b`` (a < b): the distinct links between two different records."""
    p = pairs.select(*(F.col(c).cast("bigint").alias(c) for c in ("task1", "doc1", "task2", "doc2"))).dropna().distinct()
    at = materialize(addresses(files, docs), "addresses")
    one, two = (at.select(F.col("task").alias(f"task{i}"), F.col("doc").alias(f"doc{i}"), F.col("rec_id").alias(f"r{i}")) for i in (1, 2))
    met = join_unique(join_unique(p, one, ["task1", "doc1"]), two, ["task2", "doc2"]).where("r1 <> r2")
    return met.select(F.least("r1", "r2").alias("a"), F.greatest("r1", "r2").alias("b")).distinct()


def _contract(edges: DataFrame, n: int, hub: int) -> DataFrame:
    """The edges without the hub's, with the hub in the place of its neighbours; no self loops, no repeats."""
    at_hub = (F.col("a") == hub) | (F.col("b") == hub)
    frontier = _neighbours(edges, hub).withColumn("near", F.lit(True))
    rest = edges.where(~at_hub)
    for end in "ab":
        rest = join_unique(rest, frontier.withColumnRenamed("v", end), [end], n_rows=n, how="left")
        rest = rest.withColumn(end, F.when(F.col("near"), F.lit(hub).cast("bigint")).otherwise(F.col(end))).drop("near")
    return rest.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _neighbours(edges: DataFrame, hub: int) -> DataFrame:
    """``v``: the other ends of the hub's edges."""
    return edges.where((F.col("a") == hub) | (F.col("b") == hub)).select(F.when(F.col("a") == hub, F.col("b")).otherwise(F.col("a")).alias("v"))


def components(edges: DataFrame) -> DataFrame:
    """``v, label``: the smallest vertex of the component of every vertex of the distinct edges ``a, b`` (a < b)."""
    edges, seen = write_step(edges, "edges", n=F.count("*"))
    if not (n := seen["n"]):
        return edges.select(F.col("a").alias("v"), F.col("b").alias("label"))
    hub = both_ways(edges).groupBy("src").count().orderBy(F.desc("count"), "src").first().src
    layers, left = [edges], 1
    giant = edges.sparkSession.range(1).select(F.lit(hub).cast("bigint").alias("v"))
    for _ in range(LAYERS):
        giant = giant.unionAll(_neighbours(edges, hub))
        edges, seen = write_step(_contract(edges, n, hub), "rest", n=F.count("*"), left=F.count_if((F.col("a") == hub) | (F.col("b") == hub)))
        n, left = seen["n"], seen["left"]
        layers.append(edges)
        if not left:
            break
    giant, seen = write_step(giant, "giant", least=F.min("v"))
    drop_steps(*layers[:-1])
    least = seen["least"]
    if left:  # the giant goes on as its smallest vertex so far
        a, b = (F.when(F.col(x) == hub, F.lit(least).cast("bigint")).otherwise(F.col(x)) for x in "ab")
        edges = edges.select(a.alias("a"), b.alias("b")).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    small = propagate_minimum(edges)
    if left:
        small = materialize(small, "small")
        found = small.where(F.col("v") == least).first()
        least, small = found.label, small.where(F.col("v") != found.v)
    return giant.select("v", F.lit(least).cast("bigint").alias("label")).unionByName(small)


def groups_found(pairs: DataFrame, files: DataFrame, docs: DataFrame) -> DataFrame:
    """``rec_id, group_rec_id`` of every record in a group of two or more."""
    return components(record_edges(pairs, files, docs)).select(F.col("v").alias("rec_id"), F.col("label").alias("group_rec_id"))


def group_sources(pairs: DataFrame, files: DataFrame, docs: DataFrame) -> DataFrame:
    """``group_rec_id, records, source``: each group's size and sorted list of distinct sources.

    Sources are trimmed and lower-cased; null and empty ones are no source.
    """
    groups = materialize(groups_found(pairs, files, docs), "groups")
    source = named(docs, rec_id="rec_id", source="source").select("rec_id", F.nullif(F.lower(F.trim("source")), F.lit("")).alias("source"))
    per = groups.join(source, "rec_id").groupBy("group_rec_id", "source").agg(F.countDistinct("rec_id").alias("n"))  # pre-aggregated: one row per group and source
    return per.groupBy("group_rec_id").agg(F.sum("n").alias("records"), F.array_sort(F.collect_set("source")).alias("source"))
