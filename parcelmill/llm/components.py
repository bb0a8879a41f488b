"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from parcelmill.llm.scratch import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Join each node's larger neighbours to the smallest of its neighbourhood."""
    both = edges.union(edges.select("b", "a")).toDF("u", "v")
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u"), F.least("u", "m").alias("m"))
    return both.filter("v > u").join(least, "u").filter("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Join each node and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    others = down.join(least, "u").filter("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return others.union(least.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct()


def _is_forest_of_stars(edges: DataFrame) -> bool:
    """Every node has one parent, and no parent has one."""
    roles = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        edges.select("b", F.lit(0), F.lit(1))
    )
    counts = roles.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return not counts.filter("up + down > 1").head(1)


def components(edges: DataFrame) -> DataFrame:
    """(node, component): for every node of the edges (a, b) the smallest node that it is connected with.

    Loops, repeated and reversed edges and edges with a null end add nothing. No edges, no rows. Each round is written
    to the shared folder; rounds are logarithmic in the number of nodes. No neighbourhood is ever gathered in one row.
    """
    edges = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).dropna().filter("a <> b").distinct(), "edges")
    while not _is_forest_of_stars(edges):
        edges = stored(_small_star(stored(_large_star(edges), "large-star")), "small-star")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(edges.select("b", "b").distinct())
