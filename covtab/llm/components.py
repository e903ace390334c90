"""Connected components of an edge table, by alternating large and small
stars. Every round is a few aggregations and joins over the edges; labels and
edges never leave the executors, and each round is cut by a checkpoint."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covtab.llm.scratch import cut


def _large_star(e: DataFrame) -> DataFrame:
    """Hang every larger neighbour of a node on the least of its neighbourhood."""
    both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    return (both.join(least, "u").where(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct())


def _small_star(e: DataFrame) -> DataFrame:
    """Hang a node and its smaller neighbours on the least of them."""
    least = e.groupBy("u").agg(F.min("v").alias("m"))
    rest = (e.join(least, "u").where(F.col("v") != F.col("m"))
            .select(F.col("v").alias("u"), F.col("m").alias("v")))
    return rest.unionByName(least.withColumnRenamed("m", "v")).distinct()


def _is_star_forest(e: DataFrame) -> bool:
    """Whether every node hangs on one root and no root hangs on another."""
    nodes = e.groupBy("u").agg(F.count("*").alias("n"), F.min("v").alias("v"))
    if nodes.where("n > 1").limit(1).count():
        return False
    hanging = e.select(F.col("v")).distinct().join(e.select(F.col("u").alias("v")), "v",
                                                   "left_semi")
    return hanging.limit(1).count() == 0


def connected_components(edges: DataFrame) -> DataFrame:
    """``node``, ``component`` (the smallest node reachable) of every node that
    has an edge to another one and is not its component's smallest. ``edges``:
    columns ``a`` and ``b``, in any order and number."""
    e = (edges.where(F.col("a") != F.col("b"))
         .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    e = cut(e)
    while not _is_star_forest(e):
        e = cut(_small_star(_large_star(e)))
    return e.select(F.col("u").alias("node"), F.col("v").alias("component"))
