"""Connected components of a link table, by alternating star rewrites."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taskspark.session import store_and_reload


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node hands its smallest neighbour to its larger neighbours."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
    return both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node hands its smallest smaller neighbour to the other smaller ones and to itself."""
    low = edges.groupBy("a").agg(F.min("b").alias("low"))
    moved = edges.join(low, "a").where("b > low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return moved.union(low.select("a", F.col("low").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b): the smallest node it is connected with.

    Each round is written to the shared folder, so a lost executor costs one round. The number of
    rounds grows with the logarithm of the longest chain; a hub's links are aggregated before they move.
    Null ends and links of a node with itself are ignored; repeated links count once; no links give no rows.
    """
    edges = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = store_and_reload(edges.where("a > b").distinct(), "links")
    mark = None
    while True:
        edges = store_and_reload(_small_star(_large_star(edges)), "stars")
        now = edges.agg(F.count("*"), F.sum("b"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        mark = now
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.union(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
