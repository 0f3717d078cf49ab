"""Connected components by alternating large-star and small-star steps on an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandcast.llm.common import materialize


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour."""
    around = _both_ways(edges)
    least = around.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return around.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours are linked to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    linked = down.join(least, "a")
    return (linked.select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct())


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, component`` (the smallest node of the component) for every node of ``edges`` (a, b: long).

    Each round is written to the shared folder; the rounds grow with the logarithm of the largest
    component, not with the table.  Nothing but two numbers a round reaches the driver.
    """
    now = materialize(edges.where("a <> b").select("a", "b").distinct(), "cc-edges")
    mark = None
    while True:
        now = materialize(_small_star(_large_star(now)), "cc-round")
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if seen == mark:
            break
        mark = seen
    stars = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    centres = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return stars.unionByName(centres)
