"""Connected components of a graph that is a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.session import stage


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest node around it."""
    both = edges.union(edges.select("b", "a")).toDF("a", "b")
    least = both.groupBy("a").agg(F.min("b").alias("low"))
    least = least.select("a", F.least("a", "low").alias("low"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("low"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("low"))
    moved = edges.join(least, "a").where("b <> low").select(F.col("b").alias("a"), "low")
    return moved.union(least)


def components(links: DataFrame) -> DataFrame:
    """``node, component`` (the smallest node reachable) of every node in a link.

    ``links`` has two columns of comparable values. Null ends and loops are ignored, and
    repeated links count once. Alternating large and small stars halves the depth of
    every tree; each round is written to the shared folder, so its lineage is short, and a
    hub only meets joins, which adaptive execution splits, and pre-aggregated minima.
    """
    links = links.toDF("a", "b").where("a <> b")
    edges = stage(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "links",
    )
    last = None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == last:
            return edges.toDF("node", "component").union(edges.select("b", "b").distinct())
        last = state
        large = _large_star(edges).toDF("a", "b").where("a <> b").distinct()
        small = _small_star(large).toDF("a", "b").where("a <> b").distinct()
        edges = stage(small, "stars")
