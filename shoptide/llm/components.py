"""Connected components of a links table, by rounds of star joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoptide.llm.shared import settle


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Large star: every larger neighbour of a node is linked to the node's smallest one. Small star: every smaller
    neighbour is. The minimum is combined before the shuffle, so a hub is no task's burden."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    joined = both.join(least, "a").select("a", "b", F.least("a", "m").alias("m"))
    if large:
        out = joined.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(joined.select("a", F.col("m").alias("b")))
    return out.filter("a <> b").distinct()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) of every node that has a link to another: root is the smallest node it is joined with. Needs a number of
    rounds that grows with the logarithm of a component's size; each round's links are settled."""
    edges = settle(links.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a <> b").distinct(), "links")
    mark = None
    while True:
        edges = settle(_star(_star(edges, large=True), large=False), "links")
        found = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if found == mark:
            break
        mark = found
    # every node now hangs on its root
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
