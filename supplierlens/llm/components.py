"""Connected components of links between documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from supplierlens.llm.common import written


def _unfinished(links: DataFrame) -> bool:
    """Whether some node hangs on two others, or hangs on one and has others hanging on it."""
    ends = links.select(F.col("a").alias("node"), F.lit(0).alias("hangs")).union(
        links.select("b", F.lit(1).alias("hangs")))
    return not ends.groupBy("node").agg(F.sum("hangs").alias("hangs"), F.min("hangs").alias("least")).where(
        "hangs > 1 OR hangs = 1 AND least = 0").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b): root is the smallest node reachable.

    Alternating large-star and small-star steps: a node's neighbours are hung onto its
    smallest neighbour, which about halves the depth each time, whatever the shape. Smallest
    neighbours come from an aggregate that combines before its shuffle and are joined back, so
    a node with a very large number of links is never gathered in one place. The loop ends
    when the links are stars.
    """
    links = written(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                    .where("a <> b").distinct(), "links")
    while _unfinished(links):
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = written(both.groupBy("a").agg(F.min("b").alias("low"))
                      .select("a", F.least("a", "low").alias("low")), "links-low")
        large = (both.join(low, "a").where("b > a")
                 .select(F.col("low").alias("a"), "b").where("a <> b").distinct())
        # From here each pair is (smaller, larger); the larger hangs its smaller neighbours.
        large = written(large, "links-large")
        low = written(large.groupBy("b").agg(F.min("a").alias("low")), "links-low")
        small = large.join(low, "b")
        links = written(
            small.select(F.col("low").alias("a"), F.col("a").alias("b")).where("a <> b")
            .union(low.select(F.col("low").alias("a"), "b")).distinct(), "links")
    return links.select(F.col("b").alias("node"), F.col("a").alias("root")).union(
        links.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())
