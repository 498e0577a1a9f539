"""Connected components of a link table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from fieldpanel.llm.common import stage


def _both_ways(links: DataFrame) -> DataFrame:
    return links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Link every node's larger (large) or smaller neighbours to its least neighbour."""
    seen = _both_ways(links) if large else links.select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    least = seen.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    joined = seen.join(least, "a")
    if large:
        moved = joined.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), "m")
    else:
        moved = joined.select(F.col("b").alias("a"), "m").unionAll(least)
    moved = moved.where(F.col("a") != F.col("m"))
    return moved.select("a", F.col("m").alias("b")).distinct()


def _only_stars(links: DataFrame) -> bool:
    """Whether every node a has one link (a, b), to a node that has none: then b < a is its root."""
    ends = links.select(F.col("a").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("into"))
    ends = ends.unionAll(links.select("b", F.lit(0), F.lit(1)))
    nodes = ends.groupBy("node").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
    return nodes.where(F.col("out") + F.col("into") > 1).where("out > 0").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node in ``links`` (a, b); root is the component's least node.

    Large and small stars alternate until every link leads to its component's least node,
    after a number of rounds that grows with the logarithm of the longest path. Every
    round is written, which cuts the lineage, and only whether one was the last reaches the
    driver.
    """
    links = stage(links.where(F.col("a") != F.col("b")), "links")
    while True:
        links = stage(_star(_star(links, True), False), "links")
        if _only_stars(links):
            return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(
                links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
