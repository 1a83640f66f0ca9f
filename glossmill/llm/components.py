"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glossmill.llm.common import stored


def _large_star(links: DataFrame) -> DataFrame:
    """Join every larger neighbour of a node to the node's smallest neighbour."""
    both = links.union(links.select("b", "a")).toDF("u", "v")
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return (
        both.filter("v > u").join(least, "u").select(F.col("m").alias("a"), F.col("v").alias("b"))
    ).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Join a node and its smaller neighbours to the smallest of them."""
    least = links.groupBy("b").agg(F.min("a").alias("m"))
    others = links.join(least, "b").filter("a <> m").select("m", "a")
    return least.select("m", "b").union(others).toDF("a", "b").distinct()


def components(links: DataFrame) -> DataFrame:
    """`node, root` of each node of `links` (a, b: long): root is the smallest reachable.

    Alternating star operations; the number of rounds grows with the logarithm of
    the longest path. Every round is written out, no group is gathered in a task.
    """
    links = links.filter("a <> b").select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    )
    links = stored(links.distinct(), "links")
    mark = None
    while True:
        seen = links.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if seen == mark or seen[0] == 0:
            break
        mark = seen
        links = stored(_small_star(_large_star(links)), "links")
    nodes = links.select(F.col("b").alias("node"), F.col("a").alias("root"))
    return nodes.union(links.select("a", "a").distinct())
