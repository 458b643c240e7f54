"""Connected components of a link table, in Spark (alternating star contraction)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenure.llm.common import written


def _large_star(e: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is hung on the least node around it."""
    both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    # a table of its own: next to a plain exchange AQE can split a hub's links in the join
    least = written(least, "least")
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(e: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are hung on the least of them (e: u > v)."""
    least = e.groupBy("u").agg(F.min("v").alias("m"))
    moved = e.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v")))


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``(node, root)`` for every node of ``links``; root is the least node reachable.

    Each round runs a large star and a small star and writes the contracted
    links to the shared folder; rounds grow with the logarithm of the longest
    path. Only counts come to the driver. Self links and nulls are ignored.
    """
    x, y = F.col(a), F.col(b)
    e = links.select(F.greatest(x, y).alias("u"), F.least(x, y).alias("v")).filter("u != v").distinct()
    e, seen = written(e, "links"), None
    while True:
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now[0] == 0 or tuple(now) == seen:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        seen = tuple(now)
        e = written(_small_star(_large_star(e).distinct()).distinct(), "links")
