"""Connected components of a distributed edge list by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _min_of(edges: DataFrame) -> DataFrame:
    """Smallest neighbour of each ``u``; written, so that a join with it can split a hot ``u``."""
    return written(edges.groupBy("u").agg(F.min("v").alias("m")), "min")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _min_of(both).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = _min_of(edges)
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (columns u, v; longs) but the roots.

    The root of a component is its smallest node. Self-links and repeated links
    are fine; an empty edge list gives an empty result.
    """
    stars = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    stars = written(stars, "edges")
    while True:
        unsettled = stars.groupBy("u").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
        if unsettled.isEmpty() and stars.join(stars.select(F.col("u").alias("w")), F.col("v") == F.col("w"), "left_semi").isEmpty():
            return stars.select(F.col("u").alias("node"), F.col("v").alias("root"))
        stars = written(_small_star(written(_large_star(stars), "large")), "small")
