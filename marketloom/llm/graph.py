"""Connected components by alternating large-star and small-star steps on written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import deleted, saved


def _are_stars(edges: DataFrame) -> bool:
    """Whether every b of edges (a, b) stands in one edge and is no a. Ends are counted before the shuffle."""
    ends = edges.select(F.col("a").alias("node"), F.lit(0).alias("low")).unionByName(edges.select(F.col("b").alias("node"), F.lit(1).alias("low")))
    lows = ends.groupBy("node").agg(F.sum("low").alias("lows"), F.min("low").alias("least"))
    return not lows.agg(F.max(F.expr("lows > 1 or lows = 1 and least = 0"))).first()[0]


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of edges (a, b): component is the smallest node that can be reached.

    Each step maps a node's neighbours to the smallest one; minima are combined before the shuffle. It ends when edges are
    stars: then each edge leads to its component's smallest node. A step's edges are deleted when the next ones are written.
    """
    edges = saved(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct(), "edges")
    while not _are_stars(edges):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(low, "a").filter("b > a").select(F.col("m").alias("a"), "b").filter("a < b").distinct()
        low = large.groupBy("b").agg(F.min("a").alias("m"))
        near = large.join(low, "b")
        small = near.select(F.col("m").alias("a"), "b").unionByName(near.filter("a > m").select(F.col("m").alias("a"), F.col("a").alias("b")))
        edges, before = saved(small.distinct(), "edges"), edges
        deleted(before)
    return edges.select(F.col("b").alias("node"), F.col("a").alias("component")).unionByName(
        edges.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
    )
