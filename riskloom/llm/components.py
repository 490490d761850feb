"""Connected components of an edge table by alternating large-star and small-star joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import staged


def _toward_minimum(edges: DataFrame, larger_only: bool) -> DataFrame:
    """Each node's neighbours (all, or the smaller ones) with the smallest of them and itself."""
    both = edges if larger_only else edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
    return both.join(low, "a")


def _large_star(edges: DataFrame) -> DataFrame:
    near = _toward_minimum(edges, larger_only=False)
    return near.where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    near = _toward_minimum(edges, larger_only=True)  # every edge points to its smaller end
    moved = near.where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return moved.unionByName(near.select("a", F.col("low").alias("b"))).distinct()


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node points to one centre and no centre points on."""
    roles = edges.select(F.col("a").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("centre"))
    roles = roles.unionByName(edges.select(F.col("b").alias("node"), F.lit(0).alias("out"), F.lit(1).alias("centre")))
    each = roles.groupBy("node").agg(F.sum("out").alias("out"), F.max("centre").alias("centre"))
    return each.where("out > 1 or (out > 0 and centre > 0)").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (u, v) to (node, comp): every node's component, named by its smallest node.

    Edges become one star per component. Rows of a round never exceed the
    edges', and every group is a minimum, aggregated before its shuffle.
    """
    ends = edges.select(F.greatest("u", "v").alias("a"), F.least("u", "v").alias("b")).where("a <> b").distinct()
    ends = staged(ends, "star")
    while not _are_stars(ends):
        ends = staged(_small_star(_large_star(ends)), "star")
    return ends.select(F.col("a").alias("node"), F.col("b").alias("comp")).unionByName(ends.select(F.col("b").alias("node"), F.col("b").alias("comp"))).distinct()
