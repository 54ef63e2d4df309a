"""Connected components of an edge table, as joins and sums over the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import materialize


def stars(e: DataFrame) -> bool:
    """Whether in distinct edges (u > v) every u has one edge and no v is itself a u."""
    ends = e.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(e.select("v", F.lit(0), F.lit(1)))
    seen = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return seen.filter("up > 1 or (up = 1 and down = 1)").agg(F.count("*")).first()[0] == 0


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``root`` (the smallest node reachable) for every node of ``edges`` (a, b: long).

    Alternating large-star and small-star steps: each points a node's neighbours at the smallest
    node it knows, until only stars are left; every step is an aggregation and a join, written to the
    shared folder, and the number of steps grows with the logarithm of a component's diameter.
    """
    e = materialize(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u != v").distinct(), "cc-start")
    while not stars(e):
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))
        e = materialize(small.filter("u != v").distinct(), "cc-step")
    roots = e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
