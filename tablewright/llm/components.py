"""Connected components by alternating large-star and small-star steps.

Both steps are joins and grouped minima over the edge table, so no neighbourhood is ever
collected. Each round is written as a table, which cuts lineage and survives lost executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tablewright.staging import stage


def large_star(edges: DataFrame) -> DataFrame:
    """Link the larger neighbours of every node to the least node it knows; may repeat edges."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    larger = both.filter("v > u").join(least, "u")
    return larger.select(F.col("v").alias("u"), F.col("m").alias("v"))


def small_star(edges: DataFrame) -> DataFrame:
    """Link every node and its smaller neighbours to the least of them; edges have u > v."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    smaller = edges.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return smaller.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` of every node but the least of each component.

    ``edges`` has long columns ``u`` and ``v``; loops are ignored, nulls are not allowed.
    """
    edges = edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    mark = None
    while True:
        # Count and checksum of the edges come with the write; when they stay, so did the edges.
        seen = Observation()
        marks = (F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x"), F.sum(F.col("v") % 1_000_003).alias("v"))
        edges = stage(small_star(large_star(edges)).observe(seen, *marks), "stars")
        before, mark = mark, seen.get
        if mark == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
