"""Connected components of an edge table by alternating large-star and small-star steps.

Each step is an aggregation and a join, written to the shared folder; node
labels stay in tables, and a node with very many edges is pre-aggregated and
only a skewed join key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sylvan.llm.common import materialize


def _tangled(stars: DataFrame) -> bool:
    """Whether a node has two edges up or an edge leads to a node that has one itself."""
    twice = stars.groupBy("u").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("u")
    inner = stars.join(stars.select(F.col("v").alias("u")).distinct(), "u", "left_semi").select("u")
    return not twice.unionByName(inner).isEmpty()


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, label)`` for every node of the edges ``(a, b)``: the smallest node it is connected with."""
    stars = materialize(edges.filter("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "cc-edges")
    while _tangled(stars):
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        pairs = large.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        stars = materialize(pairs.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "cc-edges")
    roots = stars.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    return stars.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(roots)
