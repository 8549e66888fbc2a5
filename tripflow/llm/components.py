"""Connected components of a distributed graph by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed


def _stars(edges: DataFrame) -> bool:
    """Whether every node has one smaller neighbour at most, and none that has one has a larger one too."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("smaller"), F.lit(0).alias("larger")).union(
        edges.select("v", F.lit(0), F.lit(1))
    )
    counts = ends.groupBy("node").agg(F.sum("smaller").alias("smaller"), F.max("larger").alias("larger"))
    return counts.where((F.col("smaller") > 1) | ((F.col("smaller") > 0) & (F.col("larger") > 0))).isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for each end of the edges ``u, v`` (longs): the root is the component's smallest node.

    Every round hooks nodes to the smallest neighbour that they or their neighbours know; stars remain
    after a number of rounds that grows with the logarithm of the longest path. Edges stay distributed
    and are stored each round. A node with many edges is aggregated by task before it is shuffled. Its
    minimum is stored before the join that hands it back, since Spark splits a skewed join only where both
    sides are shuffled for it.
    """
    edges = checkpointed(
        edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    )
    while not _stars(edges):
        both = edges.union(edges.select("v", "u"))
        least = checkpointed(both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u")))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = checkpointed(large)
        least = checkpointed(large.groupBy("u").agg(F.min("v").alias("m")))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = checkpointed(small.union(least.select("u", F.col("m").alias("v"))).distinct())
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
