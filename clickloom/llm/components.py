"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.session import cut_lineage


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of `edges` (u long, v long); the root is the smallest node.

    Each round hangs the larger neighbours of every node below its smallest one
    and then does so among the smaller ones, until the edges form stars. A round
    is two aggregates and two joins on the node, written to the shared folder;
    the number of rounds grows with the logarithm of a component's diameter.
    """
    edges = cut_lineage(
        edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    )
    before = None
    while (now := _state(edges)) != before:
        before = now
        # u > v always. Large star: neighbours above a node go to its smallest neighbour.
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        above = edges.select(F.col("v").alias("u"), F.col("u").alias("w"))
        large = above.join(least, "u").select(F.col("w").alias("u"), F.col("m").alias("v")).distinct()
        # Small star: a node and its smaller neighbours go to the smallest of these.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        down = small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = cut_lineage(down.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
    roots = edges.select(F.col("v").alias("node")).distinct().withColumn("root", F.col("node"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
