"""Connected components of an edge table by alternating large and small stars.

Every step is a minimum a node, which is combined before the shuffle, and a join, in which nodes with many
neighbours are salted; no node's neighbours meet in one task and no component goes to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import join_classes, materialize


def _star(pairs: DataFrame, small: bool, total: int) -> DataFrame:
    """pairs (u, v).  Large: v > u goes to the least neighbour of u.  Small: v < u and u go there."""
    both = pairs if small else pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count(F.lit(1)).alias("n"))
    joined = join_classes(both, least, "u", "n", total=total)
    if small:
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    else:
        out = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return out.where("u <> v")


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """node and the least node of its component, for each node of an edge (columns a, b; a <> b)."""
    pairs = materialize(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), name)
    while True:
        # pairs run from the larger node to the smaller; both stars keep them so
        total = pairs.count()
        pairs = materialize(_star(_star(pairs, small=False, total=2 * total), small=True, total=total).distinct(), name)
        # done when every node has one root and no root has one
        ends = pairs.select(F.col("u").alias("node"), F.lit(1).alias("below"), F.lit(0).alias("root")).unionByName(pairs.select(F.col("v").alias("node"), F.lit(0).alias("below"), F.lit(1).alias("root")))
        if ends.groupBy("node").agg(F.sum("below").alias("below"), F.max("root").alias("root")).where("below + root > 1").isEmpty():
            break
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component"))
