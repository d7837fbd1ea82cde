"""Connected components of a graph too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionlake.session import materialize


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``node`` and ``component`` (the smallest node of it) for every node of an edge.

    Alternates two steps until only stars are left: every node's larger neighbours are tied to its
    smallest neighbour, then its smaller ones are. Each keeps the components and
    brings the graph nearer to stars around the smallest nodes, in a number of rounds that
    grows with the logarithm of the longest path. A node's edges are never gathered; what each
    node needs of them is a minimum, computed before anything moves.
    """

    def tidy(pairs: DataFrame) -> DataFrame:
        return pairs.filter("u <> v").distinct()

    def both_ways(pairs: DataFrame) -> DataFrame:
        return pairs.select("u", "v").unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))

    def tie(around: DataFrame, larger: bool) -> DataFrame:
        least = around.groupBy("u").agg(F.min("v").alias("m"))
        least = least.select(F.col("u").alias("w"), F.least("m", "u").alias("m"))
        joined = around.join(least, F.col("u") == F.col("w"))
        if larger:
            return tidy(joined.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")))
        return tidy(
            joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
                least.select(F.col("w").alias("u"), F.col("m").alias("v"))
            )
        )

    # u > v in every pair
    now = materialize(
        tidy(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))), "components"
    )
    while not _is_star_forest(now):
        large = tie(both_ways(now), larger=True)
        now = materialize(tie(large, larger=False), "components")
    ends = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(ends)


def _is_star_forest(pairs: DataFrame) -> bool:
    """Whether every node ``u`` has one ``v``, which is no other pair's ``u``."""
    centres = pairs.select(F.col("v").alias("centre")).distinct()
    if not pairs.join(centres, F.col("u") == F.col("centre"), "left_semi").isEmpty():
        return False
    return pairs.groupBy("u").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").isEmpty()
