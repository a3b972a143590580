"""Connected components of an edge table, by alternating star contractions.

A round links every node's larger neighbours to the smallest one (large star), then
every node's smaller neighbours (small star); stars with the smallest node as centre
remain after a number of rounds that grows with the logarithm of the nodes. A
node's minimum is an aggregate that is combined before the shuffle, and it is joined
back to the node's edges, so the edges of a hub are never gathered: adaptive execution
may split the join. Each round is written to the shared folder, which cuts lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricehouse.session import materialize


def _linked_to_least(edges: DataFrame) -> DataFrame:
    """(u, v) and the least v of each u as ``m``."""
    least = edges.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "w")
    return edges.join(least, F.col("u") == F.col("w")).select("u", "v", "m")


def _state(edges: DataFrame) -> tuple:
    sums = F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))
    return tuple(edges.agg(F.count("*"), sums).head())


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component): every node of an edge with the least node it can reach.

    Loops and rows with a NULL end are ignored; repeated edges count once; nodes
    may be of any type with an order. An empty table gives an empty result.
    """
    pairs = edges.select(F.col(a).alias("p"), F.col(b).alias("q")).filter("p IS NOT NULL AND q IS NOT NULL AND p <> q")
    now = materialize(
        pairs.select(F.greatest("p", "q").alias("u"), F.least("p", "q").alias("v")).distinct(), "edges"
    )
    before = None
    while (state := _state(now)) != before and state[0]:
        before = state
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _linked_to_least(both).filter("v > u").select(
            F.col("v").alias("u"), F.least("u", "m").alias("v")
        ).distinct()
        small = _linked_to_least(large)
        kept = small.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        ends = small.select("u", F.col("m").alias("v"))
        now = materialize(kept.unionByName(ends).distinct(), "edges")
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
