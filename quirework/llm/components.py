"""Connected components of a graph of any size by alternating large-star and small-star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirework.llm.common import drop_table, table


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def _minimum(edges: DataFrame) -> DataFrame:
    """(u, m): the least neighbour. A table, so that the join on u has two plain shuffles and a hot u can be split."""
    return table(edges.groupBy("u").agg(F.min("v").alias("m")), "cc-min")


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of an edge between two nodes; component is the least node of its component.

    Edges are pairs of longs; loops, repeats and edges with a null are of no effect. Every half round is a table in the
    shared folder, so a lost executor repeats one half round at most. Nothing is gathered on the driver but two numbers
    a round.
    """
    edges = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(F.col(a).isNotNull() & F.col(b).isNotNull()).where("u <> v").distinct()
    edges = table(edges, "cc")
    seen = _mark(edges)
    while seen[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = _minimum(both)
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.least("m", "u").alias("v")).distinct()
        large = table(large, "cc")
        drop_table(edges)
        drop_table(least)
        least = _minimum(large)
        small = large.join(least, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*").where("u <> v").distinct()
        edges = table(small, "cc")
        drop_table(large)
        drop_table(least)
        now = _mark(edges)
        if now == seen:
            break
        seen = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
