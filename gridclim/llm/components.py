"""Connected components of a graph given as a table of edges, by alternating stars.

A round hangs every larger neighbour of a node on the node's smallest neighbour, then does
the same among smaller neighbours. The graph becomes a set of stars around the smallest
node of each component after about log2(diameter) rounds. Edges stay in Spark; each
round is a written table, and the driver sees a count and a checksum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())


def _large(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b"), F.col("a"))).toDF("u", "v")
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("m").alias("a"), F.col("v").alias("b")).where("a < b")


def _small(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("b").agg(F.min("a").alias("m"))
    moved = edges.join(least, "b").select(F.col("m").alias("x"), F.col("a").alias("y")).where("x < y")
    return moved.union(least.select(F.col("m").alias("x"), F.col("b").alias("y"))).toDF("a", "b")


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node each node is connected with.

    Only nodes with an edge to another node appear. Edges that repeat, run both ways or
    lead back to their start are fine; edges with a NULL end are ignored.
    """
    edges = materialise(
        edges.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"), (F.col(a) + F.col(b)).alias("s"))
        .where("s IS NOT NULL AND a < b").select("a", "b").distinct()
    )
    before = None
    now = _signature(edges)
    while now != before and now[0]:
        before = now
        edges = materialise(_small(_large(edges).distinct()).distinct())
        now = _signature(edges)
    return edges.select(F.col("b").alias("node"), F.col("a").alias("component")).union(
        edges.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
    )
