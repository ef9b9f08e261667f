"""Distributed connected components with DataFrame joins only.

Alternates two steps on an edge table (u > v): *large star* hangs every larger neighbour of
a node on the smallest node of its neighbourhood, *small star* does the same with the smaller
neighbours and the node itself. Both keep the components and end at one star around the
smallest node of each, which a count of each node's edges shows. A hub of any degree is one row per edge: its minimum is aggregated
map-side, and the join back is one that Spark can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.llm.common import stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step, a row for each edge (u, v): rows may repeat, which changes no minimum."""
    turned = edges.select(F.col("v").alias("u"), F.col("u").alias("v"))
    near = edges.unionByName(turned) if large else edges
    least = near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    if large:
        return turned.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    # the smaller neighbours hang on the least of them, and so does the node, on behalf of the edge to that one
    return edges.join(least, "u").select(F.when(F.col("v") != F.col("m"), F.col("v")).otherwise(F.col("u")).alias("u"), F.col("m").alias("v"))


def _settled(edges: DataFrame) -> bool:
    """True if the distinct edges (u, v) are stars: every u hangs on one v, and no v on another."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("u").alias("node"), F.lit(1).alias("hung")), F.struct(F.col("v").alias("node"), F.lit(0).alias("hung")))).alias("end"))
    nodes = ends.groupBy("end.node").agg(F.sum("end.hung").alias("hung"), F.min("end.hung").alias("least"))
    return nodes.where("hung > 1 or hung = 1 and least = 0").isEmpty()


def stars(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node of an edge but the components' smallest, which name them. ``edges`` is read
    several times: a stored table. Nulls and loops link nothing."""
    edges = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    while True:
        edges = stored(_star(_star(edges, True), False).distinct(), "edges")
        if _settled(edges):
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node of an edge; component is the smallest node reachable.

    Nulls and loops link nothing. No edges: an empty result.
    """
    found = stars(stored(edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where(F.col("a") != F.col("b")).distinct(), "edges"))
    return found.unionByName(found.select(F.col("component").alias("node"), "component").distinct())
