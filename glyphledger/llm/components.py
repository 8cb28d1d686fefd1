"""Connected components of an edge table, by rounds of joins and group minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glyphledger.session import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    """Hang every larger neighbour of a node on the least of its neighbourhood."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return (
        both.filter("v > u")
        .join(least, "u")
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Hang a node and its smaller neighbours on the least of them. Needs ``u > v``."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(edges: DataFrame, a: str = "u", b: str = "v") -> DataFrame:
    """(node, component) of every node that has an edge; the component is its least node.

    Alternates the two star steps until the edge set no longer changes. A round
    costs two joins of the edge table, a hub of any degree is spread by the group
    minima and split joins, and each round ends in a written table, so lost
    executors repeat reads only. Edges with a null end and loops are ignored;
    repeated edges count once.
    """
    edges = materialize(
        edges.select(
            F.greatest(a, b).cast("long").alias("u"), F.least(a, b).cast("long").alias("v")
        )
        .filter(F.col(a).isNotNull() & F.col(b).isNotNull())
        .filter("u <> v")
        .distinct()
    )
    state = _state(edges)
    while state[0]:
        edges = materialize(_small_star(_large_star(edges)))
        last, state = state, _state(edges)
        if state == last:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
