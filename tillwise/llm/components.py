"""Connected components of an edge table, by alternating star contractions.

Every half round replaces a node's edges by edges to its smallest neighbour, first for the
larger neighbours and then for the smaller ones; both keep the components, and after
few rounds each component is a star around its smallest node. The edge table is
written to the shared folder after each half round. A hub's edges are never grouped: its
smallest neighbour is a pre-aggregated minimum, and it comes back by a join of two
read tables, which adaptive execution may split.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.llm.tables import keep


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = keep(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "star")
    return (both.where("v > u").join(least, "u")
            .select(F.col("v").alias("a"), F.col("m").alias("b")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    least = keep(edges.groupBy("a").agg(F.min("b").alias("m")), "star")
    moved = edges.join(least, "a").where("b != m").select(
        F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b: two columns of one ordered type,
    no nulls). The component is its smallest node. Loops and repeated edges do no harm."""
    edges = keep(edges.where("a != b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    while (now := _signature(edges)) != before:
        before = now
        edges = keep(_small_star(keep(_large_star(edges), "edges")), "edges")
    return (edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
            .union(edges.select(F.col("b"), F.col("b"))).distinct())
