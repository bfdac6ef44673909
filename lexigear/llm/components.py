"""Connected components of an edge table, in alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexigear.llm.common import materialize


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node id reachable from each node of ``edges`` (u, v).

    Each round links every node's larger neighbours, then its smaller ones, to the smallest
    neighbour; the table shrinks to one edge from each node to its component's smallest
    node.  Rounds grow with the logarithm of the longest path.  All steps are joins with a
    written table of one row per node, so the edges of a node that has very many can be
    split over tasks.  Loops
    and repeated edges are ignored, edges with a null end too; nodes without edges do not
    come back.
    """
    ends = edges.where("u IS NOT NULL AND v IS NOT NULL AND u <> v")
    now = materialize(ends.select(F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b")).distinct(), "edges")
    before = None
    while (mark := _mark(now)) != before:
        before = mark
        now = materialize(_small_star(_large_star(now)), "edges")
    nodes = now.select(F.col("b").alias("node"), F.col("a").alias("component"))
    return nodes.unionByName(now.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.pmod(F.xxhash64("b", "a"), F.lit(1 << 30)))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Links the neighbours of x that are larger than x to the smallest of x and its neighbours."""
    both = edges.select(F.col("a").alias("x"), F.col("b").alias("y")).unionByName(edges.select(F.col("b").alias("x"), F.col("a").alias("y")))
    least = materialize(both.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m")), "least")
    return both.where("y > x").join(least, "x").select(F.col("m").alias("a"), F.col("y").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Links x and its smaller neighbours to the smallest of them."""
    edges = materialize(edges, "large-star")
    least = materialize(edges.groupBy("b").agg(F.min("a").alias("m")), "least")
    moved = edges.join(least, "b").where("a <> m").select(F.col("m").alias("a"), F.col("a").alias("b"))
    return moved.unionByName(least.select(F.col("m").alias("a"), "b")).distinct()
