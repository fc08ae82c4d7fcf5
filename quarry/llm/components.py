"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import release, saved


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour of u above u moves to the least of u and its neighbours."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    up = both.where("b > a")
    return up.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """With edges from above to below: u and its lower neighbours move to the least of these."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def connected_components(edges: DataFrame, rounds: int = 100) -> DataFrame:
    """``node, root`` for every node of ``a, b`` edges (any orderable type); root is the least node reachable.

    Edges with a null end and loops are left out, repeated edges count once; no edges give an empty
    table. Each round is a few shuffles of the edge list, whose length never grows; hot nodes meet only
    in aggregates with map-side combining and in plain joins that adaptive execution can split. The
    lineage is cut by a checkpoint per round; the driver sees one row of counts per round.
    """
    edges = edges.select("a", "b").where("a <> b")
    edges = saved(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    for _ in range(rounds):
        # done when every node has one edge and no root hangs below another: all are stars
        n, nodes = edges.agg(F.count("*"), F.countDistinct("a")).first()
        chained = edges.join(edges.select(F.col("a").alias("b")), "b", "left_semi").limit(1).count() if n == nodes else 1
        if not chained:
            break
        edges = saved(_small_star(_large_star(edges)))
        release(edges.sparkSession)  # a round's shuffle files are not kept for the next ones
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
