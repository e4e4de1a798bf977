"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import removed, written


def _large_star(edges: DataFrame) -> DataFrame:
    """Links every larger neighbour of a node to the smallest of the node and its neighbours."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.filter("b > a").join(low, "a").select(F.col("m").alias("a"), "b").filter("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Links a node and its smaller neighbours to the smallest of these."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = down.groupBy("a").agg(F.min("b").alias("m"))
    rest = down.join(low, "a").filter("b <> m").select(F.col("m").alias("a"), "b")
    return rest.union(low.select(F.col("m").alias("a"), F.col("a").alias("b"))).distinct()


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """node, component (the smallest node reachable) of every node that an edge (a, b) names.

    Null ends and loops are left out. Nodes that no edge names are not in the result. Each round
    halves chains and is written down, and the one before is deleted; it ends when a round changes nothing.
    """
    edges = written(edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    mark = None
    for _ in range(most_rounds):
        before, edges = edges, written(_small_star(_large_star(edges)), "edges")
        removed(before)
        now = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if now == mark or not now["n"]:
            break
        mark = now
    else:
        raise RuntimeError(f"no end after {most_rounds} rounds")
    return edges.select(F.col("b").alias("node"), F.col("a").alias("component")).union(edges.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())
