"""Connected components of a graph in a table, by joins and grouping alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modelferry.session import written

MOST_ROUNDS = 60


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for each node of an edge (a, b).

    Alternates two steps until nothing changes: each node links its larger neighbours to
    its smallest one, then its smaller ones. Each round is written to the shared folder, so a lost executor
    costs a read. Rounds grow with the logarithm of the longest chain.
    Nodes without an edge do not appear.
    """
    both = written(edges.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    state = None
    for _ in range(MOST_ROUNDS):
        large = _star(both, larger=True)
        both = written(_star(large, larger=False), "links")
        now = both.agg(
            F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if now == state:
            break
        state = now
    else:
        raise RuntimeError("components did not settle")
    return both.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        both.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """Link neighbours of each node to its smallest one; edges go from the larger node a to b.

    The smallest neighbour is joined back, so no task gathers the neighbours of a node.
    """
    if larger:
        seen = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        seen = edges
    least = seen.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")).withColumnRenamed("a", "n")
    joined = seen.join(least, F.col("a") == F.col("n"))
    if larger:
        out = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        own = least.where("m < n").select(F.col("n").alias("a"), F.col("m").alias("b"))
        out = joined.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(own)
    return out.where("a <> b").distinct()
