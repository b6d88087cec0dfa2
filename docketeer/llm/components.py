"""Connected components of an undirected graph of long ids, by alternating large-star and small-star rounds.

Each round joins every node with its smallest neighbour (an aggregation with map-side combine) and points neighbours
at it; components of any shape converge in a number of rounds logarithmic in their size.  Edges are written to the
shared folder after each round.  A node with very many edges is a hot key of the join; the smallest neighbours, one
row a node, are written before it, as adaptive execution splits a hot key only where both sides are plain shuffles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketeer.llm.common import written

MAX_ROUNDS = 60


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges: DataFrame) -> DataFrame:
    both = _both_ways(edges)
    least = written(both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low")), "least")
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = written(down.groupBy("a").agg(F.min("b").alias("low")), "least")
    moved = down.join(least, "a").where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return moved.union(least.select("a", F.col("low").alias("b"))).where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """edges (a long, b long) to (node, component): the smallest node reachable, for every node of an edge."""
    now = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    state = None
    for _ in range(MAX_ROUNDS):
        now = written(_small_star(written(_large_star(now), "star")), "edges")  # the star is read twice
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == state:
            roots = now.select(F.col("b").alias("node"), F.col("b").alias("component"))
            return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots).distinct()
        state = seen
    raise RuntimeError(f"components did not converge in {MAX_ROUNDS} rounds")
