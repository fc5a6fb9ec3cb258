"""Connected components of an edge table, as shuffles only."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from millrace.session import stage_table


def _state(edges: DataFrame) -> tuple:
    low = F.shiftright(F.xxhash64("a", "b"), 20)  # 44 bits, so that a sum over the table cannot overflow
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(low)).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour above a node is tied to the node's smallest neighbour."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    return both.where(F.col("b") > F.col("a")).join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    tied = edges.join(least, "a").where(F.col("b") != F.col("m")).select(
        F.col("b").alias("a"), F.col("m").alias("b"))
    return tied.union(least.select("a", F.col("m").alias("b"))).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges(a, b)`` of any orderable type -> (node, component), component being the smallest node.

    Nodes without an edge do not occur in the result. Self-loops and repeated edges do no harm. Alternates
    large-star and small-star steps until every component is a star; each round is a written table. Minima
    are folded map-side and the joins back to a large star's centre can be split by AQE, so a component
    with a third of all nodes needs no task of its own.
    """
    up = edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now = stage_table(up.distinct(), "edges")
    state = _state(now)
    while state[0]:
        now = stage_table(_small_star(_large_star(now)), "edges")
        state, before = _state(now), state
        if state == before:
            break
    tied = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return tied.union(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
