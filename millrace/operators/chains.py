"""Heads and distances in linked rows, by pointer doubling."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from millrace.operators.running import shuffled
from millrace.session import stage_table


def follow(links: DataFrame, node: str = "node", up: str = "up") -> DataFrame:
    """``links`` (one row per node, the node above it) -> node, head, distance.

    The head is the first node above that has no link itself. Every round doubles the distance each row looks
    up, so a chain of a million links takes twenty rounds. The head is null for nodes on a loop or below one. Each round
    is a written table; the right side of its join has each node once, so a node that very many point to
    is split like any skewed key. Both sides are shuffled, so nothing of a round passes through the driver.
    """
    now = stage_table(links.select(F.col(node).alias("node"), F.col(up).alias("up"), F.lit(1).cast("long").alias("distance"),
                                   F.lit(False).alias("done")), "links")
    waiting, reach = now.count(), now.count()
    while waiting and reach:
        above = now.select(F.col("node").alias("_n"), F.col("up").alias("_u"), F.col("distance").alias("_d"),
                           F.col("done").alias("_f"))
        met = now.where("NOT done").join(shuffled(above), F.col("up") == F.col("_n"), "left")
        stepped = met.select(
            "node", F.coalesce("_u", "up").alias("up"), (F.col("distance") + F.coalesce("_d", F.lit(0))).alias("distance"),
            (F.col("_n").isNull() | F.coalesce("_f", F.lit(False))).alias("done"))
        now = stage_table(now.where("done").unionByName(stepped), "links")
        waiting = now.where("NOT done").count()
        reach //= 2  # by now every row has looked farther up than there are rows: what waits is on a loop
    return now.select("node", F.when(F.col("done"), F.col("up")).alias("head"), "distance")
