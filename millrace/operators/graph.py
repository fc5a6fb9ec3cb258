"""Build order of a dependency graph."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from millrace.operators.chains import follow
from millrace.operators.running import hinted, shuffled
from millrace.session import scratch_dir, stage_table

BUCKET_ROWS, MOST_BUCKETS = 1_000_000, 1024  # edges of a bucket; what a round names of its frontier


class CycleError(ValueError):
    """The graph has a cycle; ``residual`` holds the nodes that could not be placed."""

    def __init__(self, residual: DataFrame, sample: list):
        super().__init__(f"dependency cycle among nodes such as {sample}")
        self.residual = residual


def _raise_cycle(residual: DataFrame) -> None:
    raise CycleError(residual, sorted({str(r[0]) for r in residual.limit(10).collect()}))


def _bucket(column: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(buckets)).cast("int")


def topo_levels(edges: DataFrame, nodes: DataFrame | None = None, node: str = "node",
                parent: str = "parent") -> DataFrame:
    """Level of every node: 0 without parents, else one above its highest parent.

    Any order by level is a build order. Parents that were never declared count as nodes. A node with one parent lies
    at a fixed distance below the nearest node above it that has none or several (its anchor), which pointer
    doubling finds for all of them; so a chain of any length costs the logarithm of it. What remains are nodes with
    several parents: they wait with a count of missing parents, and a round goes from the anchors just placed
    along their edges, which are stored once in buckets of the anchor. A round reads the buckets of its frontier
    and writes the nodes that it touched; lineage never spans two rounds.
    """
    spark = edges.sparkSession
    kind = edges.schema[node].dataType.simpleString()
    links = stage_table(edges.where(F.col(parent).isNotNull()).select(
        F.col(node).alias("node"), F.col(parent).alias("parent")).distinct(), "links")
    every = edges.select(F.col(node).alias("node")).union(links.select("parent"))
    if nodes is not None:
        every = every.union(nodes.select(node))
    every = stage_table(every.distinct(), "nodes")
    parents = stage_table(links.groupBy("node").agg(F.count(F.lit(1)).alias("n"), F.min("parent").alias("up")), "parents")

    below = stage_table(follow(parents.where("n = 1"), "node", "up"), "anchors")
    lost = below.where(F.col("head").isNull()).select("node")
    if lost.limit(1).count():
        _raise_cycle(lost.withColumnRenamed("node", node))

    # Edges between anchors: a parent is an anchor itself or hangs below one.
    several = parents.where("n > 1").select("node", "n")
    up = links.join(shuffled(several.select("node")), "node", "left_semi").join(
        shuffled(below.select(F.col("node").alias("parent"), "head", "distance")), "parent", "left").select(
        F.coalesce("head", "parent").alias("anchor"), "node", (F.coalesce("distance", F.lit(0)) + 1).alias("weight"))
    path = scratch_dir(spark, "anchor-edges")
    waiting, n_edges = several.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    buckets = min(MOST_BUCKETS, -(-n_edges // BUCKET_ROWS)) or 1
    up.groupBy("anchor", "node").agg(F.max("weight").alias("weight"), F.count(F.lit(1)).alias("n")).select(
        "*", _bucket("anchor", buckets).alias("bucket")).repartition("bucket").write.partitionBy("bucket").parquet(path)
    stored = spark.read.schema(f"anchor {kind}, node {kind}, weight long, n long, bucket int").parquet(path)

    # Each round leaves the nodes that it touched; those with nothing missing are placed.
    rounds, schema = scratch_dir(spark, "levels"), f"node {kind}, missing long, level long"
    roots = every.join(shuffled(parents.select("node")), "node", "left_anti")
    roots.select("node", F.lit(0).cast("long").alias("missing"), F.lit(0).cast("long").alias("level")).write.parquet(
        f"{rounds}/round=0")
    partial, turn = spark.createDataFrame([], schema), 0
    while waiting:
        last = spark.read.schema(schema).parquet(f"{rounds}/round={turn}")
        frontier = last.where("missing = 0").select(F.col("node").alias("anchor"), "level")
        here = frontier.agg(F.count(F.lit(1)).alias("n"), F.collect_set(_bucket("anchor", buckets)).alias("in")).first()
        if turn:
            waiting -= here["n"]
        if not here["n"]:
            done = spark.read.schema(schema).parquet(rounds).where("missing = 0")
            _raise_cycle(several.join(done.select("node"), "node", "left_anti").select(F.col("node").alias(node)))
        if not waiting:
            break
        turn += 1
        news = stored.where(F.col("bucket").isin(here["in"])).join(hinted(frontier, here["n"]), "anchor").groupBy("node").agg(
            F.sum("n").alias("got"), F.max(F.col("level") + F.col("weight")).alias("high"))
        news.join(shuffled(several), "node").join(shuffled(partial), "node", "left").select(
            "node", (F.coalesce("missing", "n") - F.col("got")).alias("missing"),
            F.greatest("high", F.coalesce("level", F.lit(0))).alias("level")).write.parquet(f"{rounds}/round={turn}")
        touched = spark.read.schema(schema).parquet(f"{rounds}/round={turn}")
        partial = stage_table(partial.join(shuffled(touched.select("node")), "node", "left_anti").unionByName(
            touched.where("missing > 0")), "partial")

    anchors = spark.read.schema(schema).parquet(rounds).where("missing = 0").select("node", "level")
    hanging = below.join(shuffled(anchors.select(F.col("node").alias("head"), "level")), "head").select(
        "node", (F.col("level") + F.col("distance")).alias("level"))
    return anchors.unionByName(hanging).select(F.col("node").alias(node), F.col("level").cast("int").alias("level"))
