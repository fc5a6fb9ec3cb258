"""Stored tables in key-hash buckets: a batch rewrites only the buckets its keys fall into.

Versions are immutable, as in ``SnapshotTable``: a commit writes its buckets to a folder no one has used before and
then a manifest that names, for every bucket, the folders holding it. Untouched buckets keep their files. A version
exists once its manifest is written; two writers of one version cannot both succeed.

A bucket may be kept in several parts. History tables keep closed rows apart from current ones: closed rows are only
ever added, so a merge neither reads nor rewrites them.
"""

from __future__ import annotations

import json
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from millrace.operators.versioned import scd2_merge, upsert_by_key
from millrace.session import stage_table

ROWS, CURRENT, CLOSED = "rows", "current", "closed"


class BucketedTable:
    """``buckets`` is fixed when the table is made; choose it so that a bucket is a few hundred megabytes.

    The manifest has one line per bucket, part and folder; it is the only thing that passes through the driver.
    """

    MANIFEST = "version long, operation string, part string, bucket int, folder string, num_rows long, layout string"

    def __init__(self, spark: SparkSession, root: str, keys: list[str], buckets: int = 1024):
        self.spark, self.root, self.keys, self.buckets = spark, root.rstrip("/"), keys, buckets

    def placed(self, df: DataFrame) -> DataFrame:
        return df.withColumn("_bucket", F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int"))

    def manifests(self) -> DataFrame:
        try:
            return self.spark.read.schema(self.MANIFEST).json(f"{self.root}/manifest/*")
        except AnalysisException as e:  # nothing was ever committed
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], self.MANIFEST)

    def latest(self) -> int | None:
        return self.manifests().agg(F.max("version")).first()[0]

    def _lines(self, version: int | None = None) -> list:
        wanted = self.latest() if version is None else version
        if wanted is None:
            return []
        found = self.manifests().where(F.col("version") == wanted).collect()
        if not found:
            raise ValueError(f"no version {wanted} in {self.root}")
        return found

    def read(self, version: int | None = None, part: str | None = None, buckets: set[int] | None = None) -> DataFrame:
        """Rows of a version (the newest by default), of one part or of some buckets only."""
        lines = self._lines(version)
        if not lines:
            raise ValueError(f"{self.root} holds no version")
        layout = StructType.fromJson(json.loads(lines[0]["layout"]))
        paths = [f"{self.root}/{r['folder']}/_part={r['part']}/_bucket={r['bucket']}" for r in lines
                 if r["bucket"] is not None and part in (None, r["part"]) and (buckets is None or r["bucket"] in buckets)]
        return self.spark.read.schema(layout).parquet(*paths) if paths else self.spark.createDataFrame([], layout)

    def touched(self, batch: DataFrame) -> set[int]:
        """The buckets that the keys of ``batch`` fall into; at most ``buckets`` numbers."""
        return {r[0] for r in self.placed(batch.select(*self.keys)).select("_bucket").distinct().collect()}

    def commit(self, df: DataFrame, operation: str, replaces: set[tuple[str, int]] | None = None,
               part=None) -> int:
        """Write ``df`` as a new version. ``replaces`` names the (part, bucket) pairs whose old files are left out,
        all of them by default; ``part`` is a column that tells the part of a row."""
        before = self._lines()
        version = before[0]["version"] + 1 if before else 0
        folder, layout = f"data/version={version}-{uuid.uuid4().hex}", df.schema.json()
        cells = self.placed(df).withColumn("_part", F.lit(ROWS) if part is None else part)
        # A bucket larger than a partition is split, small ones share a task.
        cells.hint("rebalance", "_part", "_bucket").write.partitionBy("_part", "_bucket").parquet(f"{self.root}/{folder}")
        written = self.spark.read.schema("_part string, _bucket int").parquet(f"{self.root}/{folder}").groupBy(
            "_part", "_bucket").agg(F.count(F.lit(1)).alias("n")).collect()
        kept = [] if replaces is None else [
            (version, operation, r["part"], r["bucket"], r["folder"], r["num_rows"], layout) for r in before
            if r["bucket"] is not None and (r["part"], r["bucket"]) not in replaces]
        lines = kept + [(version, operation, r["_part"], r["_bucket"], folder, r["n"], layout) for r in written]
        self.spark.createDataFrame(lines or [(version, operation, None, None, None, 0, layout)], self.MANIFEST).coalesce(
            1).write.mode("errorifexists").json(f"{self.root}/manifest/{version}")
        return version

    def history(self) -> DataFrame:
        """Version, operation and number of rows of every version."""
        return self.manifests().groupBy("version", "operation").agg(F.sum("num_rows").alias("num_rows"))


def upsert_stored(target: BucketedTable, source: DataFrame) -> int:
    """Put the rows of ``source`` in the place of those with their keys; only touched buckets are read and written.

    ``source`` is stored first, so that its buckets and its rows come from one evaluation. An empty one commits a
    version with the files of the last.
    """
    batch = stage_table(source, "batch")
    touched = target.touched(batch)
    old = target.read(buckets=touched).select(*batch.columns)
    return target.commit(upsert_by_key(old, batch, target.keys), "UPSERT", {(ROWS, b) for b in touched})


def _by_state():
    return F.when(F.coalesce("is_current", F.lit(False)), CURRENT).otherwise(CLOSED)


def create_history(target: BucketedTable, history: DataFrame) -> int:
    """Store a type 2 history, closed rows apart from current ones."""
    return target.commit(history, "WRITE", part=_by_state())


def scd2_stored(target: BucketedTable, changes: DataFrame, tracked: str, attributes: list[str], date: str,
                null_safe: bool = False) -> int:
    """``scd2_merge`` into a stored history: the current rows of touched buckets are written anew, rows closed by
    the batch are added to the closed part, everything else keeps its files."""
    batch = stage_table(changes, "batch")
    touched = target.touched(batch)
    now = target.read(part=CURRENT, buckets=touched)
    merged = scd2_merge(now, batch, target.keys[0], tracked, attributes, date, null_safe)
    return target.commit(merged, "MERGE", {(CURRENT, b) for b in touched}, part=_by_state())
