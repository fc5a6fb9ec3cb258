"""Parquet tables: plain, partitioned by capture, versioned, and bulk loads."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F


SMALL_BYTES = 256 * 1024 * 1024
TASK_BYTES = 8 * 1024 * 1024  # of a file of narrow rows, some hundred thousand of them


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread(df: DataFrame, task_bytes: int | None = None) -> DataFrame:
    """Deal the rows of a small input to all cores before costly per-row work.

    A file with one row group is read by one task. Inputs beyond ``SMALL_BYTES`` have splits enough
    and stay as they are, so nothing large is shuffled for this. Narrow rows that each cost much are dealt at any
    size with ``task_bytes`` (``TASK_BYTES``): a split of the file holds millions of them, and one task would work for long.
    """
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if size > SMALL_BYTES and task_bytes is None:
        return df
    wanted = -(-size // task_bytes) if task_bytes else 0
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, wanted))


def parquet_sink(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` and return the stored rows."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def safe_query(query: Column) -> Column:
    """Folder name of a query: blanks to underscores, lower case."""
    return F.lower(F.replace(query, F.lit(" "), F.lit("_")))


def partitioned_snapshot_write(df: DataFrame, path: str) -> None:
    """One folder per source, query and capture time, with few files each.

    Rows of a folder go to one task, so the number of files does not grow with the tasks; the rebalance
    splits a folder that is too large for one.
    """
    folders = ["source", "query", "captured_at"]
    named = df.withColumn("query", safe_query(F.col("query")))
    named.hint("rebalance", *folders).write.mode("append").partitionBy(*folders).parquet(path)


def warehouse_columns(df: DataFrame) -> DataFrame:
    """Column names in upper case."""
    return df.toDF(*[c.upper() for c in df.columns])


def warehouse_load(df: DataFrame, path: str) -> DataFrame:
    """Append to a Parquet table with upper-case columns and return the table."""
    loaded = warehouse_columns(df)
    loaded.write.mode("append").parquet(path)
    return df.sparkSession.read.schema(loaded.schema).parquet(path)


class SnapshotTable:
    """A table kept as immutable numbered snapshots with a history of what made each one.

    Data goes to a folder no one has used before; the version exists once its history row is
    written, so an attempt that died half way is never read.
    """

    HISTORY = "version bigint, operation string, num_rows bigint, folder string"

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def history(self) -> DataFrame:
        try:
            return self.spark.read.schema(self.HISTORY).json(f"{self.root}/history/*")
        except AnalysisException as e:  # nothing was ever committed
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], self.HISTORY)

    def latest(self) -> int | None:
        return self.history().agg(F.max("version")).first()[0]

    def commit(self, df: DataFrame, operation: str) -> int:
        last = self.latest()
        version = 0 if last is None else last + 1
        folder = f"data/version={version}-{uuid.uuid4().hex}"
        df.write.parquet(f"{self.root}/{folder}")
        rows = self.spark.read.parquet(f"{self.root}/{folder}").count()
        entry = self.spark.createDataFrame([(version, operation, rows, folder)], self.HISTORY)
        entry.coalesce(1).write.mode("errorifexists").json(f"{self.root}/history/{version}")
        return version

    def read(self, version: int | None = None) -> DataFrame:
        wanted = self.latest() if version is None else version
        found = self.history().where(F.col("version") == wanted).first()
        if found is None:
            raise ValueError(f"no version {wanted} in {self.root}")
        return self.spark.read.parquet(f"{self.root}/{found['folder']}")
