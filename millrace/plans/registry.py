"""Queries over the given tables, by name, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.session import prepare
from millrace.sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; ``sql`` is left out where no SQL can say the same."""
    def add(fn: Query) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(prepare(spark), folder)
        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return add


def events(spark: SparkSession, folder: str) -> DataFrame:
    """Events with the time in microseconds (``us``) and whole seconds (``sec``)."""
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    return table(spark, folder, "events").withColumn("us", us).withColumn(
        "sec", F.expr("us div 1000000")).drop("ts")


# The same columns in SQL.
EVENTS_SQL = "(SELECT *, epoch_us(ts) AS us, epoch_us(ts) // 1000000 AS sec FROM events)"

# A late-arrival rule over the events: every fifth event id is delayed by up to twelve hours.
DELAY_SQL = "us + (event_id % 5) * 10800000000"


def delayed(df: DataFrame) -> DataFrame:
    """Events with an ``arrival`` time that puts some of them behind younger ones."""
    return df.withColumn("arrival", F.col("us") + (F.col("event_id") % 5) * F.lit(10_800_000_000))
