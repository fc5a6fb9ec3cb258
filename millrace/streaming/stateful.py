"""Keyed state across micro-batches.

The state is a small table next to the output: batch N reads what batch N-1 left, works on its rows
with the batch operators, and writes output and state under its own number. A batch that is run
again overwrites both, so a lost executor or a restart never counts a row twice. Because the batch
operators split hot keys, a key that fills most of a batch is still spread over many tasks.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from millrace.operators.running import Running, running
from millrace.operators.timeseries import ALERT_THRESHOLD, number_arrival_sessions, sliding_count
from millrace.session import stage_table
from millrace.streaming.windows import finish

Step = Callable[[DataFrame, DataFrame | None], tuple[DataFrame, DataFrame]]


def run_stateful(stream: DataFrame, step: Step, path: str, wait: float | None = None) -> None:
    """Process what has arrived with ``step(rows, state) -> (output, new state)`` and stop.

    The state of the batch before must be there; a batch never goes on as if nothing had come before it.
    """
    spark = stream.sparkSession

    def handle(rows: DataFrame, batch: int) -> None:
        state = spark.read.parquet(f"{path}/state/{batch - 1}") if batch else None
        rows.persist()
        try:
            output, left = step(rows, state)
            left.write.mode("overwrite").parquet(f"{path}/state/{batch}")
            output.write.mode("overwrite").parquet(f"{path}/out/batch={batch}")
        finally:
            rows.unpersist()

    query = stream.writeStream.foreachBatch(handle).option(
        "checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start()
    finish(query, wait)


def last_state(stream: DataFrame, path: str, batches: int) -> DataFrame:
    """State left by the last of ``batches`` micro-batches."""
    return stream.sparkSession.read.parquet(f"{path}/state/{batches - 1}")


def session_step(key: str, ts: str, order: list[str], gap: int) -> Step:
    """Arrival-order sessions: output the ones that closed, keep the open one of each key."""
    cols = [key, "session_start", "session_end", "event_count"]

    def step(rows: DataFrame, state: DataFrame | None) -> tuple[DataFrame, DataFrame]:
        now = rows.select(key, F.col(ts).alias("_ts"), *order, F.lit(1).alias("_held"), F.lit(1).cast("long").alias("_n"),
                          F.col(ts).alias("_start"))
        if state is not None:
            held = state.select(key, F.col("session_end").alias("_ts"),
                                *[F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in order],
                                F.lit(0).alias("_held"), F.col("event_count").alias("_n"),
                                F.col("session_start").alias("_start"))
            now = now.unionByName(held)
        by = ["_held", *order]
        numbered = number_arrival_sessions(now, [key], "_ts", by, gap)
        sessions = numbered.groupBy(key, "session_no").agg(
            F.min_by("_start", F.struct(*by)).alias("session_start"), F.max("_ts").alias("session_end"),
            F.sum("_n").alias("event_count"))
        newest = sessions.groupBy(F.col(key).alias("_k")).agg(F.max("session_no").alias("_last"))
        marked = stage_table(sessions.join(newest, F.col(key).eqNullSafe(F.col("_k"))), "sessions")
        return (marked.where(F.col("session_no") < F.col("_last")).select(*cols),
                marked.where(F.col("session_no") == F.col("_last")).select(*cols))
    return step


def late_step(group: str, ts: str, order: list[str]) -> Step:
    """Flag rows older than the newest time of their group so far; keep that time per group."""
    def step(rows: DataFrame, state: DataFrame | None) -> tuple[DataFrame, DataFrame]:
        now = rows.withColumn("_held", F.lit(1))
        if state is not None:
            now = now.unionByName(state.withColumn("_held", F.lit(0)), allowMissingColumns=True)
        seen = running(now, [group], ["_held", *order], [Running("_seen", "max", F.col(ts), before=True)])
        out = seen.where(F.col("_held") == 1).withColumn(
            "is_late", F.col(ts) < F.coalesce("_seen", F.lit(-1))).drop("_held", "_seen")
        return out, now.groupBy(group).agg(F.max(ts).alias(ts))
    return step


def alert_step(key: str, ts: str, seq: str, width: int, threshold: int = ALERT_THRESHOLD) -> Step:
    """Rows at which the last ``width`` time units hold ``threshold`` events; keep only that much history."""
    def step(rows: DataFrame, state: DataFrame | None) -> tuple[DataFrame, DataFrame]:
        now = rows.select(key, ts, seq, F.lit(1).cast("long").alias("_w"), F.lit(True).alias("_new"))
        if state is not None:
            now = now.unionByName(state.select(
                key, ts, F.lit(-1).cast("long").alias(seq), F.col("n").alias("_w"), F.lit(False).alias("_new")))
        counted = sliding_count(now, [key], ts, seq, width, weight="_w")
        out = counted.where(F.col("_new") & (F.col("window_count") >= threshold)).drop("_w", "_new")
        per_instant = now.groupBy(key, ts).agg(F.sum("_w").alias("n"))
        newest = now.groupBy(F.col(key).alias("_k")).agg(F.max(ts).alias("_top"))
        left = per_instant.join(newest, F.col(key).eqNullSafe(F.col("_k"))).where(
            F.col(ts) >= F.col("_top") - width).select(key, ts, "n")
        return out, left
    return step
