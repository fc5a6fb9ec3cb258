"""Event-time windows over streams, and bounded runs of a stream."""

from __future__ import annotations

import json
import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

# Fixed values of the page-view job.
WINDOW, DELAY = "5 minutes", "10 minutes"
PAGE_VIEW = "event_time timestamp, user_id string, page string"


def json_stream(spark: SparkSession, path: str, schema: str, files_per_trigger: int | None = None) -> DataFrame:
    """Typed rows of JSON lines arriving as files; unreadable lines give null fields."""
    reader = spark.readStream.schema("value string")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.text(path).select(F.from_json("value", schema).alias("r")).select("r.*")


def tumbling_count(stream: DataFrame, ts: str, key: str, size: str = WINDOW, delay: str | None = DELAY,
                   slide: str | None = None) -> DataFrame:
    """Rows per window and key. The same call works on a batch frame."""
    timed = stream.withWatermark(ts, delay) if delay else stream
    return timed.groupBy(F.window(ts, size, slide or size), key).agg(F.count(F.lit(1)).alias("count")).select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), key, "count")


def rate_tumbling_count(spark: SparkSession, rows_per_second: int = 10, size: str = "5 seconds",
                        delay: str = "5 seconds") -> DataFrame:
    """Rows per window of the built-in rate source."""
    rate = spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()
    return tumbling_count(rate.withColumn("source", F.lit("rate")), "timestamp", "source", size, delay)


def finish(running: StreamingQuery, wait: float | None) -> StreamingQuery:
    """Wait for the end of a stream, without a limit unless ``wait`` seconds are given."""
    if wait is None:
        running.awaitTermination()
    elif not running.awaitTermination(wait):
        running.stop()
        raise TimeoutError("the stream did not finish in time")
    return running


def run_available(stream: DataFrame, path: str, mode: str = "append", wait: float | None = None,
                  every: str | None = None) -> StreamingQuery:
    """Process what has arrived and stop, or with ``every`` go on in processing-time intervals.

    Append goes to a Parquet table, other modes to one folder per batch. A batch that is run again
    overwrites its own folder, so a restart repeats nothing.
    """
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", f"{path}/checkpoint").trigger(
        **({"processingTime": every} if every else {"availableNow": True}))
    if mode == "append":
        running = writer.format("parquet").start(f"{path}/out")
    else:
        running = writer.foreachBatch(
            lambda df, n: df.withColumn("batch", F.lit(n)).write.mode("overwrite").parquet(f"{path}/out/part={n}")).start()
    return running if every else finish(running, wait)


class WatermarkLog(StreamingQueryListener):
    """What each run of a stream read and what its watermark dropped, one entry per run in the order of starts.

    Reads the progress of every micro batch as it comes (the query object keeps only the last ones) and adds it
    up, so a run of any length costs one entry. ``observed`` names the metrics of ``observe_arrivals``; streams
    without them are not logged. Used with ``with``: the listener is on while its block runs.
    """

    def __init__(self, spark: SparkSession, observed: str = "arrivals"):
        self.spark, self.observed = spark, observed
        self.runs: dict[str, dict] = {}
        self.ended: dict[str, threading.Event] = {}

    def __enter__(self) -> WatermarkLog:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_) -> None:
        self.spark.streams.removeListener(self)

    def onQueryStarted(self, event) -> None:
        self.ended.setdefault(str(event.runId), threading.Event())

    def onQueryProgress(self, event) -> None:
        self.add(json.loads(event.progress.json))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended.setdefault(str(event.runId), threading.Event()).set()

    def add(self, progress: dict) -> None:
        """Add one micro batch, as Spark's progress JSON, to its run."""
        seen = progress.get("observedMetrics", {}).get(self.observed)
        if seen is None and progress["runId"] not in self.runs:
            return
        run = self.runs.setdefault(progress["runId"], {"rows": 0, "newest_us": None, "watermark": None, "dropped": 0})
        seen = seen or {}
        run["rows"] += seen.get("rows") or 0
        newest = [t for t in (run["newest_us"], seen.get("newest_us")) if t is not None]
        run["newest_us"] = max(newest, default=None)
        run["watermark"] = progress.get("eventTime", {}).get("watermark", run["watermark"])
        run["dropped"] += sum(op.get("numRowsDroppedByWatermark", 0) for op in progress.get("stateOperators", []))

    def finished(self, running: StreamingQuery, wait: float = 60) -> None:
        """Wait until the events of a query that has ended are in; listeners hear of them a little later."""
        if not self.ended.setdefault(str(running.runId), threading.Event()).wait(wait):
            raise TimeoutError("no end of the stream was announced")

    def frame(self) -> DataFrame:
        """One row per run: rows read, newest event time, watermark at its end, and the rows its state refused.

        Spark folds the rows of a batch per window and key before the state sees them, so ``dropped`` counts late
        windows and keys, not arrivals.
        """
        rows = [(n, r["rows"], r["newest_us"], r["watermark"], r["dropped"]) for n, r in enumerate(self.runs.values())]
        found = self.spark.createDataFrame(rows, "run int, rows bigint, newest_us bigint, mark string, dropped bigint")
        mark = F.unix_micros(F.to_timestamp("mark"))
        return found.select("run", "rows", "newest_us", F.when(mark > 0, mark).alias("watermark_us"), "dropped")


def observe_arrivals(stream: DataFrame, ts: str, name: str = "arrivals") -> DataFrame:
    """``stream`` with its row count and newest time observed per micro batch."""
    return stream.observe(name, F.count(F.lit(1)).alias("rows"), F.max(F.unix_micros(ts)).alias("newest_us"))


def newest_rows(updates: DataFrame, keys: list[str]) -> DataFrame:
    """Last version of every row an update-mode stream has written."""
    cols = [c for c in updates.columns if c not in (*keys, "batch", "part")]
    return updates.groupBy(*keys).agg(F.max_by(F.struct(*cols), "batch").alias("_r")).select(*keys, "_r.*")


def newest_batch(updates: DataFrame) -> DataFrame:
    """What a complete-mode stream wrote last."""
    return updates.where(F.col("batch") == updates.agg(F.max("batch")).scalar()).drop("batch", "part")


def feed(slices: list[DataFrame], folder: str, run: Callable[[], object]) -> None:
    """Let slices arrive one after the other; the stream is restarted from its checkpoint for each."""
    for one in slices:
        one.write.mode("append").json(folder)
        run()
