"""Keyed state in the state store: a batch reads and writes the keys it holds and no others.

The processors below run inside ``transformWithState`` on the RocksDB store, so the work of a batch follows the
batch and not the keys ever seen, and a restart goes on from the checkpoint. A batch is bounded by the source
(``maxFilesPerTrigger`` and the like); the rows that one key has in one batch are ordered in one task, as arrays of
two numbers a row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import LongType, StructField, StructType

from millrace.operators.timeseries import ALERT_THRESHOLD
from millrace.streaming.windows import finish

# Fixed: the store that keeps single keys, and its setting.
STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

OPEN = "start long, end long, n long"
RECENT = "ts long, n long"


def _ordered(rows: Iterator[pd.DataFrame], by: list[str], names: list[str]) -> list[np.ndarray]:
    """The columns ``names`` of a key's rows as whole numbers, in order. A frame costs more than most keys have to do, so
    numbers are ordered as arrays."""
    frames = list(rows)
    whole = frames[0] if len(frames) == 1 else pd.concat(frames, ignore_index=True)
    keys = [whole[c].to_numpy() for c in by]
    if any(k.dtype == object for k in keys):
        order = whole.reset_index(drop=True).sort_values(by, kind="stable").index.to_numpy()
    else:
        order = np.lexsort(keys[::-1])
    return [whole[c].to_numpy(np.int64)[order] for c in names]


class ArrivalSessions(StatefulProcessor):
    """Sessions of a key in arrival order. A row ``gap`` or more after the newest time so far starts the next session.

    A session comes out when the next one starts or, with ``idle_ms``, when the key has been silent for so long; the
    open one of each key is a value of the store.
    """

    def __init__(self, key: str, ts: str, order: list[str], gap: int, idle_ms: int | None = None):
        self.key, self.ts, self.order, self.gap, self.idle_ms = key, ts, order, gap, idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", OPEN)

    def _rows(self, key: tuple, sessions: list[tuple]) -> pd.DataFrame:
        starts, ends, counts = zip(*sessions)
        return pd.DataFrame({self.key: np.full(len(starts), key[0], dtype=object), "session_start": starts,
                             "session_end": ends, "event_count": counts})

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        ts, = _ordered(rows, self.order, [self.ts])
        held = self.open.get()
        first = [held[1]] if held is not None else []
        newest = np.maximum.accumulate(np.concatenate([first, ts]).astype(np.int64))
        before = newest[:-1] if held is not None else np.concatenate([[ts[0]], newest[:-1]])
        starts = np.flatnonzero(ts - before >= self.gap)
        done: list[tuple] = []
        at = 0
        now = tuple(held) if held is not None else (int(ts[0]), int(ts[0]), 0)
        for stop in [*starts.tolist(), len(ts)]:
            if stop > at:
                part = ts[at:stop]
                now = (now[0], max(now[1], int(part.max())), now[2] + len(part))
            if stop < len(ts):
                if now[2]:
                    done.append(now)
                now = (int(ts[stop]), int(ts[stop]), 0)
            at = stop
        self.open.update(now)
        if self.idle_ms is not None:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.idle_ms)
        if done:  # an empty frame would cost as much as a full one
            yield self._rows(key, done)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        held = self.open.get()
        if held is not None:
            self.open.clear()
            yield self._rows(key, [tuple(held)])

    def close(self) -> None:
        pass


class RecentCount(StatefulProcessor):
    """Rows at which the last ``width`` time units of a key hold ``threshold`` rows, both ends included.

    The store keeps the counts per instant of the last ``width`` units of each key; with ``ttl_ms`` a key that has been
    silent for so long leaves it.
    """

    def __init__(self, key: str, ts: str, seq: str, width: int, threshold: int = ALERT_THRESHOLD,
                 ttl_ms: int | None = None):
        self.key, self.ts, self.seq, self.width, self.threshold, self.ttl_ms = key, ts, seq, width, threshold, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.recent = handle.getListState("recent", RECENT, self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        ts, seq = _ordered(rows, [self.ts, self.seq], [self.ts, self.seq])
        held = sorted((int(r[0]), int(r[1])) for r in self.recent.get())
        old = np.array([t for t, _ in held], np.int64)
        sums = np.concatenate([[0], np.cumsum([n for _, n in held], dtype=np.int64)]).astype(np.int64)
        count = (sums[np.searchsorted(old, ts, "right")] - sums[np.searchsorted(old, ts - self.width)]
                 + np.arange(1, len(ts) + 1) - np.searchsorted(ts, ts - self.width))
        hit = count >= self.threshold
        if hit.any():
            yield pd.DataFrame({self.key: np.full(int(hit.sum()), key[0], dtype=object), self.ts: ts[hit],
                                self.seq: seq[hit], "window_count": count[hit]})
        instants, n = np.unique(np.concatenate([old, ts]), return_inverse=True)
        weight = np.bincount(n, np.concatenate([np.diff(sums), np.ones(len(ts), np.int64)])).astype(np.int64)
        keep = instants >= instants[-1] - self.width
        self.recent.put([(int(t), int(w)) for t, w in zip(instants[keep], weight[keep])])

    def close(self) -> None:
        pass


def run_keyed(stream: DataFrame, key: str, processor: StatefulProcessor, columns: list[str], path: str,
              wait: float | None = None, every: str | None = None, clock: bool = False):
    """Process what has arrived, key by key, and append the results to ``path/out``; with ``every`` go on.

    Results are the key and ``columns`` of longs. ``clock`` lets processors use timers and times to live in
    processing time. The store's setting is put on the session only while the query starts.
    """
    spark = stream.sparkSession
    schema = StructType([stream.schema[key], *(StructField(c, LongType()) for c in columns)])
    results = stream.groupBy(key).transformWithStateInPandas(
        processor, schema, "Append", "ProcessingTime" if clock else "None")
    before = spark.conf.get(STORE, None)
    spark.conf.set(STORE, ROCKSDB)
    try:
        query = results.writeStream.outputMode("append").format("parquet").option(
            "checkpointLocation", f"{path}/checkpoint").trigger(
            **({"processingTime": every} if every else {"availableNow": True})).start(f"{path}/out")
    finally:
        if before is None:
            spark.conf.unset(STORE)
        else:
            spark.conf.set(STORE, before)
    return query if every else finish(query, wait)


def run_sessions(stream: DataFrame, key: str, ts: str, order: list[str], gap: int, path: str, wait: float | None = None,
                 every: str | None = None, idle_ms: int | None = None):
    """Closed arrival-order sessions of whole-number times: key, session_start, session_end, event_count."""
    rows = stream.select(key, ts, *order)
    return run_keyed(rows, key, ArrivalSessions(key, ts, order, gap, idle_ms),
                     ["session_start", "session_end", "event_count"], path, wait, every, idle_ms is not None)


def open_sessions(spark: SparkSession, path: str, key: str) -> DataFrame:
    """The sessions that are still open, read from the store of a stopped query."""
    held = spark.read.format("statestore").option("stateVarName", "open").load(f"{path}/checkpoint")
    return held.selectExpr(f"key.{key} AS {key}", "value.start AS session_start", "value.end AS session_end",
                           "value.n AS event_count")


def run_alerts(stream: DataFrame, key: str, ts: str, seq: str, width: int, path: str, threshold: int = ALERT_THRESHOLD,
               wait: float | None = None, every: str | None = None, ttl_ms: int | None = None):
    """Rows at which a key's last ``width`` time units hold ``threshold`` rows: key, ts, seq, window_count."""
    rows = stream.select(key, ts, seq)
    return run_keyed(rows, key, RecentCount(key, ts, seq, width, threshold, ttl_ms), [ts, seq, "window_count"], path, wait,
                     every, ttl_ms is not None)
