"""Token buckets over request rows.

The refill is ``tokens`` per ``period`` time units. Levels are whole numbers, a token being
``period`` units of credit, so results do not depend on rounding.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, IntegralType, LongType

from millrace.operators.running import NO_HOT_KEYS, PIECE_ROWS, Running, find_hot_keys, hinted, running, same_named
from millrace.session import cut_lineage


def _grant(t: np.ndarray, n: np.ndarray, credit: int, last: int, capacity: int, tokens: int,
           period: int) -> tuple[np.ndarray, int, int]:
    """Requests granted per instant. While the bucket is empty it jumps to the next instant that can pay."""
    out = np.zeros(len(t), dtype=np.int64)
    i, full = 0, capacity * period
    while i < len(t):
        credit = min(full, credit + int(t[i] - last) * tokens)
        last = int(t[i])
        take = min(int(n[i]), credit // period)
        out[i] = take
        credit -= take * period
        i += 1
        if credit < period:
            ready = last + -(-(period - credit) // tokens)
            i = max(i, int(np.searchsorted(t, ready, side="left")))
    return out, credit, last


class _Effect:
    """What a run of instants does to the credit, for every credit it may open with.

    The map from opening to closing credit is kept in steps: from ``lo`` on, up to the next step, the closing credit
    is ``val``, and rises with the opening credit where ``slope`` is 1. A refill shifts all steps, the capacity
    flattens what is above it, and a grant cuts steps at whole tokens. Neighbours that join up are one step.
    """

    def __init__(self, capacity: int, tokens: int, period: int):
        self.full, self.tokens, self.period = capacity * period, tokens, period
        self.lo, self.val, self.slope = (np.array([x], dtype=np.int64) for x in (0, 0, 1))
        self.last: int | None = None

    def _widths(self) -> np.ndarray:
        return np.diff(self.lo, append=self.full + 1)

    def _cut(self, step: np.ndarray, at: np.ndarray) -> None:
        """Start a new step ``at`` places into each numbered step."""
        slope = self.slope[step]
        lo = np.concatenate([self.lo, self.lo[step] + at])
        order = np.argsort(lo, kind="stable")
        self.lo = lo[order]
        self.val = np.concatenate([self.val, self.val[step] + slope * at])[order]
        self.slope = np.concatenate([self.slope, slope])[order]

    def _refill(self, amount: int) -> None:
        self.val = self.val + min(amount, self.full)
        over = np.flatnonzero((self.slope == 1) & (self.val < self.full) & (self.val + self._widths() - 1 > self.full))
        if len(over):
            self._cut(over, self.full - self.val[over])
        high = self.val >= self.full
        self.val[high], self.slope[high] = self.full, 0

    def _grant(self, n: int) -> None:
        top = np.minimum((self.val + self.slope * (self._widths() - 1)) // self.period, n)
        many = np.maximum(top - self.val // self.period, 0)
        if many.any():
            step = np.repeat(np.arange(len(many)), many)
            nth = np.arange(len(step)) - np.repeat(np.cumsum(many) - many, many) + 1
            self._cut(step, (self.val[step] // self.period + nth) * self.period - self.val[step])
        self.val = self.val - np.minimum(self.val // self.period, n) * self.period

    def _join(self) -> None:
        if len(self.lo) > 1:
            same = (self.slope[1:] == self.slope[:-1]) & (
                self.val[1:] == self.val[:-1] + self.slope[:-1] * np.diff(self.lo))
            keep = np.append(True, ~same)
            self.lo, self.val, self.slope = self.lo[keep], self.val[keep], self.slope[keep]

    def feed(self, t: np.ndarray, n: np.ndarray) -> None:
        """Take in more instants. The opening credit is that of the first instant, refill included."""
        for i in range(len(t)):
            if len(self.lo) == 1 and not self.slope[0]:  # whatever it opened with, the credit is known from here on
                credit, self.last = _grant(t[i:], n[i:], int(self.val[0]), self.last, self.full // self.period,
                                           self.tokens, self.period)[1:]
                self.val = np.array([credit], dtype=np.int64)
                return
            if self.last is not None:
                self._refill((int(t[i]) - self.last) * self.tokens)
            self.last = int(t[i])
            self._grant(int(n[i]))
            self._join()

    def steps(self) -> list[list[int]]:
        return [self.lo.tolist(), self.val.tolist(), self.slope.tolist()]


def _segments(batch: pa.RecordBatch, starts: np.ndarray) -> Iterator[tuple[int, int]]:
    cuts = [0, *(np.flatnonzero(starts[1:]) + 1).tolist(), batch.num_rows]
    return zip(cuts, cuts[1:])


def _openings(stretches: DataFrame, keys: list[str], ts: str, capacity: int, tokens: int, period: int) -> DataFrame:
    """Rows of long stretches, cut by time into ``_piece``; each piece's first row has its opening credit ``_open``.

    Pieces find their effects apart. The table of effects, one row a piece, is then walked per stretch, which
    gives every piece the credit that the pieces before it leave.
    """
    ident = [*keys, "_stretch", "_piece"]
    ordered = stretches.sortWithinPartitions("_piece", *keys, "_stretch", ts)
    schema = stretches.select(*ident).schema.add("_from", "long").add("_till", "long").add(
        "_steps", ArrayType(ArrayType(LongType())))

    def effects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, effect, begun, before = None, None, 0, None

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [*(head.column(c) for c in ident), pa.array([begun]), pa.array([effect.last]),
                 pa.array([effect.steps()], pa.list_(pa.list_(pa.int64())))], names=[*ident, "_from", "_till", "_steps"])

        for batch in batches:
            if not batch.num_rows:
                continue
            t, n, first, piece = (batch.column(c).to_numpy() for c in (ts, "_n", "_first", "_piece"))
            starts = (first == 1) | (piece != np.append(-1 if before is None else before, piece[:-1]))
            for a, b in _segments(batch, starts):
                if starts[a]:
                    if effect is not None:
                        yield done()
                    head, effect, begun = batch.slice(a, 1), _Effect(capacity, tokens, period), int(t[a])
                effect.feed(t[a:b], n[a:b])
            before = piece[-1]
        if effect is not None:
            yield done()

    def walk(found: pd.DataFrame) -> pd.DataFrame:
        found, opened, credit, till = found.sort_values("_from"), [], capacity * period, None
        for begun, end, (lo, val, slope) in zip(found["_from"], found["_till"], found["_steps"]):
            if till is not None:
                credit = min(capacity * period, credit + int(begun - till) * tokens)
            opened.append(credit)
            i = int(np.searchsorted(lo, credit, side="right")) - 1
            credit, till = int(val[i]) + int(slope[i]) * (credit - int(lo[i])), end
        return found.assign(_open=opened)[[*ident, "_from", "_open"]]

    parts = ordered.mapInArrow(effects, schema)
    opened = parts.groupBy(*keys, "_stretch").applyInPandas(
        walk, stretches.select(*ident).schema.add("_from", "long").add("_open", "long")).alias("o")
    rows = stretches.alias("r")
    met = rows.join(opened, same_named([*keys, "_stretch"], "r", "o") & (F.col("r._piece") == F.col("o._piece")))
    return met.select(*[F.col(f"r.{c}") for c in (*keys, "_stretch", "_piece", ts, "_n")],
                      F.when(F.col(f"r.{ts}") == F.col("o._from"), F.col("o._open")).alias("_open"))


def token_bucket(df: DataFrame, keys: list[str], ts: str, seq: str, capacity: int, tokens: int, period: int,
                 hot_rows: int | None = None, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """Whether each request is let through, one token each; the bucket starts full.

    Requests of one instant are counted first. A pause long enough to fill the bucket whatever its
    level separates stretches that do not depend on each other; a stretch is read as a sorted stream
    of instants, with the level as its only state. A stretch of more than ``hot_rows`` instants is cut into pieces
    of about ``piece_rows``; their effects on the level are found apart and composed (``_openings``), so that no
    task reads all of it. Times that are no integers are counted in millionths.
    """
    columns, given = df.columns, ts
    whole = isinstance(df.schema[given].dataType, IntegralType)
    period = period if whole else period * 1_000_000
    df = df.withColumn("_tick", (F.col(given) if whole else F.round(F.col(given) * 1_000_000)).cast("long"))
    ts = "_tick"
    instants = df.groupBy(*keys, ts).agg(F.count(F.lit(1)).alias("_n"))
    hot = find_hot_keys(instants, keys, hot_rows)
    seen = running(instants, keys, [ts], [Running("_prev", "max", F.col(ts), before=True)], hot=hot)
    refills = (F.col(ts) - F.col("_prev")) * tokens >= capacity * period
    fresh = seen.withColumn("_first", F.when(F.col("_prev").isNull() | refills, 1).otherwise(0))
    stretches = running(fresh, keys, [ts], [Running("_stretch", "sum", F.col("_first"))], hot=hot).select(
        *keys, "_stretch", ts, "_n", "_first")
    part = [*keys, "_stretch"]
    # A key without too many instants has no stretch with too many.
    long = NO_HOT_KEYS if hot.keys is None else find_hot_keys(stretches, part, hot_rows)
    opens = F.when(F.col("_first") == 1, F.lit(capacity * period).cast("long")).alias("_open")
    columns_of = [*part, "_piece", ts, "_n"]
    short = stretches.withColumn("_piece", F.lit(0))
    if long.keys is not None:
        few = hinted(long.keys, long.n_keys).alias("h")
        short = short.alias("s").join(few, same_named(part, "s", "h"), "left_anti")
        warm = stretches.alias("s").join(few, same_named(part, "s", "h"), "left_semi")
        pieces = cut_lineage(warm.repartitionByRange(max(2, math.ceil(long.n_rows / piece_rows)), *part, ts).withColumn(
            "_piece", F.spark_partition_id()))
    rows = short.select(*columns_of, opens)
    if long.keys is not None:
        rows = rows.unionByName(_openings(pieces, keys, ts, capacity, tokens, period))
    schema = rows.select(*keys, ts).schema.add("_granted", "long")

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        credit, last = 0, 0
        for batch in batches:
            t, n = (batch.column(c).to_numpy() for c in (ts, "_n"))
            opened = batch.column("_open")
            starts, level = opened.is_valid().to_numpy(zero_copy_only=False), opened.fill_null(0).to_numpy()
            granted = np.zeros(len(t), dtype=np.int64)
            for a, b in _segments(batch, starts) if len(t) else ():
                if starts[a]:
                    credit, last = int(level[a]), int(t[a])
                granted[a:b], credit, last = _grant(t[a:b], n[a:b], credit, last, capacity, tokens, period)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in (*keys, ts)), pa.array(granted)], names=[*keys, ts, "_granted"])

    ordered = rows.repartition(*part, "_piece").sortWithinPartitions(*part, "_piece", ts)
    granted = ordered.mapInArrow(walk, schema)
    placed = running(df, [*keys, ts], [seq], [Running("_place", "sum", F.lit(1))], hot_rows=hot_rows)
    return placed.alias("r").join(granted.alias("g"), same_named([*keys, ts], "r", "g")).select(
        *[F.col(f"r.{c}") for c in columns], (F.col("_place") <= F.col("_granted")).alias("allowed"))


def token_bucket_wait(df: DataFrame, keys: list[str], ts: str, seq: str, amount: str, capacity: int, tokens: int,
                      period: int, hot_rows: int | None = None) -> DataFrame:
    """When each request of ``amount`` tokens goes ahead if requests queue up in (time, seq) order.

    With every time multiplied by ``tokens`` and every amount by ``period``, the time at which all
    credit spent so far is earned back is ``max(that of the row before, t) + amount``: a running sum
    and a running maximum. A request starts when its spending fits the capacity. ``amount`` must not
    exceed ``capacity``.
    """
    hot = find_hot_keys(df, keys, hot_rows)
    order = [ts, seq]
    cost, at = F.col(amount) * period, F.col(ts) * tokens
    too_big = F.when(F.col(amount) > capacity, F.raise_error(F.lit("amount exceeds the capacity")).cast("long"))
    spent = running(df.withColumn("_cost", F.coalesce(too_big, cost)), keys, order,
                    [Running("_spent", "sum", F.col("_cost"))], hot=hot)
    idle = running(spent, keys, order, [Running("_idle", "max", at - (F.col("_spent") - F.col("_cost")))], hot=hot)
    earliest = F.greatest(at, F.col("_idle") + F.col("_spent") - capacity * period)
    started = running(idle, keys, order, [Running("_start", "max", earliest)], hot=hot)
    return started.select(*df.columns, (F.col("_start") / tokens).alias("start"),
                          ((F.col("_start") - at) / tokens).alias("wait"))
