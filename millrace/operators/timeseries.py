"""Windowed and ordered operators over event rows.

Times are whole numbers in the unit the caller chooses (seconds or microseconds); ``seq`` is the
arrival order and breaks ties. Every operator takes key columns and stays exact for hot keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from millrace.operators.running import Running, find_hot_keys, running, same_named

# Fixed values of the session and alert rules.
SESSION_GAP_SECONDS = 1800
ERROR_WINDOW_SECONDS = 60
ALERT_THRESHOLD = 3
ROLLING_SECONDS = 300


def click_filter(df: DataFrame, status: str = "status", amount: str = "amount") -> DataFrame:
    """Successful rows with a positive amount. NaN sorts above every number here, so it is named."""
    a = F.col(amount)
    return df.where((F.col(status) == "success") & a.isNotNull() & ~F.isnan(a) & (a > 0))


# Amounts are added up as decimals, so what leaves a frame cancels exactly what once entered it.
EXACT = "decimal(38,12)"


def rolling_mean(df: DataFrame, keys: list[str], second: str, amount: str, seq: str,
                 seconds: int = ROLLING_SECONDS, hot_rows: int | None = None) -> DataFrame:
    """Mean of ``amount`` over ``(t - seconds, t]`` for every row. Ties show the amount that arrived last.

    Amounts enter a running sum at their second and leave it ``seconds`` later, so the work does not depend
    on the width of the frame, and ``running`` splits hot keys. Amounts keep twelve decimal places.
    """
    rows = df.withColumn("_timeless", F.col(second).isNull())
    by = [*keys, "_timeless"]
    per_second = rows.groupBy(*by, second).agg(
        F.sum(F.col(amount).cast(EXACT)).alias("_sum"), F.count(amount).alias("_n"), F.max_by(amount, seq).alias("_last"))
    enter = per_second.select(*by, F.col(second).alias("_t"), "_sum", "_n")
    leave = per_second.where(~F.col("_timeless")).select(*by, (F.col(second) + seconds).alias("_t"), -F.col("_sum"), -F.col("_n"))
    steps = enter.union(leave).groupBy(*by, "_t").agg(
        F.coalesce(F.sum("_sum"), F.lit(0)).cast(EXACT).alias("_sum"), F.sum("_n").alias("_n"))
    held = running(steps, by, ["_t"], [Running("_held", "sum", F.col("_sum")), Running("_count", "sum", F.col("_n"))],
                   hot_rows=hot_rows)
    means = held.select(*by, F.col("_t").alias(second), (
        F.col("_held").cast("double") / F.nullif(F.col("_count"), F.lit(0))).alias("_mean"))
    last = per_second.select(*by, second, "_last")
    found = last.alias("l").join(means.alias("r"), same_named([*by, second])).select("l.*", "r._mean")
    return rows.alias("l").join(found.alias("r"), same_named([*by, second])).select(
        *[F.col(f"l.{c}") for c in df.columns if c != amount], F.col("r._last").alias(amount),
        F.col("r._mean").alias("rolling_mean_amount"))


def _sweep(events: DataFrame, ts: str, width: int, weight: str | None = None) -> tuple[DataFrame, DataFrame]:
    n = F.lit(1) if weight is None else F.col(weight)
    arrive = events.withColumn("_t", F.col(ts)).withColumn("_kind", F.lit(1)).withColumn("_d", n)
    leave = events.withColumn("_t", F.col(ts) + width + 1).withColumn("_kind", F.lit(0)).withColumn("_d", -n)
    return arrive, leave


def sliding_count(events: DataFrame, keys: list[str], ts: str, seq: str, width: int, name: str = "window_count",
                  weight: str | None = None, hot_rows: int | None = None) -> DataFrame:
    """Events in ``[t - width, t]`` at each event, counting those that came no later than itself.

    Every event enters the count at ``t`` and leaves just after ``t + width``; the count is then one
    running sum, so dense windows cost no more than sparse ones. A row may stand for ``weight`` events.
    """
    arrive, leave = _sweep(events, ts, width, weight)
    counted = running(arrive.unionByName(leave), keys, ["_t", "_kind", seq],
                      [Running(name, "sum", F.col("_d"))], hot_rows=hot_rows)
    return counted.where(F.col("_kind") == 1).drop("_t", "_kind", "_d")


def window_probe_count(events: DataFrame, probes: DataFrame, keys: list[str], ts: str, width: int,
                       name: str = "window_count", hot_rows: int | None = None) -> DataFrame:
    """Events in ``[t - width, t]`` at each probe time; a probe adds nothing itself."""
    arrive, leave = _sweep(events.select(*keys, ts), ts, width)
    steps = arrive.unionByName(leave).groupBy(*keys, "_t", "_kind").agg(F.sum("_d").alias("_d"))
    asked = probes.withColumn("_t", F.col(ts)).withColumn("_kind", F.lit(2)).withColumn("_d", F.lit(0))
    every = steps.unionByName(asked, allowMissingColumns=True)
    order = ["_t", "_kind", "_tie"]
    every = every.withColumn("_tie", F.xxhash64(*[F.col(c) for c in every.columns]))
    counted = running(every, keys, order, [Running(name, "sum", F.col("_d"))], hot_rows=hot_rows)
    return counted.where(F.col("_kind") == 2).select(*probes.columns, name)


def error_alert(counted: DataFrame, name: str = "window_count", threshold: int = ALERT_THRESHOLD) -> DataFrame:
    """One alert per event at which the window holds ``threshold`` events or more."""
    return counted.where(F.col(name) >= threshold)


def sessionize_event_time(df: DataFrame, keys: list[str], ts: str, gap: int = SESSION_GAP_SECONDS,
                          hot_rows: int | None = None) -> DataFrame:
    """Sessions in event time; a pause of ``gap`` or more starts a new one.

    Two events of one gap-wide slot always share a session, so slots are added up before the shuffle
    and the window sees at most one row per key and slot. Keys with very many slots are read in pieces.
    """
    slots = df.groupBy(*keys, F.floor(F.col(ts) / gap).alias("_slot")).agg(
        F.min(ts).alias("_lo"), F.max(ts).alias("_hi"), F.count(F.lit(1)).alias("_n"))
    hot = find_hot_keys(slots, keys, hot_rows)
    seen = running(slots, keys, ["_slot"], [Running("_prev", "max", F.col("_hi"), before=True)], hot=hot)
    fresh = F.when(F.col("_prev").isNull() | (F.col("_lo") - F.col("_prev") >= gap), 1).otherwise(0)
    numbered = running(seen, keys, ["_slot"], [Running("_session", "sum", fresh)], hot=hot)
    return numbered.groupBy(*keys, "_session").agg(
        F.min("_lo").alias("session_start"), F.max("_hi").alias("session_end"),
        F.sum("_n").alias("event_count")).drop("_session")


def session_count_by_user(df: DataFrame, keys: list[str], ts: str, gap: int) -> DataFrame:
    """Number of event-time sessions per key."""
    return sessionize_event_time(df, keys, ts, gap).groupBy(*keys).agg(F.count(F.lit(1)).alias("session_count"))


def number_arrival_sessions(df: DataFrame, keys: list[str], ts: str, order: list[str],
                            gap: int = SESSION_GAP_SECONDS, hot_rows: int | None = None) -> DataFrame:
    """Give each row the number of its arrival-order session within its key."""
    hot = find_hot_keys(df, keys, hot_rows)
    seen = running(df, keys, order, [Running("_prev", "max", F.col(ts), before=True)], hot=hot)
    fresh = F.when(F.col("_prev").isNull() | (F.col(ts) - F.col("_prev") >= gap), 1).otherwise(0)
    return running(seen, keys, order, [Running("session_no", "sum", fresh)], hot=hot).drop("_prev")


def sessionize_arrival(df: DataFrame, keys: list[str], ts: str, order: list[str],
                       gap: int = SESSION_GAP_SECONDS, hot_rows: int | None = None) -> DataFrame:
    """Sessions in arrival order: late rows only raise the count, the first arrival is the start."""
    numbered = number_arrival_sessions(df, keys, ts, order, gap, hot_rows)
    return numbered.groupBy(*keys, "session_no").agg(
        F.min_by(ts, F.struct(*order)).alias("session_start"), F.max(ts).alias("session_end"),
        F.count(F.lit(1)).alias("event_count"))


def interval_merge(df: DataFrame, keys: list[str], start: str = "start", end: str = "end",
                   hot_rows: int | None = None) -> DataFrame:
    """Union of overlapping or touching intervals, per key or (without keys) over the whole table.

    Equal intervals are one from the start, so the order over the rest is complete.
    """
    df = df.select(*keys, start, end).distinct()
    hot = find_hot_keys(df, keys, hot_rows) if keys else None
    seen = running(df, keys, [start, end],
                   [Running("_reach", "max", F.col(end), before=True)], hot=hot, hot_rows=hot_rows)
    fresh = F.when(F.col("_reach").isNull() | (F.col(start) > F.col("_reach")), 1).otherwise(0)
    islands = running(seen, keys, [start, end], [Running("_island", "sum", fresh)], hot=hot, hot_rows=hot_rows)
    return islands.groupBy(*keys, "_island").agg(
        F.min(start).alias(start), F.max(end).alias(end)).drop("_island")


def flag_late(df: DataFrame, keys: list[str], ts: str, order: list[str], hot_rows: int | None = None) -> DataFrame:
    """Mark rows older than the newest time already emitted. Late rows stay."""
    seen = running(df, keys, order, [Running("_seen", "max", F.col(ts), before=True)], hot_rows=hot_rows)
    return seen.withColumn("is_late", F.col(ts) < F.coalesce("_seen", F.lit(-1))).drop("_seen")


def flag_stall(df: DataFrame, source: str, arrival: str, seq: str, timeout: int,
               hot_rows: int | None = None) -> DataFrame:
    """Mark rows that came after their source was silent for longer than ``timeout``."""
    seen = running(df, [source], [arrival, seq], [Running("_prev", "max", F.col(arrival), before=True)],
                   hot_rows=hot_rows)
    silent = F.col(arrival) - F.col("_prev")
    return seen.withColumn("silence", silent).withColumn(
        "is_stalled", F.coalesce(silent > timeout, F.lit(False))).drop("_prev")


def asof_latest(history: DataFrame, probes: DataFrame, keys: list[str], ts: str, value: str, seq: str,
                missing: str | None = "", hot_rows: int | None = None) -> DataFrame:
    """Newest ``value`` with a time no later than each probe; equal times give the one set last."""
    old = history.select(*keys, F.col(ts).alias("_t"), F.lit(0).alias("_ask"), F.col(seq).alias("_seq"),
                         F.struct(F.col(ts).alias("t"), F.col(seq).alias("s"), F.col(value).alias("v")).alias("_h"))
    ask = probes.select(*keys, F.col(ts).alias("_t"), F.lit(1).alias("_ask"), F.col(seq).alias("_seq"),
                        F.struct(*probes.columns).alias("_row"))
    both = old.unionByName(ask, allowMissingColumns=True)
    found = running(both, keys, ["_t", "_ask", "_seq"], [Running("_hit", "max", F.col("_h"))], hot_rows=hot_rows)
    answer = F.when(F.col("_hit").isNull(), F.lit(missing)).otherwise(F.col("_hit.v"))
    return found.where(F.col("_ask") == 1).select("_row.*", answer.alias(value))


def kway_merge(streams: DataFrame, stream: str, ts: str, order: list[str], hot_rows: int | None = None) -> DataFrame:
    """Order in which a merge of the streams hands out rows: a stream never overtakes its own rows.

    Adds ``merge_ts``, the newest time of the stream so far. Sort by (merge_ts, stream, *order).
    """
    return running(streams, [stream], order, [Running("merge_ts", "max", F.col(ts))], hot_rows=hot_rows)


def with_position(df: DataFrame, order: list[str], name: str = "position", hot_rows: int | None = None) -> DataFrame:
    """1-based position in one global order."""
    return running(df, [], order, [Running(name, "sum", F.lit(1))], hot_rows=hot_rows)
