"""Time-series queries over ``events`` and order periods."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import timeseries as ts
from millrace.operators.relational import union_streams
from millrace.plans.registry import DELAY_SQL, EVENTS_SQL, delayed, events, query
from millrace.sources.tables import table

CLICKS_SQL = f"""
clicks AS (
  SELECT event_id, user_id, event_type, sec,
         CASE WHEN event_id % 2000 = 0 THEN -100.0 WHEN event_id % 1000 = 0 THEN NULL ELSE value END AS amount
  FROM {EVENTS_SQL} WHERE event_type <> 'error'),
good AS (SELECT * FROM clicks WHERE amount IS NOT NULL AND amount > 0)
"""


def _clicks(spark, d):
    amount = F.when(F.col("event_id") % 2000 == 0, -100.0).when(F.col("event_id") % 1000 == 0, None).otherwise(
        F.col("value"))
    status = F.when(F.col("event_type") == "error", "failed").otherwise("success")
    rows = events(spark, d).select("event_id", "user_id", "event_type", "sec", amount.alias("amount"),
                                   status.alias("status"))
    return ts.click_filter(rows).drop("status")


@query("click_filter", f"WITH {CLICKS_SQL} SELECT event_id, user_id, sec, amount FROM good")
def click_filter(spark, d):
    return _clicks(spark, d).select("event_id", "user_id", "sec", "amount")


def _rolling_sql(key: str, seconds: int) -> str:
    return f"""WITH {CLICKS_SQL}
    SELECT event_id, {key}, sec,
           last_value(amount) OVER (PARTITION BY {key}, sec ORDER BY event_id
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS amount,
           round(avg(amount) OVER (PARTITION BY {key} ORDER BY sec
                                   RANGE BETWEEN {seconds - 1} PRECEDING AND CURRENT ROW), 6) AS rolling_mean_amount
    FROM good"""


def _rolling(spark, d, key, seconds):
    out = ts.rolling_mean(_clicks(spark, d).select("event_id", key, "sec", "amount"), [key], "sec", "amount",
                          "event_id", seconds)
    return out.withColumn("rolling_mean_amount", F.round("rolling_mean_amount", 6))


@query("rolling_mean_5m", _rolling_sql("event_type", 300))
def rolling_mean_5m(spark, d):
    return _rolling(spark, d, "event_type", 300)


@query("rolling_mean_6h_by_user", _rolling_sql("user_id", 21600))
def rolling_mean_6h_by_user(spark, d):
    return _rolling(spark, d, "user_id", 21600)


ERRORS_SQL = f"""
errors AS (SELECT event_id, sec FROM {EVENTS_SQL} WHERE event_type = 'error'),
counted AS (
  SELECT event_id, sec,
         count(*) OVER (ORDER BY sec RANGE BETWEEN 3600 PRECEDING AND CURRENT ROW)
         - count(*) OVER (PARTITION BY sec) + row_number() OVER (PARTITION BY sec ORDER BY event_id) AS window_count
  FROM errors)
"""


def _counted(spark, d):
    errors = events(spark, d).where(F.col("event_type") == "error").select("event_id", "sec")
    return ts.sliding_count(errors, [], "sec", "event_id", 3600)


@query("sliding_error_count", f"WITH {ERRORS_SQL} SELECT event_id, sec, CAST(window_count AS BIGINT) AS window_count FROM counted")
def sliding_error_count(spark, d):
    return _counted(spark, d)


@query("error_alert", f"WITH {ERRORS_SQL} SELECT event_id, sec, CAST(window_count AS BIGINT) AS window_count FROM counted WHERE window_count >= 3")
def error_alert(spark, d):
    return ts.error_alert(_counted(spark, d))


@query("window_probe_count", f"""
WITH e AS (SELECT user_id, sec FROM {EVENTS_SQL} WHERE event_type = 'error'),
     p AS (SELECT event_id, user_id, sec FROM {EVENTS_SQL} WHERE event_type = 'view')
SELECT p.event_id, p.user_id, p.sec, count(e.sec) AS window_count
FROM p LEFT JOIN e ON e.user_id = p.user_id AND e.sec BETWEEN p.sec - 86400 AND p.sec
GROUP BY p.event_id, p.user_id, p.sec""")
def window_probe_count(spark, d):
    e = events(spark, d)
    errors = e.where(F.col("event_type") == "error").select("user_id", "sec")
    probes = e.where(F.col("event_type") == "view").select("event_id", "user_id", "sec")
    return ts.window_probe_count(errors, probes, ["user_id"], "sec", 86400)


def _event_sessions_sql(gap: int) -> str:
    return f"""
    s AS (SELECT user_id, sec, CASE WHEN lag(sec) OVER w IS NULL OR sec - lag(sec) OVER w >= {gap} THEN 1 ELSE 0 END AS fresh
          FROM {EVENTS_SQL} WINDOW w AS (PARTITION BY user_id ORDER BY sec, event_id)),
    n AS (SELECT user_id, sec, fresh, sum(fresh) OVER (PARTITION BY user_id ORDER BY sec
              RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS no FROM s)
    """


@query("session_count_by_user", f"""WITH {_event_sessions_sql(1800)}
SELECT user_id, CAST(sum(fresh) AS BIGINT) AS session_count FROM n GROUP BY user_id""")
def session_count_by_user(spark, d):
    return ts.session_count_by_user(events(spark, d), ["user_id"], "sec", 1800)


@query("sessionize_event_time", f"""WITH {_event_sessions_sql(21600)}
SELECT user_id, min(sec) AS session_start, max(sec) AS session_end, count(*) AS event_count
FROM n GROUP BY user_id, no""")
def sessionize_event_time(spark, d):
    return ts.sessionize_event_time(events(spark, d), ["user_id"], "sec", 21600)


ARRIVAL_SESSIONS_SQL = f"""
a AS (SELECT user_id, sec, event_id, {DELAY_SQL} AS arrival FROM {EVENTS_SQL}),
p AS (SELECT *, max(sec) OVER (PARTITION BY user_id ORDER BY arrival, event_id
                               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pm FROM a),
n AS (SELECT *, sum(CASE WHEN pm IS NULL OR sec - pm >= 21600 THEN 1 ELSE 0 END)
                OVER (PARTITION BY user_id ORDER BY arrival, event_id) AS session_no FROM p)
"""


@query("sessionize_arrival", f"""WITH {ARRIVAL_SESSIONS_SQL}
SELECT user_id, CAST(session_no AS BIGINT) AS session_no, first(sec ORDER BY arrival, event_id) AS session_start,
       max(sec) AS session_end, count(*) AS event_count
FROM n GROUP BY user_id, session_no""")
def sessionize_arrival(spark, d):
    return ts.sessionize_arrival(delayed(events(spark, d)), ["user_id"], "sec", ["arrival", "event_id"], 21600)


@query("interval_merge", """
WITH ship AS (SELECT l_orderkey, max(l_shipdate) AS last_ship FROM lineitem GROUP BY l_orderkey),
iv AS (SELECT o_custkey, epoch(o_orderdate)::BIGINT AS start_sec, epoch(last_ship)::BIGINT AS end_sec
       FROM orders JOIN ship ON l_orderkey = o_orderkey),
p AS (SELECT *, max(end_sec) OVER (PARTITION BY o_custkey ORDER BY start_sec, end_sec
                                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM iv),
n AS (SELECT *, sum(CASE WHEN reach IS NULL OR start_sec > reach THEN 1 ELSE 0 END)
                OVER (PARTITION BY o_custkey ORDER BY start_sec, end_sec ROWS UNBOUNDED PRECEDING) AS island FROM p)
SELECT o_custkey, min(start_sec) AS start_sec, max(end_sec) AS end_sec FROM n GROUP BY o_custkey, island""")
def interval_merge(spark, d):
    seconds = lambda c: F.unix_seconds(F.col(c).cast("timestamp"))
    ship = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.max("l_shipdate").alias("last_ship"))
    periods = table(spark, d, "orders").join(ship, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "o_custkey", seconds("o_orderdate").alias("start_sec"), seconds("last_ship").alias("end_sec"))
    return ts.interval_merge(periods, ["o_custkey"], "start_sec", "end_sec")


@query("interval_merge_keyless", f"""
WITH iv AS (SELECT sec AS start_sec, sec + 120 AS end_sec FROM {EVENTS_SQL}),
p AS (SELECT *, max(end_sec) OVER (ORDER BY start_sec, end_sec ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM iv),
n AS (SELECT *, sum(CASE WHEN reach IS NULL OR start_sec > reach THEN 1 ELSE 0 END)
                OVER (ORDER BY start_sec, end_sec ROWS UNBOUNDED PRECEDING) AS island FROM p)
SELECT min(start_sec) AS start_sec, max(end_sec) AS end_sec FROM n GROUP BY island""")
def interval_merge_keyless(spark, d):
    spans = events(spark, d).select(F.col("sec").alias("start_sec"), (F.col("sec") + 120).alias("end_sec"))
    return ts.interval_merge(spans, [], "start_sec", "end_sec")


@query("flag_late", f"""
WITH a AS (SELECT event_id, sec, {DELAY_SQL} AS arrival FROM {EVENTS_SQL})
SELECT event_id, sec, arrival,
       sec < coalesce(max(sec) OVER (ORDER BY arrival, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -1) AS is_late
FROM a""")
def flag_late(spark, d):
    rows = delayed(events(spark, d)).select("event_id", "sec", "arrival")
    return ts.flag_late(rows, [], "sec", ["arrival", "event_id"])


@query("flag_stall", f"""
WITH a AS (SELECT event_id, event_type, us, us - lag(us) OVER (PARTITION BY event_type ORDER BY us, event_id) AS silence
           FROM {EVENTS_SQL})
SELECT event_id, event_type, coalesce(silence, -1) AS silence, coalesce(silence > 3600000000, false) AS is_stalled FROM a""")
def flag_stall(spark, d):
    rows = events(spark, d).select("event_id", "event_type", "us")
    out = ts.flag_stall(rows, "event_type", "us", "event_id", 3_600_000_000)
    return out.select("event_id", "event_type", F.coalesce("silence", F.lit(-1)).alias("silence"), "is_stalled")


@query("asof_latest", f"""
WITH h AS (SELECT user_id, sec, event_id, CAST(CAST(round(value * 100) AS BIGINT) AS VARCHAR) AS cents
           FROM {EVENTS_SQL} WHERE event_type = 'purchase'),
     u AS (SELECT user_id, sec, arg_max(cents, event_id) AS cents FROM h GROUP BY user_id, sec),
     p AS (SELECT event_id, user_id, sec FROM {EVENTS_SQL} WHERE event_type IN ('click', 'view'))
SELECT p.event_id, p.user_id, p.sec, coalesce(u.cents, '') AS cents
FROM p ASOF LEFT JOIN u ON p.user_id = u.user_id AND p.sec >= u.sec""")
def asof_latest(spark, d):
    e = events(spark, d)
    cents = F.round(F.col("value") * 100).cast("long").cast("string")
    history = e.where(F.col("event_type") == "purchase").select("user_id", "sec", "event_id", cents.alias("cents"))
    probes = e.where(F.col("event_type").isin("click", "view")).select("event_id", "user_id", "sec")
    return ts.asof_latest(history, probes, ["user_id"], "sec", "cents", "event_id")


STREAMS_SQL = f"""
s AS (SELECT event_id, sec, {DELAY_SQL} AS arrival,
             CASE event_type WHEN 'click' THEN 0 WHEN 'view' THEN 1 ELSE 2 END AS stream_idx
      FROM {EVENTS_SQL} WHERE event_type IN ('click', 'view', 'error'))
"""


def _streams(spark, d):
    e = delayed(events(spark, d)).select("event_id", "sec", "arrival", "event_type")
    return union_streams([e.where(F.col("event_type") == k).drop("event_type") for k in ("click", "view", "error")])


@query("stream_union", f"WITH {STREAMS_SQL} SELECT event_id, sec, arrival, stream_idx FROM s")
def stream_union(spark, d):
    return _streams(spark, d)


@query("kway_merge", f"""WITH {STREAMS_SQL},
m AS (SELECT *, max(sec) OVER (PARTITION BY stream_idx ORDER BY arrival, event_id) AS merge_ts FROM s)
SELECT event_id, stream_idx, merge_ts,
       row_number() OVER (ORDER BY merge_ts, stream_idx, arrival, event_id) AS position FROM m""")
def kway_merge(spark, d):
    merged = ts.kway_merge(_streams(spark, d), "stream_idx", "sec", ["arrival", "event_id"])
    placed = ts.with_position(merged, ["merge_ts", "stream_idx", "arrival", "event_id"])
    return placed.select("event_id", "stream_idx", "merge_ts", "position").orderBy("position")
