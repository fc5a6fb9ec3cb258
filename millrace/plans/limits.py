"""Rate limits over the events and build order over the parts."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators.graph import topo_levels
from millrace.operators.rate_limit import token_bucket, token_bucket_wait
from millrace.plans.registry import EVENTS_SQL, events, query
from millrace.sources.tables import table

# Two tokens at most, one token every eight hours.
CAPACITY, PERIOD = 2, 28800


@query("token_bucket", f"""
WITH RECURSIVE r AS (SELECT event_id, user_id, sec, row_number() OVER (PARTITION BY user_id ORDER BY sec, event_id) AS n FROM {EVENTS_SQL}),
walk AS (
  SELECT user_id, n, event_id, sec, {CAPACITY * PERIOD - PERIOD}::BIGINT AS credit, true AS allowed FROM r WHERE n = 1
  UNION ALL
  SELECT r.user_id, r.n, r.event_id, r.sec,
         least({CAPACITY * PERIOD}, w.credit + r.sec - w.sec) - CASE WHEN least({CAPACITY * PERIOD}, w.credit + r.sec - w.sec) >= {PERIOD} THEN {PERIOD} ELSE 0 END,
         least({CAPACITY * PERIOD}, w.credit + r.sec - w.sec) >= {PERIOD}
  FROM walk w JOIN r ON r.user_id = w.user_id AND r.n = w.n + 1)
SELECT event_id, user_id, sec, allowed FROM walk""")
def token_bucket_query(spark, d):
    rows = events(spark, d).select("event_id", "user_id", "sec")
    return token_bucket(rows, ["user_id"], "sec", "event_id", CAPACITY, 1, PERIOD)


@query("token_bucket_wait", f"""
WITH RECURSIVE r AS (SELECT event_id, user_id, sec, 1 + event_id % 3 AS amount,
                            row_number() OVER (PARTITION BY user_id ORDER BY sec, event_id) AS n FROM {EVENTS_SQL}),
walk AS (
  SELECT user_id, n, event_id, sec, sec AS start, (3 - amount) * {PERIOD}::BIGINT AS credit FROM r WHERE n = 1
  UNION ALL
  SELECT user_id, n, event_id, sec, now + greatest(0, amount * {PERIOD} - have), greatest(0, have - amount * {PERIOD})
  FROM (SELECT r.*, greatest(r.sec, w.start) AS now, least({3 * PERIOD}, w.credit + greatest(r.sec, w.start) - w.start) AS have
        FROM walk w JOIN r ON r.user_id = w.user_id AND r.n = w.n + 1))
SELECT event_id, user_id, sec, amount, start::DOUBLE AS start, (start - sec)::DOUBLE AS wait FROM walk JOIN (SELECT event_id, amount FROM r) USING (event_id)""")
def token_bucket_wait_query(spark, d):
    rows = events(spark, d).select("event_id", "user_id", "sec", (1 + F.col("event_id") % 3).alias("amount"))
    return token_bucket_wait(rows, ["user_id"], "sec", "event_id", "amount", 3, 1, PERIOD)


@query("topo_levels", """
SELECT p_partkey AS node, CASE WHEN p_partkey = 0 THEN 0 ELSE length(bin(p_partkey)) END::INTEGER AS level FROM part
UNION ALL SELECT p_partkey + 1000000000, 0::INTEGER FROM part WHERE p_size = 1""")
def topo_levels_query(spark, d):
    """Every part needs the parts at a half and a third of its number; some parts stand alone."""
    part = table(spark, d, "part")
    k = F.col("p_partkey")
    edges = part.where(k > 0).select(k.alias("node"), F.explode(F.array(
        F.expr("p_partkey div 2"), F.expr("p_partkey div 3"))).alias("parent"))
    alone = part.where(F.col("p_size") == 1).select((k + 1_000_000_000).alias("node"))
    return topo_levels(edges, alone)
