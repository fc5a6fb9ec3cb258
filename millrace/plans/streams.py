"""Streams over the events, arriving in three slices with a restart from the checkpoint before each."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators.quality import transaction_contract
from millrace.operators.relational import union_sources, union_streams
from millrace.plans.quality import TX_SQL, _answers, obj, pick, quoted
from millrace.plans.registry import DELAY_SQL, EVENTS_SQL, delayed, events, query
from millrace.session import scratch_dir
from millrace.sources.tables import table
from millrace.streaming import keyed, sinks, stateful, windows as win

# Fixed arrival bounds of the slices: 2024-01-11 and 2024-01-21, in microseconds.
BOUNDS = (1704931200000000, 1705795200000000)
ARRIVING = "event_id bigint, user_id bigint, event_type string, us bigint, sec bigint, arrival bigint"
SLICED_SQL = f"""
a AS (SELECT event_id, user_id, event_type, us, sec, {DELAY_SQL} AS arrival FROM {EVENTS_SQL}),
sliced AS (SELECT *, CASE WHEN arrival < {BOUNDS[0]} THEN 0 WHEN arrival < {BOUNDS[1]} THEN 1 ELSE 2 END AS slice FROM a)
"""


def slices(rows, by="arrival"):
    at = F.col(by)
    return [rows.where(at < BOUNDS[0]), rows.where((at >= BOUNDS[0]) & (at < BOUNDS[1])), rows.where(at >= BOUNDS[1])]


def _arriving(spark, d):
    return delayed(events(spark, d)).select("event_id", "user_id", "event_type", "us", "sec", "arrival")


def _timed(spark, folder):
    stream = win.json_stream(spark, folder, ARRIVING)
    return stream.select(F.timestamp_micros("us").alias("event_time"), F.col("event_type").alias("page"))


def _micros(df):
    return df.select(F.unix_micros("window_start").alias("start_us"), F.unix_micros("window_end").alias("end_us"),
                     "page", "count")


def _windows_sql(size: int, slide: int) -> str:
    """Windows of the rows that are not late: a slice is judged by the newest time of the slices before."""
    return f"""{SLICED_SQL},
    tops AS (SELECT slice, max(us) AS top FROM sliced GROUP BY slice),
    marks AS (SELECT s.slice, (SELECT max(top) FROM tops t WHERE t.slice < s.slice) // 1000 * 1000 - 600000000 AS wm FROM tops s),
    final AS (SELECT max(top) // 1000 * 1000 - 600000000 AS wm FROM tops),
    spread AS (SELECT event_type AS page, slice, us // {slide} * {slide} - k * {slide} AS start_us FROM sliced, range({size // slide}) t(k)),
    kept AS (SELECT page, start_us, start_us + {size} AS end_us FROM spread JOIN marks USING (slice)
             WHERE wm IS NULL OR start_us + {size} > wm),
    counted AS (SELECT start_us, end_us, page, count(*) AS count FROM kept GROUP BY ALL),
    closed AS (SELECT counted.* FROM counted, final WHERE end_us <= wm)
    """


MINUTE = 60_000_000


def _run_windows(spark, d, mode="append", size="5 minutes", slide=None):
    folder, out = scratch_dir(spark, "stream-in"), scratch_dir(spark, "stream-out")
    start = lambda: win.run_available(
        win.tumbling_count(_timed(spark, folder), "event_time", "page", size, win.DELAY, slide), out, mode)
    win.feed(slices(_arriving(spark, d)), folder, start)
    return spark.read.parquet(f"{out}/out")


@query("stream_source", f"WITH {SLICED_SQL} SELECT event_id, user_id, event_type, us FROM sliced")
def stream_source(spark, d):
    folder, out = scratch_dir(spark, "stream-in"), scratch_dir(spark, "stream-out")
    win.feed(slices(_arriving(spark, d)), folder,
             lambda: win.run_available(win.json_stream(spark, folder, ARRIVING), out))
    return spark.read.parquet(f"{out}/out").select("event_id", "user_id", "event_type", "us")


@query("watermark_tumbling_count", f"WITH {_windows_sql(5 * MINUTE, 5 * MINUTE)} SELECT start_us, end_us, page, count FROM closed")
def watermark_tumbling_count(spark, d):
    return _micros(_run_windows(spark, d))


@query("watermark_dropped_rows", f"""WITH {_windows_sql(5 * MINUTE, 5 * MINUTE)},
late AS (SELECT slice, count(DISTINCT (page, start_us)) AS dropped FROM spread JOIN marks USING (slice)
         WHERE start_us + {5 * MINUTE} <= wm GROUP BY slice),
seen AS (SELECT slice, count(*) AS rows, max(us) AS newest_us FROM sliced GROUP BY slice)
SELECT slice AS run, rows, newest_us,
       max(newest_us) OVER (ORDER BY slice) // 1000 * 1000 - 600000000 AS watermark_us, coalesce(dropped, 0) AS dropped
FROM seen LEFT JOIN late USING (slice)""")
def watermark_dropped_rows(spark, d):
    """What the stream of ``watermark_tumbling_count`` read and dropped in each of its runs."""
    folder, out = scratch_dir(spark, "stream-in"), scratch_dir(spark, "stream-out")
    with win.WatermarkLog(spark) as log:
        win.feed(slices(_arriving(spark, d)), folder, lambda: log.finished(win.run_available(win.tumbling_count(
            win.observe_arrivals(_timed(spark, folder), "event_time"), "event_time", "page"), out)))
    return log.frame()


@query("sliding_window_stream", f"WITH {_windows_sql(30 * MINUTE, 10 * MINUTE)} SELECT start_us, end_us, page, count FROM closed")
def sliding_window_stream(spark, d):
    return _micros(_run_windows(spark, d, size="30 minutes", slide="10 minutes"))


@query("output_modes", f"""WITH {_windows_sql(5 * MINUTE, 5 * MINUTE)}
SELECT 'append' AS mode, start_us, end_us, page, count FROM closed
UNION ALL SELECT 'update', * FROM counted
UNION ALL SELECT 'complete', event_us, event_us + {5 * MINUTE}, page, count(*) FROM (
  SELECT us // {5 * MINUTE} * {5 * MINUTE} AS event_us, event_type AS page FROM sliced) GROUP BY event_us, page""")
def output_modes(spark, d):
    append = _run_windows(spark, d)
    update = win.newest_rows(_run_windows(spark, d, "update"), ["window_start", "window_end", "page"])
    complete = win.newest_batch(_run_windows(spark, d, "complete"))
    return union_sources([_micros(f).select(F.lit(m).alias("mode"), "*") for m, f in
                          (("append", append), ("update", update), ("complete", complete))])


@query("window_count_by_page", f"""
SELECT us // {5 * MINUTE} * {5 * MINUTE} AS start_us, event_type AS page, count(*) AS count FROM {EVENTS_SQL} GROUP BY 1, 2""")
def window_count_by_page(spark, d):
    """The batch twin of the stream: nothing is late."""
    rows = events(spark, d).select(F.timestamp_micros("us").alias("event_time"), F.col("event_type").alias("page"))
    return _micros(win.tumbling_count(rows, "event_time", "page", delay=None)).drop("end_us")


@query("stream_sessionize", f"""WITH a AS (SELECT user_id, sec, event_id, {DELAY_SQL} AS arrival FROM {EVENTS_SQL}),
p AS (SELECT *, max(sec) OVER (PARTITION BY user_id ORDER BY arrival, event_id
                               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pm FROM a),
n AS (SELECT *, sum(CASE WHEN pm IS NULL OR sec - pm >= 21600 THEN 1 ELSE 0 END)
                OVER (PARTITION BY user_id ORDER BY arrival, event_id) AS session_no FROM p)
SELECT user_id, first(sec ORDER BY arrival, event_id) AS session_start, max(sec) AS session_end, count(*) AS event_count
FROM n GROUP BY user_id, session_no""")
def stream_sessionize(spark, d):
    """Closed sessions of every batch, and the open ones as the flush at the end."""
    folder, out = scratch_dir(spark, "stream-in"), scratch_dir(spark, "stream-out")
    win.feed(slices(_arriving(spark, d)), folder, lambda: keyed.run_sessions(
        win.json_stream(spark, folder, ARRIVING), "user_id", "sec", ["arrival", "event_id"], 21600, out))
    return spark.read.parquet(f"{out}/out").unionByName(keyed.open_sessions(spark, out, "user_id"))


@query("stream_merge_late", f"""WITH {SLICED_SQL},
s AS (SELECT event_id, sec, arrival, CASE event_type WHEN 'click' THEN 0 WHEN 'view' THEN 1 ELSE 2 END AS stream_idx
      FROM sliced WHERE event_type IN ('click', 'view', 'error'))
SELECT event_id, stream_idx, sec,
       sec < coalesce(max(sec) OVER (ORDER BY arrival, stream_idx, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -1) AS is_late
FROM s""")
def stream_merge_late(spark, d):
    """Three streams merged in arrival order; late rows stay and are flagged."""
    folder, out = scratch_dir(spark, "stream-in"), scratch_dir(spark, "stream-out")
    step = stateful.late_step("merged", "sec", ["arrival", "stream_idx", "event_id"])

    def run():
        s = win.json_stream(spark, folder, ARRIVING)
        merged = union_streams([s.where(F.col("event_type") == k) for k in ("click", "view", "error")])
        rows = merged.select("event_id", "stream_idx", "sec", "arrival", F.lit(1).alias("merged"))
        stateful.run_stateful(rows, step, out)

    win.feed(slices(_arriving(spark, d)), folder, run)
    return spark.read.parquet(f"{out}/out").select("event_id", "stream_idx", "sec", "is_late")


@query("stream_error_alert", f"""WITH e AS (SELECT event_id, user_id, sec FROM {EVENTS_SQL} WHERE event_type = 'error'),
c AS (SELECT *, count(*) OVER (PARTITION BY user_id ORDER BY sec RANGE BETWEEN 86400 PRECEDING AND CURRENT ROW)
             - count(*) OVER (PARTITION BY user_id, sec) + row_number() OVER (PARTITION BY user_id, sec ORDER BY event_id) AS window_count FROM e)
SELECT event_id, user_id, sec, CAST(window_count AS BIGINT) AS window_count FROM c WHERE window_count >= 3""")
def stream_error_alert(spark, d):
    folder, out = scratch_dir(spark, "stream-in"), scratch_dir(spark, "stream-out")
    win.feed(slices(_arriving(spark, d), by="us"), folder, lambda: keyed.run_alerts(
        win.json_stream(spark, folder, ARRIVING).where(F.col("event_type") == "error"), "user_id", "sec", "event_id", 86400, out))
    return spark.read.parquet(f"{out}/out")


@query("micro_batch_sink", f"""WITH {TX_SQL},
lines AS (SELECT *, CASE WHEN m IN (3, 7) THEN 'json' WHEN m = 5 OR (m <> 4 AND c = 0) THEN 'amount' ELSE '' END AS failed
          FROM verdict)
SELECT CASE WHEN failed = '' THEN 'ok' ELSE 'dlq' END AS output,
       CASE WHEN failed = 'json' THEN '' ELSE 'tx_' || event_id END AS transaction_id, failed AS failed_fields
FROM lines""")
def micro_batch_sink(spark, d):
    folder, out = scratch_dir(spark, "stream-in"), scratch_dir(spark, "stream-out")
    _answers(spark, d).select(F.col("answer").alias("value")).write.text(folder)
    sinks.micro_batch_sink(sinks.text_stream(spark, folder), out, batch_rows=5000)
    return union_sources([
        spark.read.parquet(f"{out}/{name}").select(
            F.lit(name).alias("output"), F.coalesce("transaction_id", F.lit("")).alias("transaction_id"),
            F.array_join("violations", ",").alias("failed_fields")) for name in ("ok", "dlq")])


@query("stream_dlq", """
SELECT CASE WHEN o_orderkey % 6 IN (1, 2, 3) THEN 'dlq' ELSE 'ok' END AS output, count(*) AS rows,
       CAST(sum(CASE WHEN o_orderkey % 6 IN (1, 2, 3) THEN 0 ELSE floor(o_totalprice) END) AS BIGINT) AS amount FROM orders GROUP BY 1""")
def stream_dlq(spark, d):
    """Order lines in two deliveries with a restart between; valid and invalid rows side by side."""
    folder, out = scratch_dir(spark, "stream-in"), scratch_dir(spark, "stream-out")
    k = F.col("o_orderkey")
    user, whole = quoted(F.concat(F.lit("u"), "o_custkey")), F.floor("o_totalprice").cast("string")
    text = pick(k, 6, {1: obj(user_id=user, amount=quoted(whole)), 2: obj(user_id=user),
                       3: F.lit('{"user_id": "u1", "amount"')}, obj(user_id=user, amount=whole))
    orders = table(spark, d, "orders").select(k, text.alias("value"))
    for half in (orders.where(k % 2 == 0), orders.where(k % 2 == 1)):
        half.select("value").write.mode("append").text(folder)
        sinks.split_sink(sinks.text_stream(spark, folder), transaction_contract, out)
    return union_sources([
        spark.read.parquet(f"{out}/{name}").groupBy(F.lit(name).alias("output")).agg(
            F.count(F.lit(1)).alias("rows"), F.sum(F.coalesce("amount", F.lit(0))).alias("amount"))
        for name in ("ok", "dlq")])
