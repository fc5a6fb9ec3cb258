"""Scans, sinks and payloads: tables are written to a fresh shared folder and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators.relational import union_sources
from millrace.plans.quality import CENTS, cents, obj, pick, quoted
from millrace.plans.registry import EVENTS_SQL, events, query
from millrace.session import scratch_dir
from millrace.sources import lines as ln, payloads as pay, tables as tab
from millrace.sources.tables import table


def _written_lines(spark, df, text, label):
    path = scratch_dir(spark, label)
    df.select(text.alias("value")).write.text(path)
    return ln.read_lines(spark, path)


@query("jsonl_scan_defensive", """
SELECT CASE WHEN event_id % 10 IN (1, 3) THEN -1 ELSE event_id END AS event_id,
       CASE WHEN event_id % 10 = 1 THEN '{"event_id": ' || event_id WHEN event_id % 10 = 3 THEN 'no json ' || event_id ELSE event_type END AS event_type,
       CASE WHEN event_id % 10 IN (1, 3) THEN 'dlq' ELSE 'ok' END AS output
FROM events WHERE event_id % 10 <> 2""")
def jsonl_scan_defensive(spark, d):
    good = obj(event_id=F.col("event_id").cast("string"), event_type=quoted(F.col("event_type")))
    text = pick("event_id", 10, {1: F.concat(F.lit('{"event_id": '), "event_id"), 2: F.lit("   "),
                                 3: F.concat(F.lit("no json "), "event_id")}, good)
    rows = _written_lines(spark, table(spark, d, "events"), text, "lines")
    ok, bad = ln.jsonl_scan_defensive(rows, "event_id bigint, event_type string")
    return ok.withColumn("output", F.lit("ok")).unionByName(bad.select(
        F.lit(-1).cast("long").alias("event_id"), F.col("value").alias("event_type"), F.lit("dlq").alias("output")))


@query("error_line_scan", """
SELECT CASE WHEN event_type = 'error' THEN '[ERROR] failed ' || event_id ELSE 'fine ' || event_id END AS log
FROM events WHERE event_type IN ('error', 'view')""")
def error_line_scan(spark, d):
    kind = F.col("event_type")
    text = (F.when(kind == "error", obj(log=quoted(F.concat(F.lit("[ERROR] failed "), "event_id"))))
            .when(kind == "view", obj(log=quoted(F.concat(F.lit("fine "), "event_id")), tag='"ERROR"'))
            .when(kind == "click", obj(note='"ERROR without log"'))
            .otherwise(obj(log=quoted(F.concat(F.lit("ok "), "event_id")))))
    rows = _written_lines(spark, table(spark, d, "events"), text, "log")
    return ln.error_line_scan(rows).select("log")


@query("prefiltered_parse_agg", f"""
SELECT CASE WHEN event_id % 50 = 7 THEN '(null)' ELSE 'u' || user_id END AS user_id, sum({CENTS})::DOUBLE AS total_amount
FROM events WHERE event_type <> 'error' AND event_id % 100 <> 0 AND event_id % 40 <> 3 GROUP BY 1""")
def prefiltered_parse_agg(spark, d):
    e = table(spark, d, "events")
    k, status = F.col("event_id"), F.when(F.col("event_type") == "error", '"failed"').otherwise('"success"')
    user = F.when(k % 50 == 7, "null").otherwise(quoted(F.concat(F.lit("u"), "user_id")))
    amount = F.when(k % 40 == 3, '"much"').otherwise(cents().cast("string"))
    text = F.when(k % 100 == 0, F.lit('{success broken')).otherwise(obj(user_id=user, amount=amount, status=status))
    out = ln.prefiltered_parse_agg(_written_lines(spark, e, text, "payments"))
    return out.select(F.coalesce("user_id", F.lit("(null)")).alias("user_id"), "total_amount")


@query("ndjson_typed_scan", f"""
SELECT event_id AS transaction_id, user_id, {CENTS} AS amount, sec, event_id % 2 = 0 AS even FROM {EVENTS_SQL}""")
def ndjson_typed_scan(spark, d):
    path = scratch_dir(spark, "ndjson")
    stamp = F.date_format(F.timestamp_seconds("sec"), "yyyy-MM-dd'T'HH:mm:ss")
    rows = events(spark, d).select(F.col("event_id").alias("transaction_id"), "user_id", cents().alias("amount"),
                                   stamp.alias("timestamp"), (F.col("event_id") % 2 == 0).alias("even"))
    rows.write.json(path)
    back = ln.ndjson_typed_scan(spark, path, {"transaction_id": "int", "user_id": "int", "amount": "int",
                                              "timestamp": "str", "even": "bool"})
    return back.select("transaction_id", "user_id", "amount", F.unix_seconds("timestamp").alias("sec"), "even")


@query("csv_scan", f"""
SELECT sec AS timestamp, 'u' || user_id AS user_id, coalesce(CASE WHEN event_id % 10 = 0 THEN NULL ELSE {CENTS} END, -1) AS amount, event_type AS status
FROM {EVENTS_SQL}""")
def csv_scan(spark, d):
    path = scratch_dir(spark, "csv")
    amount = F.when(F.col("event_id") % 10 != 0, cents())
    events(spark, d).select(F.col("sec").alias("timestamp"), F.concat(F.lit("u"), "user_id").alias("user_id"),
                            amount.alias("amount"), F.col("event_type").alias("status")).write.option(
        "header", True).csv(path)
    back = ln.csv_scan(spark, path, "timestamp bigint, user_id string, amount bigint, status string")
    return back.withColumn("amount", F.coalesce("amount", F.lit(-1)))


@query("parquet_sink", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'O'")
def parquet_sink(spark, d):
    rows = table(spark, d, "orders").where(F.col("o_orderstatus") == "O").select("o_orderkey", "o_custkey", "o_totalprice")
    return tab.parquet_sink(rows, scratch_dir(spark, "parquet"))


@query("jsonl_sink", """
SELECT o_orderkey, o_orderpriority FROM orders UNION ALL SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderkey % 2 = 0""")
def jsonl_sink(spark, d):
    path = scratch_dir(spark, "jsonl")
    rows = table(spark, d, "orders").select("o_orderkey", "o_orderpriority")
    ln.jsonl_sink(rows, path)
    ln.jsonl_sink(rows.where(F.col("o_orderkey") % 2 == 0), path)
    return spark.read.schema(rows.schema).json(path)


@query("rolled_file_sink", f"""
SELECT event_id, event_type, {CENTS} AS cents, true AS within_bound FROM events""")
def rolled_file_sink(spark, d):
    path = scratch_dir(spark, "rolled")
    rows = table(spark, d, "events").select("event_id", "event_type", cents().alias("cents"))
    ln.rolled_file_sink(rows, path)
    back = spark.read.schema(rows.schema).option("recursiveFileLookup", True).json(path)
    return back.select("*", (F.col("_metadata.file_size") <= ln.ROLL_BYTES).alias("within_bound"))


@query("partitioned_snapshot_write", f"""
SELECT CAST(event_id AS VARCHAR) AS external_id, {CENTS} AS score, event_type AS source, 'topic_' || user_id % 3 AS query,
       CASE WHEN event_id % 2 = 0 THEN '20260101_000000' ELSE '20260102_000000' END AS captured_at FROM events""")
def partitioned_snapshot_write(spark, d):
    path = scratch_dir(spark, "trends")
    rows = table(spark, d, "events").select(
        F.col("event_id").cast("string").alias("external_id"), cents().alias("score"), F.col("event_type").alias("source"),
        F.concat(F.lit("Topic "), F.col("user_id") % 3).alias("query"),
        F.when(F.col("event_id") % 2 == 0, "20260101_000000").otherwise("20260102_000000").alias("captured_at"))
    tab.partitioned_snapshot_write(rows, path)
    return spark.read.schema(rows.schema).parquet(path)


@query("warehouse_load", 'SELECT c_custkey AS "C_CUSTKEY", c_name AS "C_NAME", c_mktsegment AS "C_MKTSEGMENT" FROM customer')
def warehouse_load(spark, d):
    rows = table(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return tab.warehouse_load(rows, scratch_dir(spark, "warehouse"))


@query("page_payload_ingest", """
SELECT 'cur_' || c_custkey AS page, c_custkey AS id, c_name AS name, CAST(CASE WHEN c_custkey % 4 = 1 THEN -1 ELSE c_nationkey END AS BIGINT) AS score
FROM customer WHERE c_custkey % 9 <> 2
UNION ALL SELECT 'cur_' || c_custkey, c_custkey + 1000000000, c_mktsegment, 7 FROM customer WHERE c_custkey % 9 <> 2""")
def page_payload_ingest(spark, d):
    """One landed page per customer, each naming the next; every ninth carries no list."""
    c = table(spark, d, "customer")
    k = F.col("c_custkey")
    first = obj(id=k.cast("string"), name=quoted(F.col("c_name")), score=F.col("c_nationkey").cast("string"))
    bare = obj(id=k.cast("string"), name=quoted(F.col("c_name")))
    second = obj(id=(k + 1_000_000_000).cast("string"), name=quoted(F.col("c_mktsegment")), score="7")
    records = F.concat(F.lit("["), F.when(k % 4 == 1, bare).otherwise(first), F.lit(","), second, F.lit("]"))
    following = F.when(k == c.agg(F.max("c_custkey")).scalar(), "null").otherwise(quoted(F.concat(F.lit("cur_"), k + 1)))
    payload = obj(records=F.when(k % 9 == 2, '"none"').otherwise(records), next_cursor=following)
    pages = c.select(F.concat(F.lit("cur_"), k).alias("cursor"), payload.alias("payload"))
    out = pay.page_payload_ingest(pages, "cursor", "payload")
    return out.withColumn("score", F.coalesce("score", F.lit(-1)))


@query("meeting_explode", """
SELECT 'M' || doc_id AS issue_id, 'M' || doc_id || '-' || i AS speech_id, CAST(i AS BIGINT) AS speech_order, lang AS name_of_meeting,
       md5(lines[i]) AS speech_md5
FROM (SELECT doc_id, lang, lines, unnest(range(1, len(lines) + 1)) AS i
      FROM (SELECT doc_id, lang, string_split(text, chr(10)) AS lines FROM documents WHERE doc_id % 10 <> 0))""")
def meeting_explode(spark, d):
    """Every document as a meeting whose speeches are its lines; every tenth has none."""
    k, lines = F.col("doc_id"), F.split("text", "\n", -1)
    speeches = F.transform(lines, lambda s, i: F.struct(
        F.concat(F.lit("M"), k, F.lit("-"), i + 1).alias("speechID"), (i + 1).alias("speechOrder"),
        F.col("source").alias("speaker"), s.alias("speech")))
    meeting = F.struct(F.concat(F.lit("M"), k).alias("issueID"), F.lit(217).alias("session"),
                       F.col("lang").alias("nameOfMeeting"), F.lit("2026-03-12").alias("date"),
                       F.when(k % 10 == 0, F.slice(speeches, 1, 0)).otherwise(speeches).alias("speechRecord"))
    payloads = table(spark, d, "documents").select(F.to_json(meeting).alias("value"))
    return pay.meeting_explode(payloads).select(
        "issue_id", "speech_id", "speech_order", "name_of_meeting", F.md5("speech").alias("speech_md5"))


TRENDS_SQL = """
SELECT 'github' AS source, CAST(c_custkey AS VARCHAR) AS external_id, c_name AS name, 'https://g.example/' || c_custkey AS url,
       CAST(c_nationkey AS BIGINT) AS score, c_mktsegment AS description,
       md5('{"id":' || c_custkey || ',"name":"' || c_name || '","html_url":"https://g.example/' || c_custkey || '","stargazers_count":' || c_nationkey || ',"description":"' || c_mktsegment || '"}') AS raw_md5,
       '2026-01-01' AS captured_at FROM customer
UNION ALL
SELECT 'reddit', 's' || s_suppkey, s_name, 'https://r.example/' || s_suppkey, CAST(s_nationkey AS BIGINT), 'text',
       md5('{"id":"s' || s_suppkey || '","title":"' || s_name || '","url":"https://r.example/' || s_suppkey || '","ups":' || s_nationkey || ',"selftext":"text"}'),
       '2026-01-01' FROM supplier"""


@query("trend_normalise", TRENDS_SQL)
def trend_normalise(spark, d):
    c, s = F.col("c_custkey"), F.col("s_suppkey")
    github = table(spark, d, "customer").select(
        c.alias("id"), F.col("c_name").alias("name"), F.concat(F.lit("https://g.example/"), c).alias("html_url"),
        F.col("c_nationkey").alias("stargazers_count"), F.col("c_mktsegment").alias("description"))
    reddit = table(spark, d, "supplier").select(
        F.concat(F.lit("s"), s).alias("id"), F.col("s_name").alias("title"),
        F.concat(F.lit("https://r.example/"), s).alias("url"), F.col("s_nationkey").alias("ups"), F.lit("text").alias("selftext"))
    day = F.lit("2026-01-01")
    both = union_sources([pay.trend_normalise(github, "github", day), pay.trend_normalise(reddit, "reddit", day)])
    return both.withColumn("raw_md5", F.md5("raw_data")).drop("raw_data")


def _draw_sql(salt: int, n: int) -> str:
    return f"(CAST('0x' || md5(event_id || ':{salt}')[1:12] AS BIGINT) % {n})"


@query("synthetic_transactions", f"""
SELECT event_id AS transaction_id, {_draw_sql(1, 1_000_000)} + 1 AS user_id, {_draw_sql(2, 500)} + 1 AS product_id,
       {_draw_sql(3, 5000)} + 1 AS amount,
       strftime(TIMESTAMP '2026-01-01 00:00:00' + to_seconds({_draw_sql(5, 86400 * 180)}), '%Y-%m-%dT%H:%M:%S') AS timestamp,
       CASE WHEN {_draw_sql(4, 100)} < 80 THEN 'success' WHEN {_draw_sql(4, 100)} < 95 THEN 'failed' ELSE 'pending' END AS status
FROM events""")
def synthetic_transactions(spark, d):
    """One generated transaction for every event id."""
    return pay.synthetic_transactions(table(spark, d, "events").select("event_id"), "event_id")
