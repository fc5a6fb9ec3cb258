"""Joins, totals, pivots and ranks over the order tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import model_outputs as mo, relational as rel
from millrace.plans.registry import EVENTS_SQL, events, query
from millrace.sources.tables import TASK_BYTES, spread, table

# Customers know their nation, except every seventh; every tenth has a second, later row elsewhere.
USERS_SQL = """
users AS (
  SELECT c_custkey, n_name AS country, 0 AS arrival FROM customer JOIN nation ON n_nationkey = c_nationkey
  WHERE c_custkey % 7 <> 0
  UNION ALL
  SELECT c_custkey, n_name, 1 FROM customer JOIN nation ON n_nationkey = (c_nationkey + 1) % 25
  WHERE c_custkey % 10 = 0),
known AS (SELECT c_custkey, arg_max(country, arrival) AS country FROM users GROUP BY c_custkey)
"""


def _users(spark, d):
    customer, nation = table(spark, d, "customer"), rel.checked_broadcast(
        table(spark, d, "nation").select("n_nationkey", F.col("n_name").alias("country")))
    first = customer.where(F.col("c_custkey") % 7 != 0).select("c_custkey", F.col("c_nationkey").alias("n_nationkey"), F.lit(0).alias("arrival"))
    second = customer.where(F.col("c_custkey") % 10 == 0).select(
        "c_custkey", ((F.col("c_nationkey") + 1) % 25).alias("n_nationkey"), F.lit(1).alias("arrival"))
    return first.unionByName(second).join(nation, "n_nationkey").select("c_custkey", "country", "arrival")


def _purchases(spark, d):
    return table(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"), "o_totalprice")


@query("left_join_unknown", f"""WITH {USERS_SQL}
SELECT o_orderkey, o_custkey AS c_custkey, o_totalprice, coalesce(country, 'Unknown') AS country
FROM orders LEFT JOIN known ON c_custkey = o_custkey""")
def left_join_unknown(spark, d):
    return rel.left_join_unknown(_purchases(spark, d), _users(spark, d), "c_custkey", "country", "arrival")


@query("sum_by_country", f"""WITH {USERS_SQL}
SELECT coalesce(country, 'Unknown') AS country, round(sum(o_totalprice), 2) AS total_amount
FROM orders LEFT JOIN known ON c_custkey = o_custkey GROUP BY 1""")
def sum_by_country(spark, d):
    out = rel.sum_by_country(_purchases(spark, d), _users(spark, d), "c_custkey", "o_totalprice", "country", "arrival")
    return out.withColumn("total_amount", F.round("total_amount", 2))


# Stores are the nations, except every fifth; their region stays null for those.
SALES_SQL = """
stores AS (SELECT n_nationkey, r_name AS region FROM nation JOIN region ON r_regionkey = n_regionkey WHERE n_nationkey % 5 <> 0),
sales AS (SELECT region, c_mktsegment, c_acctbal FROM customer LEFT JOIN stores ON n_nationkey = c_nationkey)
"""
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def _sales(spark, d):
    stores = table(spark, d, "nation").where(F.col("n_nationkey") % 5 != 0).join(
        table(spark, d, "region"), F.col("r_regionkey") == F.col("n_regionkey")).select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("r_name").alias("region"))
    return rel.small_side_left_join(table(spark, d, "customer"), stores, "c_nationkey")


@query("broadcast_left_join", f"""WITH {SALES_SQL}
SELECT region, count(*) AS sales, round(sum(c_acctbal), 2) AS balance FROM sales GROUP BY region""")
def broadcast_left_join(spark, d):
    return _sales(spark, d).groupBy("region").agg(
        F.count(F.lit(1)).alias("sales"), F.round(F.sum("c_acctbal"), 2).alias("balance"))


@query("pivot_sum", f"WITH {SALES_SQL} SELECT region, " + ", ".join(
    f"round(coalesce(sum(c_acctbal) FILTER (c_mktsegment = '{s}'), 0), 2) AS \"{s}\"" for s in SEGMENTS)
    + " FROM sales GROUP BY region")
def pivot_sum(spark, d):
    out = rel.pivot_sum(_sales(spark, d), "region", "c_mktsegment", SEGMENTS, "c_acctbal")
    return out.select("region", *[F.round(s, 2).alias(s) for s in SEGMENTS])


@query("product_summary", """
SELECT l_partkey, round(sum(l_extendedprice), 2) AS total_amount, count(l_orderkey) AS transaction_count,
       round(avg(l_extendedprice), 8) AS average_amount FROM lineitem GROUP BY l_partkey""")
def product_summary(spark, d):
    out = rel.product_summary(table(spark, d, "lineitem"), "l_partkey", "l_extendedprice", "l_orderkey")
    return out.select("l_partkey", F.round("total_amount", 2).alias("total_amount"), "transaction_count",
                      F.round("average_amount", 8).alias("average_amount"))


@query("partial_final_agg", """
SELECT l_suppkey, CAST(sum(l_quantity) AS BIGINT) AS total_quantity FROM lineitem
WHERE l_returnflag <> 'R' GROUP BY l_suppkey""")
def partial_final_agg(spark, d):
    return table(spark, d, "lineitem").where(F.col("l_returnflag") != "R").groupBy("l_suppkey").agg(
        F.sum("l_quantity").cast("long").alias("total_quantity"))


# Every fourth order is delivered twice, the second time a day later.
TWICE_SQL = """
twice AS (
  SELECT o_orderkey, o_orderpriority, o_totalprice, epoch(o_orderdate)::BIGINT AS ordered_at FROM orders
  UNION ALL
  SELECT o_orderkey, o_orderpriority, o_totalprice, epoch(o_orderdate)::BIGINT + 86400 FROM orders WHERE o_orderkey % 4 = 0),
once AS (SELECT o_orderkey, o_orderpriority, o_totalprice, ordered_at
         FROM (SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY ordered_at) AS rn FROM twice) WHERE rn = 1)
"""


def _twice(spark, d):
    o = table(spark, d, "orders").select(
        "o_orderkey", "o_orderpriority", "o_totalprice",
        F.unix_seconds(F.col("o_orderdate").cast("timestamp")).alias("ordered_at"))
    again = o.where(F.col("o_orderkey") % 4 == 0).withColumn("ordered_at", F.col("ordered_at") + 86400)
    return rel.union_sources([o, again])


@query("source_union", f"WITH {TWICE_SQL} SELECT * FROM twice")
def source_union(spark, d):
    return _twice(spark, d)


@query("dedup_first", f"WITH {TWICE_SQL} SELECT * FROM once")
def dedup_first(spark, d):
    return rel.dedup_first(_twice(spark, d), ["o_orderkey"], ["ordered_at"])


@query("dedup_first_sql", f"WITH {TWICE_SQL} SELECT * FROM once")
def dedup_first_sql(spark, d):
    return rel.dedup_first_sql(_twice(spark, d), ["o_orderkey"], ["ordered_at"])


@query("top_n_dense", f"""WITH {TWICE_SQL}
SELECT o_orderkey, o_orderpriority, amount, dense_rank FROM (
  SELECT *, dense_rank() OVER (PARTITION BY o_orderpriority ORDER BY amount DESC) AS dense_rank
  FROM (SELECT o_orderkey, o_orderpriority, CAST(floor(o_totalprice / 1000) AS BIGINT) AS amount FROM once)) WHERE dense_rank <= 3""")
def top_n_dense(spark, d):
    once = rel.dedup_first(_twice(spark, d), ["o_orderkey"], ["ordered_at"])
    thousands = once.select("o_orderkey", "o_orderpriority", F.floor(F.col("o_totalprice") / 1000).alias("amount"))
    out = rel.top_n_dense(thousands, "o_orderpriority", "amount", 3)
    return out.withColumn("dense_rank", F.col("dense_rank").cast("long")).orderBy("o_orderpriority", "dense_rank")


@query("rank_variants", """
SELECT o_orderkey, o_orderpriority, amount,
       row_number() OVER (PARTITION BY o_orderpriority ORDER BY amount DESC, o_orderkey) AS row_number,
       rank() OVER (PARTITION BY o_orderpriority ORDER BY amount DESC) AS rank,
       dense_rank() OVER (PARTITION BY o_orderpriority ORDER BY amount DESC) AS dense_rank
FROM (SELECT o_orderkey, o_orderpriority, CAST(floor(o_totalprice / 1000) AS BIGINT) AS amount FROM orders)""")
def rank_variants(spark, d):
    thousands = table(spark, d, "orders").select(
        "o_orderkey", "o_orderpriority", F.floor(F.col("o_totalprice") / 1000).alias("amount"))
    return rel.rank_variants(thousands, ["o_orderpriority"], "amount", "o_orderkey")


@query("sort_limit", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100")
def sort_limit(spark, d):
    return table(spark, d, "orders").select("o_orderkey", "o_totalprice").orderBy(
        F.col("o_totalprice").desc(), "o_orderkey").limit(100)


@query("semi_anti_join", """
SELECT c_custkey, 'buyer' AS kind FROM customer SEMI JOIN (SELECT o_custkey AS c_custkey FROM orders WHERE o_totalprice > 400000) USING (c_custkey)
UNION ALL
SELECT c_custkey, 'other' FROM customer ANTI JOIN (SELECT o_custkey AS c_custkey FROM orders WHERE o_totalprice > 400000) USING (c_custkey)""")
def semi_anti_join(spark, d):
    c = table(spark, d, "customer").select("c_custkey")
    o = table(spark, d, "orders").where(F.col("o_totalprice") > 400000).select(F.col("o_custkey").alias("c_custkey")).distinct()
    return rel.union_sources([
        c.join(o, "c_custkey", "left_semi").withColumn("kind", F.lit("buyer")),
        c.join(o, "c_custkey", "left_anti").withColumn("kind", F.lit("other"))])


# One nested order per line item: the item itself and a handling item. Every third supplier's orders
# are VIP, half of those in lower case; prices are text.
ORDER_TOTALS_SQL = """
SELECT round(sum((l_extendedprice * l_quantity + l_linenumber * 2.5::DOUBLE)
                 * CASE WHEN l_suppkey % 3 = 0 THEN 0.9::DOUBLE ELSE 1 END), 0) AS total_revenue,
       count(*) AS processed_count
FROM lineitem"""


@query("order_totals", ORDER_TOTALS_SQL)
def order_totals(spark, d):
    level = F.when(F.col("l_suppkey") % 6 == 0, "VIP").when(F.col("l_suppkey") % 3 == 0, "vip").otherwise("Regular")
    item = F.struct(F.col("l_extendedprice").cast("string").alias("price"),
                    F.col("l_quantity").cast("string").alias("quantity"))
    handling = F.struct(F.lit("2.5").alias("price"), F.col("l_linenumber").cast("string").alias("quantity"))
    orders = spread(table(spark, d, "lineitem"), TASK_BYTES).select(
        F.struct(level.alias("membership")).alias("customer"), F.array(item, handling).alias("items"))
    return rel.order_totals(orders).withColumn("total_revenue", F.round("total_revenue", 0))


# Three agents answer one question per customer about the nation key; one of them is off for some.
VOTES_SQL = """
answers AS (
  SELECT c_custkey, a AS agent,
         CASE WHEN c_custkey % 11 = 0 THEN NULL
              WHEN a = 0 THEN CAST(c_nationkey AS VARCHAR)
              WHEN a = 1 THEN CAST(c_nationkey + (c_custkey % 2) AS VARCHAR)
              ELSE CAST(c_nationkey - (c_custkey % 3) AS VARCHAR) END AS answer,
         CAST(c_nationkey AS VARCHAR) AS truth
  FROM customer, range(3) t(a)),
votes AS (SELECT c_custkey, answer, count(*) AS votes, min(agent) AS f FROM answers WHERE answer IS NOT NULL GROUP BY 1, 2),
won AS (SELECT c_custkey, answer, votes FROM votes QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY votes DESC, f) = 1),
final AS (SELECT DISTINCT a.c_custkey, coalesce(w.answer, '0') AS answer, coalesce(votes, 0) AS votes
          FROM answers a LEFT JOIN won w ON w.c_custkey = a.c_custkey)
"""


def _answers(spark, d):
    k, n = F.col("c_custkey"), F.col("c_nationkey")
    said = (F.when(k % 11 == 0, "I cannot tell.")
            .when(F.col("agent") == 0, F.concat(F.lit("Step 12 done. 最終解答: "), n))
            .when(F.col("agent") == 1, F.concat(F.lit("so the Answer is "), n + k % 2, F.lit(" of 99 cases.")))
            .otherwise(F.concat(F.lit("first 7, then\n"), n - k % 3, F.lit("  "))))
    return table(spark, d, "customer").withColumn("agent", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2)))).select(
        "c_custkey", "agent", mo.final_number(said).alias("answer"), n.cast("string").alias("truth"))


@query("majority_vote", f"WITH {VOTES_SQL} SELECT c_custkey, answer, votes FROM final")
def majority_vote(spark, d):
    return rel.majority_vote(_answers(spark, d), "c_custkey", "agent", "answer")


@query("accuracy_report", f"""WITH {VOTES_SQL}, solo AS (
  SELECT 'solo' AS config, answer, truth FROM answers WHERE agent = 2
  UNION ALL SELECT 'vote', f.answer, a.truth FROM final f JOIN answers a ON a.c_custkey = f.c_custkey AND a.agent = 0)
SELECT config, count(*) AS answered, CAST(sum(CASE WHEN answer = truth THEN 1 ELSE 0 END) AS BIGINT) AS correct,
       round(avg(CASE WHEN answer = truth THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 9) AS accuracy FROM solo GROUP BY config""")
def accuracy_report(spark, d):
    said = _answers(spark, d)
    solo = said.where(F.col("agent") == 2).select(F.lit("solo").alias("config"), "answer", "truth")
    truth = said.where(F.col("agent") == 0).select("c_custkey", "truth")
    voted = rel.majority_vote(said, "c_custkey", "agent", "answer").join(truth, "c_custkey").select(
        F.lit("vote").alias("config"), "answer", "truth")
    return rel.accuracy_report(rel.union_sources([solo, voted]), "config", "answer", "truth").withColumn(
        "accuracy", F.round("accuracy", 9))


@query("cost_rollup", f"""
SELECT CASE WHEN event_type = 'error' THEN 'expensive' ELSE 'cheap' END AS tier,
       CAST(sum(100 + event_id % 50) AS BIGINT) AS input_tokens, CAST(sum(40 + event_id % 20) AS BIGINT) AS output_tokens,
       round(CASE WHEN tier = 'cheap' THEN input_tokens * 0.00015::DOUBLE / 1000 + output_tokens * 0.0006::DOUBLE / 1000
                  ELSE input_tokens * 0.003::DOUBLE / 1000 + output_tokens * 0.015::DOUBLE / 1000 END, 6) AS cost
FROM {EVENTS_SQL} GROUP BY 1""")
def cost_rollup(spark, d):
    calls = events(spark, d).select(
        F.when(F.col("event_type") == "error", "expensive").otherwise("cheap").alias("tier"),
        (100 + F.col("event_id") % 50).alias("t_in"), (40 + F.col("event_id") % 20).alias("t_out"))
    return mo.cost_rollup(calls, "tier", "t_in", "t_out").withColumn("cost", F.round("cost", 6))
