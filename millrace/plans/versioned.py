"""History tables, upserts and snapshots over ``customer`` and a derived change batch."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import versioned as ver
from millrace.operators.relational import union_sources
from millrace.plans.registry import query
from millrace.session import scratch_dir
from millrace.sources.buckets import BucketedTable, create_history, scd2_stored, upsert_stored
from millrace.sources.tables import SnapshotTable, partitioned_snapshot_write, table

# The batch renames a third of the segments, moves others, leaves some null, and adds new keys.
BATCH_SQL = """
history AS (SELECT c_custkey, c_name, c_mktsegment, true AS is_current, '2024-01-01' AS valid_from, '9999-12-31' AS valid_to FROM customer),
batch AS (
  SELECT c_custkey, c_name || ' jr' AS c_name,
         CASE WHEN c_custkey % 20 = 0 THEN NULL WHEN c_custkey % 10 = 0 THEN 'MOVED' ELSE c_mktsegment END AS c_mktsegment
  FROM customer WHERE c_custkey % 5 = 0
  UNION ALL SELECT c_custkey + 1000000000, c_name, c_mktsegment FROM customer WHERE c_custkey % 50 = 0),
changed AS (SELECT h.c_custkey FROM history h JOIN batch b USING (c_custkey) WHERE h.c_mktsegment <> b.c_mktsegment),
merged AS (
  SELECT c_custkey, c_name, c_mktsegment, c_custkey NOT IN (SELECT c_custkey FROM changed) AS is_current, valid_from,
         CASE WHEN c_custkey IN (SELECT c_custkey FROM changed) THEN '2024-02-01' ELSE valid_to END AS valid_to FROM history
  UNION ALL
  SELECT c_custkey, c_name, c_mktsegment, true, '2024-02-01', '9999-12-31' FROM batch
  WHERE c_custkey IN (SELECT c_custkey FROM changed) OR c_custkey NOT IN (SELECT c_custkey FROM history))
"""


def _history(spark, d):
    return table(spark, d, "customer").select(
        "c_custkey", "c_name", "c_mktsegment", F.lit(True).alias("is_current"), F.lit("2024-01-01").alias("valid_from"),
        F.lit(ver.OPEN_END).alias("valid_to"))


def _batch(spark, d):
    c = table(spark, d, "customer")
    k = F.col("c_custkey")
    segment = F.when(k % 20 == 0, None).when(k % 10 == 0, "MOVED").otherwise(F.col("c_mktsegment"))
    old = c.where(k % 5 == 0).select(k, F.concat("c_name", F.lit(" jr")).alias("c_name"), segment.alias("c_mktsegment"))
    new = c.where(k % 50 == 0).select((k + 1_000_000_000).alias("c_custkey"), "c_name", "c_mktsegment")
    return old.unionByName(new)


def _merge(spark, d, history):
    return ver.scd2_merge(history, _batch(spark, d), "c_custkey", "c_mktsegment", ["c_name", "c_mktsegment"], "2024-02-01")


@query("scd2_merge", f"WITH {BATCH_SQL} SELECT * FROM merged")
def scd2_merge(spark, d):
    return _merge(spark, d, _history(spark, d))


@query("snapshot_read", f"""WITH {BATCH_SQL}
SELECT version, operation, num_rows, count(*) AS current_rows FROM (
  SELECT 0 AS v, is_current FROM history UNION ALL SELECT 1, is_current FROM merged UNION ALL SELECT 2, is_current FROM merged) s
JOIN (SELECT 0::BIGINT AS version, 'WRITE' AS operation, (SELECT count(*) FROM history) AS num_rows
      UNION ALL SELECT 1, 'MERGE', (SELECT count(*) FROM merged)
      UNION ALL SELECT 2, 'MERGE', (SELECT count(*) FROM merged)) m ON m.version = s.v
WHERE is_current GROUP BY ALL""")
def snapshot_read(spark, d):
    """Write, merge, merge again (a no-op on the rows); read every version back beside the history."""
    t = SnapshotTable(spark, scratch_dir(spark, "customers"))
    t.commit(_history(spark, d), "WRITE")
    t.commit(_merge(spark, d, t.read()), "MERGE")
    t.commit(_merge(spark, d, t.read()), "MERGE")
    counts = [t.read(v).where("is_current").agg(F.count(F.lit(1)).alias("current_rows")).withColumn(
        "version", F.lit(v).cast("long")) for v in range(3)]
    return t.history().join(counts[0].union(counts[1]).union(counts[2]), "version").drop("folder")


@query("upsert_by_key", f"""WITH {BATCH_SQL}
SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM batch)
UNION ALL SELECT * FROM batch""")
def upsert_by_key(spark, d):
    target = table(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return ver.upsert_by_key(target, _batch(spark, d), ["c_custkey"])


@query("stored_upsert", f"""WITH {BATCH_SQL}
SELECT 0::BIGINT AS version, c_custkey, c_name, c_mktsegment FROM customer
UNION ALL SELECT 1, c_custkey, c_name, c_mktsegment FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM batch)
UNION ALL SELECT 1, * FROM batch""")
def stored_upsert(spark, d):
    """The batch goes into a stored table, bucket by bucket; both versions stay readable."""
    t = BucketedTable(spark, scratch_dir(spark, "buckets"), ["c_custkey"], buckets=8)
    t.commit(table(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment"), "WRITE")
    upsert_stored(t, _batch(spark, d))
    return union_sources([t.read(v).select(F.lit(v).cast("long").alias("version"), "*") for v in (0, 1)])


@query("stored_scd2_merge", f"WITH {BATCH_SQL} SELECT * FROM merged")
def stored_scd2_merge(spark, d):
    """The merge into a stored history, twice: the second run changes nothing."""
    t = BucketedTable(spark, scratch_dir(spark, "history"), ["c_custkey"], buckets=8)
    create_history(t, _history(spark, d))
    for _ in range(2):
        scd2_stored(t, _batch(spark, d), "c_mktsegment", ["c_name", "c_mktsegment"], "2024-02-01")
    return t.read()


@query("upsert_split", f"""WITH {BATCH_SQL}
SELECT b.c_custkey, b.c_name, b.c_mktsegment,
       CASE WHEN b.c_custkey IN (SELECT c_custkey FROM customer) THEN 'update' ELSE 'insert' END AS action FROM batch b""")
def upsert_split(spark, d):
    return ver.upsert_split(table(spark, d, "customer"), _batch(spark, d), "c_custkey")


@query("incremental_ingest", f"""WITH {BATCH_SQL}
SELECT c_custkey, c_name, c_mktsegment FROM customer
UNION ALL SELECT * FROM batch WHERE c_custkey NOT IN (SELECT c_custkey FROM customer)""")
def incremental_ingest(spark, d):
    """Append the unknown rows to a stored table, then run the same batch again: nothing is added."""
    path = scratch_dir(spark, "ingest")
    table(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment").write.parquet(path)
    for _ in range(2):
        stored = spark.read.parquet(path)
        ver.incremental_ingest(_batch(spark, d), stored, "c_custkey").write.mode("append").parquet(path)
    return spark.read.parquet(path)


@query("snapshot_delta_join", """
WITH cur AS (SELECT CAST(c_custkey AS VARCHAR) AS external_id, c_name AS name, CAST(floor(c_acctbal) AS BIGINT) AS score FROM customer),
prev AS (SELECT CAST(c_custkey AS VARCHAR) AS external_id, CAST(floor(c_acctbal) AS BIGINT) - (c_custkey % 9 - 4) AS score
         FROM customer WHERE c_custkey % 6 <> 0)
SELECT cur.external_id, name, cur.score, coalesce(prev.score, 0) AS score_prev, cur.score - coalesce(prev.score, 0) AS score_delta
FROM cur LEFT JOIN prev USING (external_id) WHERE score_delta > 0""")
def snapshot_delta_join(spark, d):
    c = table(spark, d, "customer")
    ident, score = F.col("c_custkey").cast("string").alias("external_id"), F.floor("c_acctbal")
    current = c.select(ident, F.col("c_name").alias("name"), score.alias("score"))
    previous = c.where(F.col("c_custkey") % 6 != 0).select(ident, (score - (F.col("c_custkey") % 9 - 4)).alias("score"))
    return ver.snapshot_delta_join(current, previous).withColumn(
        "score_prev", F.coalesce("score_prev", F.lit(0))).select("external_id", "name", "score", "score_prev", "score_delta")


@query("previous_snapshot", """
WITH cur AS (SELECT CAST(c_custkey AS VARCHAR) AS external_id, CAST(floor(c_acctbal) AS BIGINT) AS score FROM customer),
prev AS (SELECT CAST(c_custkey AS VARCHAR) AS external_id, CAST(floor(c_acctbal) AS BIGINT) - (c_custkey % 9 - 4) AS score
         FROM customer WHERE c_custkey % 6 <> 0)
SELECT 'Hot Topics' AS query, external_id, cur.score - coalesce(prev.score, 0) AS score_delta
FROM cur LEFT JOIN prev USING (external_id) WHERE score_delta > 0
UNION ALL SELECT 'Other', external_id, score FROM cur""")
def previous_snapshot(spark, d):
    """Three captures of one query and one of another in a stored table: the newest against the one before."""
    c, path = table(spark, d, "customer"), scratch_dir(spark, "captures")
    key, score = F.col("c_custkey"), F.floor("c_acctbal")
    captures = [("Hot Topics", "20260101_000000", score + 1000, key.isNotNull()), ("Hot Topics", "20260103_000000", score, key.isNotNull()),
                ("Hot Topics", "20260102_000000", score - (key % 9 - 4), key % 6 != 0),
                ("Other", "20260104_000000", score, key.isNotNull())]
    for name, at, value, which in captures:
        partitioned_snapshot_write(c.where(which).select(
            key.cast("string").alias("external_id"), value.cast("long").alias("score"), F.lit("shop").alias("source"),
            F.lit(name).alias("query"), F.lit(at).alias("captured_at")), path)
    stored = spark.read.schema(
        "external_id string, score long, source string, query string, captured_at string").parquet(path)
    newest = {"Hot Topics": "20260103_000000", "Other": "20260104_000000"}
    return union_sources([ver.snapshot_delta_join(
        stored.where(F.col("captured_at") == at).select("external_id", "score"), ver.previous_snapshot(stored, "shop", name)
    ).select(F.lit(name).alias("query"), "external_id", "score_delta") for name, at in newest.items()])
