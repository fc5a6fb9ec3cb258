"""Hot keys: the plan parts that keep them out of a single task."""

from pyspark.sql import functions as F

from millrace.operators import relational as rel, running as run, timeseries as ts


def test_hot_keys_are_found_and_the_rest_is_not(spark):
    df = spark.range(1000).select(F.when(F.col("id") < 400, "hot").otherwise(F.col("id").cast("string")).alias("k"), "id")
    hot = run.find_hot_keys(df, ["k"], 100)
    assert (hot.n_keys, hot.n_rows) == (1, 400) and [r["k"] for r in hot.keys.collect()] == ["hot"]
    assert run.find_hot_keys(df, ["k"], 400) is run.NO_HOT_KEYS


def test_pieces_of_a_hot_key_are_even(spark, monkeypatch):
    seen = {}
    cut = run.cut_lineage

    def spy(df):
        out = cut(df)
        if "_piece" in out.columns:
            seen["sizes"] = [r["count"] for r in out.groupBy("_piece").count().collect()]
        return out

    monkeypatch.setattr(run, "cut_lineage", spy)
    # One key at one instant: only the arrival order can split it.
    df = spark.range(4000).select(F.lit("hot").alias("k"), F.lit(7).alias("ts"), F.col("id").alias("seq"))
    out = run.running(df, ["k"], ["ts", "seq"], [run.Running("n", "sum", F.lit(1))], hot_rows=100, piece_rows=500)
    assert out.where(F.col("n") != F.col("seq") + 1).isEmpty()
    assert len(seen["sizes"]) == 8 and max(seen["sizes"]) < 1000


def test_hot_key_next_to_small_ones(spark):
    data = [("hot", i % 50, i) for i in range(900)] + [(f"k{i % 30}", i, i + 900) for i in range(300)]
    df = spark.createDataFrame(data, "k string, ts long, seq long")
    plain = ts.sliding_count(df, ["k"], "ts", "seq", 10)
    split = ts.sliding_count(df, ["k"], "ts", "seq", 10, hot_rows=200)
    assert plain.count() == 1200 and plain.exceptAll(split.select(plain.columns)).isEmpty()


def test_busy_user_is_one_row_at_the_join(spark):
    tx = spark.range(1000).select(F.lit("u1").alias("user_id"), F.col("id").alias("amount"))
    users = spark.createDataFrame([("u1", "JP", 0)], "user_id string, country string, seq int")
    plan = rel.sum_by_country(tx, users, "user_id", "amount", "country", "seq")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join") < plan.index("sum(amount")


def test_session_slots_are_added_up_before_the_shuffle(spark):
    df = spark.range(1000).select(F.lit("u").alias("k"), F.col("id").alias("ts"))
    plan = ts.sessionize_event_time(df, ["k"], "ts", 10)._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan and plan.rindex("partial_min") > plan.rindex("Exchange")


def test_hot_key_of_event_time_sessions(spark):
    """A key with as many slots as rows is read in pieces; the sessions stay the same."""
    data = [("hot", i * 2 + (i // 100) * 5) for i in range(800)] + [(f"k{i % 20}", i * 3) for i in range(200)]
    df = spark.createDataFrame(data, "k string, ts long")
    plain = ts.sessionize_event_time(df, ["k"], "ts", 3)
    split = ts.sessionize_event_time(df, ["k"], "ts", 3, hot_rows=100)
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, split.collect())) and plain.count() > 20
