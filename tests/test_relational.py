"""Joins, totals, ranks, history tables and graphs on literal rows."""

import pytest

from millrace.operators import graph, rate_limit, relational as rel, versioned as ver
from millrace.sources.tables import SnapshotTable

# Three rows of one id, ties in the amount, a null amount.
ORDERS = [(f"b{n}", f"k{n % 3}", f"p{n}", cat, amount, f"2031-05-{day:02d} 08:00:00") for n, cat, amount, day in [
    (1, "tools", 70, 9), (1, "tools", 65, 3), (1, "tools", 60, 20), (2, "tools", 80, 4), (3, "tools", 65, 5),
    (4, "tools", 15, 6), (5, "seeds", 9, 7), (6, "seeds", 9, 8), (7, "seeds", 2, 9), (8, "seeds", 1, 1), (8, "seeds", 30, 2)]]
ORDER_DDL = "order_id string, customer_id string, product_id string, category string, amount long, ordered_at string"


def test_dedup_and_top_two(spark):
    df = spark.createDataFrame(ORDERS, ORDER_DDL)
    once = rel.dedup_first(df, ["order_id"], ["ordered_at"])
    assert once.count() == 8
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, rel.dedup_first_sql(df, ["order_id"], ["ordered_at"]).collect()))
    top = rel.top_n_dense(once, "category", "amount", 2).orderBy("category", "dense_rank")
    assert [(r["category"], r["order_id"], r["amount"], r["dense_rank"]) for r in top.orderBy("category", "dense_rank", "order_id").collect()] == [
        ("seeds", "b5", 9, 1), ("seeds", "b6", 9, 1), ("seeds", "b7", 2, 2),
        ("tools", "b2", 80, 1), ("tools", "b1", 65, 2), ("tools", "b3", 65, 2)]


def test_top_n_keeps_ties(spark):
    df = spark.createDataFrame([("a", 5, 1), ("a", 5, 2), ("a", 4, 3), ("a", 3, 4)], "g string, amount int, id int")
    assert sorted(r["id"] for r in rel.top_n_dense(df, "g", "amount", 2).collect()) == [1, 2, 3]


def test_only_one_row_per_key_is_shuffled(spark):
    df = spark.createDataFrame(ORDERS, ORDER_DDL)
    plan = rel.dedup_first(df, ["order_id"], ["ordered_at"])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Partial") > plan.index("Exchange")  # the partial limit runs below the shuffle


def test_countries_last_user_row_wins(spark, rows):
    users = spark.createDataFrame([("u1", "XX", 0), ("u1", "JP", 1), ("u2", "US", 2), ("u3", "UK", 3)],
                                  "user_id string, country string, seq int")
    tx = spark.createDataFrame([("u1", 1000), ("u2", 2000), ("u1", 500), ("u99", 3000)], "user_id string, amount long")
    assert sorted(rows(rel.sum_by_country(tx, users, "user_id", "amount", "country", "seq"))) == [
        ("JP", 1500), ("US", 2000), ("Unknown", 3000)]
    assert sorted(r["country"] for r in rel.left_join_unknown(tx, users, "user_id", "country", "seq").collect()) == [
        "JP", "JP", "US", "Unknown"]


def test_broadcast_and_pivot(spark, rows):
    sold = [(f"t{i}", f"w{i % 4}", "tea" if i % 3 else "rye", i + 1) for i in range(10)] + [("t10", "w7", "tea", 50), ("t11", "w0", "tin", 9)]
    sales = spark.createDataFrame(sold, "transaction_id string, store_id string, category string, amount long")
    areas = {"w0": "north", "w1": "south", "w2": "north", "w3": "west"}
    stores = spark.createDataFrame([(k, k.upper(), a) for k, a in areas.items()], "store_id string, store_name string, region string")
    joined = rel.small_side_left_join(sales, stores, "store_id")
    assert "BroadcastHashJoin" in joined._jdf.queryExecution().executedPlan().toString()
    out = rel.pivot_sum(joined, "region", "category", ["tea", "rye", "ink"], "amount")
    total = lambda a, c: sum(n for _, w, k, n in sold if areas.get(w) == a and k == c)
    assert sorted(rows(out), key=str) == sorted(((a, total(a, "tea"), total(a, "rye"), 0) for a in ("north", "south", "west", None)), key=str)


def test_large_side_is_not_broadcast(spark):
    df = spark.range(20).toDF("id")
    assert rel.checked_broadcast(df, 10) is df


def test_majority_vote(spark, rows):
    data = [("q1", 0, "10"), ("q1", 1, "12"), ("q1", 2, "12"), ("q2", 0, "2"), ("q2", 1, "3"), ("q3", 0, None)]
    out = rel.majority_vote(spark.createDataFrame(data, "q string, agent int, answer string"), "q", "agent", "answer")
    assert sorted(rows(out)) == [("q1", "12", 2), ("q2", "2", 1), ("q3", "0", 0)]


@pytest.mark.parametrize("orders,revenue,count", [
    ([("Regular", [("100.0", "2"), ("50.0", "1")])], 250.0, 1),
    ([("VIP", [("100.0", "2")]), ("vip", [("50.0", "2")])], 270.0, 2),
    ([("Regular", [("150.5", "2"), ("200", "1")])], 501.0, 1),
    ([(None, [(None, "2"), ("5", None)])], 5.0, 1),
])
def test_order_totals(spark, rows, orders, revenue, count):
    data = [((m,), items) for m, items in orders]
    df = spark.createDataFrame(data, "customer struct<membership:string>, items array<struct<price:string,quantity:string>>")
    assert rows(rel.order_totals(df)) == [(revenue, count)]


HISTORY = "customer_id string, name string, email string, is_current boolean, valid_from string, valid_to string"


OPEN = "9999-12-31"


def history(spark):
    return spark.createDataFrame([("h3", "Noor", "n@mail.example", True, "2030-06-01", OPEN),
                                  ("h5", "Ilse", "i@mail.example", True, "2030-07-01", OPEN),
                                  ("h8", "Wim", "w@mail.example", True, "2030-08-01", OPEN)], HISTORY)


def batch(spark):
    return spark.createDataFrame([("h8", "Wim", "wim@post.example"), ("h9", "Ada", "a@mail.example"),
                                  ("h3", "Noor", "n@mail.example")], "customer_id string, name string, email string")


def merge(h, b):
    return ver.scd2_merge(h, b, "customer_id", "email", ["name", "email"], "2031-01-15")


def test_scd2_merge_and_time_travel(spark, rows, tmp_path):
    t = SnapshotTable(spark, str(tmp_path))
    t.commit(history(spark), "WRITE")
    t.commit(merge(t.read(), batch(spark)), "MERGE")
    t.commit(merge(t.read(), batch(spark)), "MERGE")
    expected = sorted([r for r in rows(history(spark)) if r[0] != "h8"] + [
        ("h8", "Wim", "w@mail.example", False, "2030-08-01", "2031-01-15"),
        ("h8", "Wim", "wim@post.example", True, "2031-01-15", OPEN), ("h9", "Ada", "a@mail.example", True, "2031-01-15", OPEN)])
    assert sorted(rows(t.read(1))) == expected
    assert sorted(rows(t.read(2))) == expected
    assert t.read(0).count() == 3
    assert [(r["version"], r["operation"], r["num_rows"]) for r in t.history().orderBy("version").collect()] == [
        (0, "WRITE", 3), (1, "MERGE", 5), (2, "MERGE", 5)]
    with pytest.raises(ValueError):
        t.read(9)


def test_scd2_ignores_names_and_null_emails(spark, rows):
    b = spark.createDataFrame([("h3", "Noora", "n@mail.example"), ("h5", "Ilse", None)],
                              "customer_id string, name string, email string")
    assert sorted(rows(merge(history(spark), b))) == sorted(rows(history(spark)))
    strict = ver.scd2_merge(history(spark), b, "customer_id", "email", ["name", "email"], "2031-01-15", null_safe=True)
    assert strict.count() == 4


def test_scd2_refuses_two_rows_per_key(spark):
    with pytest.raises(ver.DuplicateSourceKey):
        merge(history(spark), batch(spark).union(batch(spark)))


def test_snapshot_delta(spark):
    current = spark.createDataFrame([("x", 8), ("y", 1), ("z", 4)], "external_id string, score long")
    previous = spark.createDataFrame([("x", 5), ("z", 4), ("w", 2)], "external_id string, score long")
    out = ver.snapshot_delta_join(current, previous).collect()
    assert sorted((r["external_id"], r["score_prev"], r["score_delta"]) for r in out) == [("x", 5, 3), ("y", None, 1)]
    assert sorted(r["score_delta"] for r in ver.snapshot_delta_join(current, None).collect()) == [1, 4, 8]


def test_upserts(spark, rows):
    target = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    source = spark.createDataFrame([("b", 20), ("c", 30)], "k string, v int")
    assert sorted(rows(ver.upsert_by_key(target, source, ["k"]))) == [("a", 1), ("b", 20), ("c", 30)]
    assert sorted((r["k"], r["action"]) for r in ver.upsert_split(target, source, "k").collect()) == [
        ("b", "update"), ("c", "insert")]
    assert rows(ver.incremental_ingest(source, target, "k")) == [("c", 30)]


def test_topo_levels(spark):
    edges = [("embed", "tokenize"), ("tokenize", "load"), ("index", "embed"), ("serve", "index"), ("serve", "load"), ("load", None)]
    df = spark.createDataFrame(edges, "node string, parent string")
    alone = spark.createDataFrame([("docs",)], "node string")
    got = {r["node"]: r["level"] for r in graph.topo_levels(df, alone).collect()}
    assert got == {"load": 0, "docs": 0, "tokenize": 1, "embed": 2, "index": 3, "serve": 4}


def test_cycle_is_an_error(spark):
    df = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("d", "a"), ("e", "x")], "node string, parent string")
    with pytest.raises(graph.CycleError) as e:
        graph.topo_levels(df)
    assert {r["node"] for r in e.value.residual.collect()} == {"a", "b", "c", "d"}


@pytest.mark.parametrize("hot", [None, 5])
def test_token_bucket_model(spark, hot):
    import random
    rng = random.Random(2)
    data = sorted((rng.choice("ab"), rng.randrange(300)) for _ in range(300))
    rows_in = [(k, t, i) for i, (k, t) in enumerate(data)]
    rows_in += [(None, t, 1000 + i) for i, (_, t) in enumerate(data[:80])]
    capacity, tokens, period = 4, 2, 7
    out = {r["seq"]: r["allowed"] for r in rate_limit.token_bucket(
        spark.createDataFrame(rows_in, "k string, ts long, seq long"), ["k"], "ts", "seq", capacity, tokens, period,
        hot_rows=hot).collect()}
    for key in ("a", "b", None):
        credit, last = capacity * period, None
        for k, t, i in rows_in:
            if k != key:
                continue
            credit = min(capacity * period, credit + (0 if last is None else (t - last) * tokens))
            last = t
            ok = credit >= period
            credit -= period if ok else 0
            assert out[i] == ok


@pytest.mark.parametrize("hot", [None, 5])
def test_token_bucket_wait_model(spark, hot):
    import random
    from fractions import Fraction
    rng = random.Random(4)
    data = sorted((rng.choice("ab"), rng.randrange(400)) for _ in range(200))
    rows_in = [(k, t, i, rng.randrange(1, 5)) for i, (k, t) in enumerate(data)]
    capacity, rate = 5, Fraction(2, 3)
    out = {r["seq"]: r["wait"] for r in rate_limit.token_bucket_wait(
        spark.createDataFrame(rows_in, "k string, ts long, seq long, amount long"), ["k"], "ts", "seq", "amount",
        capacity, 2, 3, hot_rows=hot).collect()}
    for key in "ab":
        level, clock = Fraction(capacity), None
        for k, t, i, amount in rows_in:
            if k != key:
                continue
            now = Fraction(t) if clock is None else max(Fraction(t), clock)
            level = min(Fraction(capacity), level + (0 if clock is None else (now - clock) * rate))
            wait = max(Fraction(0), (amount - level) / rate)
            level = max(Fraction(0), level - amount)
            clock = now + wait
            assert out[i] == pytest.approx(float(clock - t))


@pytest.mark.parametrize("kind", ["double", "decimal(12,6)"])
def test_token_bucket_on_fractional_times(spark, kind):
    import random
    rng = random.Random(5)
    times = sorted(rng.randrange(0, 60_000) / 1000 for _ in range(250))
    df = spark.createDataFrame([("k", t, i) for i, t in enumerate(times)], "k string, ts double, seq long")
    df = df.withColumn("ts", df["ts"].cast(kind))
    out = rate_limit.token_bucket(df, ["k"], "ts", "seq", 3, 2, 1)
    assert out.columns == ["k", "ts", "seq", "allowed"] and out.count() == len(times)
    got, level, last = {r["seq"]: r["allowed"] for r in out.collect()}, 3000, 0
    for i, t in enumerate(times):
        now = round(t * 1000)
        level, last = min(3000, level + (now - last) * 2), now
        assert got[i] == (level >= 1000)
        level -= 1000 if level >= 1000 else 0


def test_rank_variants_put_null_amounts_last(spark):
    rows = [("g", 30, 1), ("g", None, 2), ("g", None, 3), ("g", -(2 ** 63), 4), ("g", 30, 5)]
    out = rel.rank_variants(spark.createDataFrame(rows, "g string, v long, t int"), ["g"], "v", "t").orderBy("t").collect()
    assert [(r["row_number"], r["rank"], r["dense_rank"]) for r in out] == [(1, 1, 1), (4, 4, 3), (5, 4, 3), (3, 3, 2), (2, 1, 1)]


def test_previous_snapshot(spark):
    stored = spark.createDataFrame([("s", "hot_topics", c, i) for i, c in enumerate(["3", "1", "2", "2"])] + [
        ("s", "one", "9", 7), ("t", "hot_topics", "8", 8)], "source string, query string, captured_at string, n int")
    assert sorted(r["n"] for r in ver.previous_snapshot(stored, "s", "Hot Topics").collect()) == [2, 3]
    assert ver.previous_snapshot(stored, "s", "one") is None and ver.previous_snapshot(stored, "s", "none") is None
