"""Ordered operators: literal cases, and random cases against small sequential models.

Every model test runs twice: with plain windows, and with thresholds so low that every key counts
as hot and is computed in range pieces.
"""

import random

import pytest

from millrace.operators import timeseries as ts
from millrace.operators.running import Running, running
from millrace.operators.relational import rank_variants
from pyspark.sql import functions as F

HOT = [None, 5]


def frame(spark, data, schema):
    return spark.createDataFrame(data, schema)


@pytest.mark.parametrize("hot", HOT)
def test_sliding_count_follows_arrival_on_ties(spark, rows, hot):
    t = [10_000_000, 10_000_000, 40_000_000, 70_000_000, 70_100_000]
    df = frame(spark, [(1, x, i) for i, x in enumerate(t)], "k int, ts long, seq long")
    out = ts.sliding_count(df, ["k"], "ts", "seq", 60_000_000, hot_rows=hot)
    assert [r["window_count"] for r in out.orderBy("seq").collect()] == [1, 2, 3, 4, 3]


def test_probe_count_closed_window(spark, rows):
    events = frame(spark, [(10,), (20,), (30,)], "ts long")
    probes = frame(spark, [(50,), (75,), (100,)], "ts long")
    out = ts.window_probe_count(events, probes, [], "ts", 60)
    assert sorted(rows(out.select("ts", "window_count"))) == [(50, 3), (75, 2), (100, 0)]


def test_probe_after_a_long_gap(spark, rows):
    events = frame(spark, [(10, 0), (3610, 1)], "ts long, seq long")
    counted = ts.sliding_count(events, [], "ts", "seq", 60)
    assert [r["window_count"] for r in counted.orderBy("ts").collect()] == [1, 1]
    probe = frame(spark, [(3700,)], "ts long")
    assert rows(ts.window_probe_count(events, probe, [], "ts", 60)) == [(3700, 0)]


def test_alerts_keep_the_closed_bound(spark):
    events = frame(spark, [(100, 0), (110, 1), (120, 2), (170, 3)], "ts long, seq long")
    counted = ts.sliding_count(events, [], "ts", "seq", 60)
    assert [r["window_count"] for r in counted.orderBy("seq").collect()] == [1, 2, 3, 3]
    assert sorted(r["ts"] for r in ts.error_alert(counted).collect()) == [120, 170]


def test_rolling_mean_is_open_on_the_left(spark):
    df = frame(spark, [("u", 0, 10.0, 0), ("u", 299, 20.0, 1), ("u", 300, 60.0, 2), ("u", 300, 30.0, 3)],
               "user string, sec long, amount double, seq long")
    out = ts.rolling_mean(df, ["user"], "sec", "amount", "seq").orderBy("seq").collect()
    assert [r["rolling_mean_amount"] for r in out] == [10.0, 15.0, 110 / 3, 110 / 3]
    assert [r["amount"] for r in out] == [10.0, 20.0, 30.0, 30.0]


@pytest.mark.parametrize("hot", [50_000, 20])
def test_rolling_mean_across_span_edges(spark, hot):
    rng = random.Random(3)
    data = [(rng.choice("ab"), rng.randrange(2000), float(rng.randrange(100)), i) for i in range(600)]
    df = frame(spark, data, "user string, sec long, amount double, seq long")
    got = {r["seq"]: r["rolling_mean_amount"] for r in
           ts.rolling_mean(df, ["user"], "sec", "amount", "seq", seconds=30, hot_rows=hot).collect()}
    for u, t, _, i in data:
        window = [a for v, s, a, _ in data if v == u and t - 30 < s <= t]
        assert got[i] == pytest.approx(sum(window) / len(window))


def arrival_model(stream, gap):
    active, done = {}, []
    for user, t in stream:
        s = active.get(user)
        if s is None or t - s[2] >= gap:
            if s:
                done.append(tuple(s))
            active[user] = [user, t, t, 1]
        else:
            s[2] = max(s[2], t)
            s[3] += 1
    return sorted(done + [tuple(s) for s in active.values()])


def test_arrival_sessions_late_rows_only_count(spark, rows):
    stream = [("k", 50), ("k", 20), ("m", 900), ("k", 1849), ("k", 10), ("m", 2701), ("k", 3650)]
    df = frame(spark, [(u, t, i) for i, (u, t) in enumerate(stream)], "user string, ts long, seq long")
    out = ts.sessionize_arrival(df, ["user"], "ts", ["seq"]).drop("session_no")
    assert sorted(rows(out)) == arrival_model(stream, 1800)
    assert ("k", 50, 1849, 4) in rows(out) and ("m", 2701, 2701, 1) in rows(out)


@pytest.mark.parametrize("hot", HOT)
def test_arrival_sessions_model(spark, rows, hot):
    rng = random.Random(7)
    stream = [(rng.choice("abc"), max(0, i * 4 + rng.randrange(-60, 60))) for i in range(400)]
    df = frame(spark, [(u, t, i) for i, (u, t) in enumerate(stream)], "user string, ts long, seq long")
    out = ts.sessionize_arrival(df, ["user"], "ts", ["seq"], gap=15, hot_rows=hot).drop("session_no")
    assert sorted(rows(out)) == arrival_model(stream, 15)


def test_event_sessions_split_at_exactly_the_gap(spark, rows):
    df = frame(spark, [("u1", m) for m in (600, 615, 650, 655)] + [("u2", 600)], "user string, minute int")
    assert sorted(rows(ts.session_count_by_user(df, ["user"], "minute", 30))) == [("u1", 2), ("u2", 1)]
    df = frame(spark, [("u1", m) for m in (600, 735, 650, 655)] + [("u2", 600)], "user string, minute int")
    assert sorted(rows(ts.session_count_by_user(df, ["user"], "minute", 30))) == [("u1", 3), ("u2", 1)]
    edge = frame(spark, [("u", 0), ("u", 30), ("u", 59)], "user string, minute int")
    assert sorted(rows(ts.sessionize_event_time(edge, ["user"], "minute", 30))) == [("u", 0, 0, 1), ("u", 30, 59, 2)]


def interval_model(intervals):
    out = []
    for s, e in sorted(intervals):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return sorted(tuple(x) for x in out)


@pytest.mark.parametrize("given", [
    [(7, 9), (9, 12), (20, 21), (13, 19)], [(0, 50), (40, 45), (50, 51), (2, 3)], [(5, 5), (5, 5), (6, 6)], [], [(-4, -1)]])
def test_interval_merge_small(spark, rows, given):
    assert sorted(rows(ts.interval_merge(frame(spark, given, "start long, end long"), []))) == interval_model(given)


def test_equal_intervals_of_a_hot_key_are_one(spark, rows):
    df = spark.range(60_000).selectExpr("'k' AS k", "5L AS start", "9L AS end")
    assert rows(ts.interval_merge(df, ["k"], hot_rows=100)) == [("k", 5, 9)]


@pytest.mark.parametrize("hot", HOT)
def test_interval_merge_model(spark, rows, hot):
    rng = random.Random(11)
    data = []
    for k in "ab":
        for _ in range(150):
            s = rng.randrange(1000)
            data.append((k, s, s + rng.randrange(8)))
    out = ts.interval_merge(frame(spark, data, "k string, start long, end long"), ["k"], hot_rows=hot)
    expected = [(k, *iv) for k in "ab" for iv in interval_model([d[1:] for d in data if d[0] == k])]
    assert sorted(rows(out)) == sorted(expected)


@pytest.mark.parametrize("hot", HOT)
def test_asof_steps(spark, hot):
    history = frame(spark, [(k, f"{k}{t}", t, i) for i, (k, t) in enumerate(
        [("rate", 40), ("rate", 10), ("rate", 25), ("mode", 30)])], "key string, value string, ts long, seq long")
    asked = [("rate", 9, 1), ("rate", 10, 2), ("rate", 39, 3), ("rate", 999, 4), ("mode", 29, 5), ("none", 50, 6)]
    out = ts.asof_latest(history, frame(spark, asked, "key string, ts long, seq long"), ["key"], "ts", "value", "seq",
                         hot_rows=hot)
    assert [r["value"] for r in out.orderBy("seq").collect()] == ["", "rate10", "rate25", "rate40", "", ""]


def test_asof_equal_times_and_stored_null(spark):
    history = frame(spark, [("k", "a", 100, 0), ("k", None, 100, 1)], "key string, value string, ts long, seq long")
    probe = frame(spark, [("k", 100, 9)], "key string, ts long, seq long")
    assert ts.asof_latest(history, probe, ["key"], "ts", "value", "seq").first()["value"] is None


@pytest.mark.parametrize("hot", HOT)
def test_kway_merge_model(spark, hot):
    import heapq
    rng = random.Random(5)
    streams = [[rng.randrange(100) for _ in range(40)] for _ in range(3)]
    data = [(i, n, t) for i, s in enumerate(streams) for n, t in enumerate(s)]
    df = frame(spark, data, "stream_idx int, seq long, ts long")
    merged = ts.kway_merge(df, "stream_idx", "ts", ["seq"], hot_rows=hot)
    placed = ts.with_position(merged, ["merge_ts", "stream_idx", "seq"], hot_rows=hot)
    got = [(r["stream_idx"], r["seq"]) for r in placed.orderBy("position").collect()]
    heap = [(s[0], i, 0) for i, s in enumerate(streams)]
    heapq.heapify(heap)
    expected = []
    while heap:
        _, i, n = heapq.heappop(heap)
        expected.append((i, n))
        if n + 1 < len(streams[i]):
            heapq.heappush(heap, (streams[i][n + 1], i, n + 1))
    assert got == expected
    assert sorted(r["position"] for r in placed.collect()) == list(range(1, 121))


def test_late_rows_are_flagged(spark):
    data = [(100, 0), (102, 1), (105, 2), (101, 3), (110, 4), (108, 5), (112, 6)]
    out = ts.flag_late(frame(spark, data, "ts long, seq long"), [], "ts", ["seq"]).orderBy("seq").collect()
    assert [r["is_late"] for r in out] == [False, False, False, True, False, True, False]


def test_stall(spark):
    df = frame(spark, [("a", 0, 0), ("a", 10, 1), ("a", 21, 2), ("b", 5, 3)], "src string, at long, seq long")
    out = ts.flag_stall(df, "src", "at", "seq", 10).orderBy("seq").collect()
    assert [r["is_stalled"] for r in out] == [False, False, True, False]


@pytest.mark.parametrize("hot", HOT)
def test_running_with_null_keys(spark, hot):
    data = [(None if i % 2 else "x", i, i % 7) for i in range(60)]
    df = frame(spark, data, "k string, seq long, v long")
    out = running(df, ["k"], ["seq"], [
        Running("total", "sum", F.col("v")), Running("top", "max", F.col("v"), before=True)],
        hot_rows=hot, piece_rows=7)
    assert out.count() == 60
    for r in out.collect():
        same = [d for d in data if d[0] == r["k"]]
        assert r["total"] == sum(d[2] for d in same if d[1] <= r["seq"])
        before = [d[2] for d in same if d[1] < r["seq"]]
        assert r["top"] == (max(before) if before else None)


@pytest.mark.parametrize("hot", HOT)
def test_rank_variants(spark, hot):
    data = [("g", a, i) for i, a in enumerate([5, 9, 9, 3, 5, 9, 1, 1])]
    out = rank_variants(frame(spark, data, "g string, amount long, id long"), ["g"], "amount", "id", hot_rows=hot)
    got = [(r["amount"], r["row_number"], r["rank"], r["dense_rank"]) for r in out.orderBy("row_number").collect()]
    assert got == [(9, 1, 1, 1), (9, 2, 1, 1), (9, 3, 1, 1), (5, 4, 4, 2), (5, 5, 4, 2), (3, 6, 6, 3),
                   (1, 7, 7, 4), (1, 8, 7, 4)]
