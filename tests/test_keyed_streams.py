"""Keyed state in the store: batches, restarts, late rows, timers, flushes by time."""

import json
import random
import time

import pandas as pd
import pytest

from millrace.streaming import keyed, sinks, windows as win
from test_streams import put
from test_timeseries import arrival_model

ROWS = "user string, ts bigint, seq bigint"


def test_sessions_equal_one_run(spark, tmp_path):
    """Batches of any cut, late rows among them, a restart between any two; also a key that is null."""
    rng = random.Random(3)
    stream = [(rng.choice("abc"), max(0, i * 4 + rng.randrange(-60, 60))) for i in range(300)]
    folder, out = str(tmp_path / "in"), str(tmp_path / "run")
    for part in (range(0, 90), range(90, 91), range(91, 300)):
        put(spark, folder, [{"user": stream[i][0], "ts": stream[i][1], "seq": i} for i in part])
        keyed.run_sessions(win.json_stream(spark, folder, ROWS), "user", "ts", ["seq"], 15, out)
    put(spark, folder, [{"user": None, "ts": 5, "seq": 0}, {"user": None, "ts": 50, "seq": 1}])
    keyed.run_sessions(win.json_stream(spark, folder, ROWS), "user", "ts", ["seq"], 15, out)
    closed = [tuple(r) for r in spark.read.parquet(f"{out}/out").collect()]
    still_open = [tuple(r) for r in keyed.open_sessions(spark, out, "user").collect()]
    assert sorted(r for r in closed + still_open if r[0]) == arrival_model(stream, 15)
    assert [r for r in closed if not r[0]] == [(None, 5, 5, 1)] and (None, 50, 50, 1) in still_open
    assert len(still_open) == 4


def test_a_batch_writes_its_own_keys_only(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "run")
    put(spark, folder, [{"user": f"u{i}", "ts": i, "seq": i} for i in range(500)])
    run = lambda: keyed.run_sessions(win.json_stream(spark, folder, ROWS), "user", "ts", ["seq"], 15, out)
    run()
    put(spark, folder, [{"user": "u7", "ts": 400, "seq": 900}])
    states = [op for p in run().recentProgress for op in p["stateOperators"]]
    assert sum(op["numRowsUpdated"] for op in states) <= 3 and max(op["numRowsTotal"] for op in states) >= 500
    assert [tuple(r) for r in spark.read.parquet(f"{out}/out").collect()] == [("u7", 7, 7, 1)]


def alerts(stream, width, threshold):
    """By hand: rows of the same key known so far, within the last ``width``."""
    seen, out = {}, []
    for key, ts, seq in stream:
        times = seen.setdefault(key, [])
        times.append(ts)
        n = sum(ts - width <= t <= ts for t in times)
        if n >= threshold:
            out.append((key, ts, seq, n))
    return sorted(out)


def test_alerts_equal_one_run(spark, tmp_path):
    rng = random.Random(5)
    times = sorted(rng.randrange(0, 900) for _ in range(250))
    stream = [(rng.choice("ab"), t, i) for i, t in enumerate(times)]
    folder, out = str(tmp_path / "in"), str(tmp_path / "run")
    for part in (stream[:60], stream[60:61], stream[61:200], stream[200:]):
        put(spark, folder, [{"user": k, "ts": t, "seq": i} for k, t, i in part])
        keyed.run_alerts(win.json_stream(spark, folder, ROWS), "user", "ts", "seq", 30, out, threshold=4)
    assert sorted(tuple(r) for r in spark.read.parquet(f"{out}/out").collect()) == alerts(stream, 30, 4)
    kept = spark.read.format("statestore").option("stateVarName", "recent").load(f"{out}/checkpoint")
    last = {k: max(t for u, t, _ in stream if u == k) for k in "ab"}
    held = kept.selectExpr("key.user AS k", "list_element.ts AS ts").collect()
    assert {r["k"] for r in held} == {"a", "b"} and all(last[r["k"]] - 30 <= r["ts"] <= last[r["k"]] for r in held)


def wait_for(condition, seconds=90):
    end = time.time() + seconds
    while not condition():
        assert time.time() < end, "nothing came"
        time.sleep(0.5)


def rows_of(spark, path):
    try:
        return [tuple(r) for r in spark.read.parquet(path).collect()]
    except Exception:  # noqa: BLE001  the sink has written nothing yet
        return []


def test_silent_keys_are_flushed_by_a_timer(spark, tmp_path):
    """A session comes out and leaves the store when its key has been silent, without a later row."""
    folder, out = str(tmp_path / "in"), str(tmp_path / "run")
    put(spark, folder, [{"user": "a", "ts": 1, "seq": 0}, {"user": "a", "ts": 9, "seq": 1}])
    query = keyed.run_sessions(win.json_stream(spark, folder, ROWS), "user", "ts", ["seq"], 15, out, every="1 second",
                               idle_ms=1500)
    try:
        wait_for(lambda: rows_of(spark, f"{out}/out") == [("a", 1, 9, 2)])
    finally:
        query.stop()
        query.awaitTermination(60)
    assert keyed.open_sessions(spark, out, "user").collect() == []


def test_micro_batches_flush_after_a_time(spark, tmp_path):
    """What has arrived is written within the interval though no batch is full; later rows follow, none is lost."""
    folder, out = str(tmp_path / "in"), str(tmp_path / "run")
    tx = lambda i: json.dumps({"transaction_id": f"tx_{i}", "user_id": "usr_1", "amount": 1.5, "currency": "JPY",
                               "timestamp": "2026-06-25T15:00:00Z"})
    spark.createDataFrame([(tx(1),)], "value string").write.text(folder)
    query = sinks.micro_batch_sink(sinks.text_stream(spark, folder), out, batch_rows=100, every="1 second")
    ids = lambda: sorted(r[0] for r in rows_of_column(spark, f"{out}/ok"))
    try:
        wait_for(lambda: ids() == ["tx_1"])
        spark.createDataFrame([(tx(i),) for i in range(2, 6)], "value string").write.mode("append").text(folder)
        query.processAllAvailable()
    finally:
        query.stop()
        query.awaitTermination(60)
    assert ids() == [f"tx_{i}" for i in range(1, 6)]


def rows_of_column(spark, path):
    try:
        return spark.read.parquet(path).select("transaction_id").collect()
    except Exception:  # noqa: BLE001
        return []


@pytest.mark.parametrize("processor", [keyed.ArrivalSessions("k", "t", ["s"], 5), keyed.RecentCount("k", "t", "s", 5)])
def test_processors_travel(processor):
    from pyspark import cloudpickle
    assert vars(cloudpickle.loads(cloudpickle.dumps(processor))) == vars(processor)


class Held:
    """One value or list of the store."""

    def __init__(self):
        self.now = None

    def get(self):
        return self.now

    def update(self, value):
        self.now = value

    put = update


def test_keys_without_a_result_give_no_frame():
    """Rows come in several frames and out of order; an empty frame for each silent key would cost as much as a full one."""
    frames = lambda *parts: iter([pd.DataFrame(p, columns=["t", "s"]) for p in parts])
    sessions = keyed.ArrivalSessions("k", "t", ["s"], 5)
    sessions.open = Held()
    assert list(sessions.handleInputRows(("a",), frames([(3, 2)], [(1, 1)]), None)) == []
    assert sessions.open.now == (1, 3, 2)
    out, = sessions.handleInputRows(("a",), frames([(30, 4), (4, 3)]), None)
    assert out.values.tolist() == [["a", 1, 4, 3]] and sessions.open.now == (30, 30, 1)
    by_name = keyed.ArrivalSessions("k", "t", ["s"], 5)
    by_name.open = Held()
    out, = by_name.handleInputRows((None,), frames([(9, "b")], [(1, "a")], [(2, None)]), None)
    assert out.values.tolist() == [[None, 1, 1, 1]] and by_name.open.now == (9, 9, 2)
    counts = keyed.RecentCount("k", "t", "s", 10, threshold=3)
    counts.recent = Held()
    counts.recent.now = []
    assert list(counts.handleInputRows(("a",), frames([(3, 2)], [(1, 1)]), None)) == []
    out, = counts.handleInputRows(("a",), frames([(20, 9), (4, 5)]), None)
    assert out.values.tolist() == [["a", 4, 5, 3]] and counts.recent.now == [(20, 1)]
