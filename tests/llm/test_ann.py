"""Nearest neighbours against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import ann


def table(spark, ids, vectors, kind="float"):
    rows = [(i, None if v is None else [None if x is None else float(x) for x in v], "c", 3) for i, v in zip(ids, vectors)]
    return spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, cell string, n int")


def brute(ids, x, asked, k):
    out = {}
    for q in asked:
        at = ids.index(q)
        d = np.sqrt(((x - x[at]) ** 2).sum(1))
        out[q] = [(float(d[j]), ids[j]) for j in np.lexsort((ids, d)) if ids[j] != q][:k]
    return out


def found(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["query_id"], []).append((r["rank"], r["score"], r["id"]))
    assert all([x[0] for x in sorted(v)] == list(range(1, len(v) + 1)) for v in out.values())
    return {q: [x[1:] for x in sorted(v)] for q, v in out.items()}


@pytest.mark.parametrize("kind,clusters", [("float", 0), ("double", 30)])
def test_recall(spark, kind, clusters):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, 40))
    if clusters:
        x = rng.normal(size=(clusters, 40))[rng.integers(0, clusters, 3000)] * 4 + x
    x = x.astype(np.float32).astype(float)
    ids = list(range(3000))
    got = found(ann.nearest(table(spark, ids, x, kind), F.col("vec_id") % 100 == 0))
    want = brute(ids, x, range(0, 3000, 100), 10)
    assert set(got) == set(want)
    hits = sum(len({i for _, i in got[q]} & {i for _, i in want[q]}) for q in want)
    assert hits >= 0.93 * 300
    for q, v in got.items():
        assert len(v) == 10 and all(abs(s - np.sqrt(((x[q] - x[i]) ** 2).sum())) < 1e-12 for s, i in v)


def test_all_lists_and_many_copies(spark, monkeypatch):
    """Every list probed: exact, also with one vector in a third of the rows and small chunks."""
    monkeypatch.setattr(ann, "CHUNK_ROWS", 64)
    monkeypatch.setattr(ann, "QUERY_BLOCK", 7)
    rng = np.random.default_rng(5)
    x = rng.normal(size=(900, 20)).astype(np.float32).astype(float)
    x[::3] = x[0]
    ids = rng.permutation(900).tolist()
    frame = table(spark, ids, x)
    every = ann.usable_vectors(frame, "vec_id", "embedding", (F.col("vec_id") % 50 == 0).alias("asked"))
    model = ann.fit(every, 900, 10)
    index = ann.build_index(every.select("id", "vector"), model)
    assert index.agg(F.sum("n"), F.max("n")).first() == (900, 64)
    got = found(ann.search(every.where("asked"), index, model, 10, probes=len(model.centroids)))
    want = brute(ids, x, [i for i in ids if i % 50 == 0], 10)
    assert {q: [i for _, i in v] for q, v in got.items()} == {q: [i for _, i in v] for q, v in want.items()}


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    ids = [0, 1, 2, 3, 4, 5, 6, 100, 100, None, 200, 7]
    vectors = [[1, 0], [0, 0], None, [nan, 1], [inf, 1], [None, 1], [1, 2, 3], [2, 0], [2, 1], [5, 5], [0, 3], []]
    got = found(ann.nearest(table(spark, ids, vectors), F.col("vec_id") % 100 == 0))
    assert got == {0: [(1.0, 100), (np.sqrt(2), 100), (np.sqrt(10), 200)], 100: [(1.0, 0), (np.sqrt(13), 200)],
                   200: [(np.sqrt(8), 100), (np.sqrt(10), 0), (np.sqrt(13), 100)]}
    assert ann.nearest(table(spark, [], []), F.col("vec_id") % 100 == 0).count() == 0
    one = ann.nearest(table(spark, [0], [[1, 2]]), F.col("vec_id") % 100 == 0)
    assert one.count() == 0


def test_scan_abandons_nothing_that_matters():
    rng = np.random.default_rng(3)
    raw = rng.normal(size=(2000, 64))
    turn = np.linalg.qr(rng.normal(size=(64, 64)))[0]
    turned = (raw @ turn).astype(np.float32)
    blocks = [turned[:, b:b + 16] for b in range(0, 64, 16)]
    ids, hits = np.arange(2000), 0
    for q in range(50):
        at, d = ann.adaptive_scan(raw[q], turned[q], q, ids, blocks, raw, 10)
        want = np.sqrt(((raw - raw[q]) ** 2).sum(1))
        want[q] = np.inf
        hits += len(set(at) & set(np.argsort(want)[:10]))
    assert hits >= 490


def test_search_broadcasts_nothing(spark, monkeypatch):
    """A few queries look small, times the lists they probe they are not: no side of the join goes through the driver."""
    x = np.random.default_rng(7).normal(size=(3000, 16))
    staged, key = {}, "spark.sql.execution.arrow.maxBytesPerBatch"
    before, stage = spark.conf.get(key), ann.stage_table
    monkeypatch.setattr(ann, "stage_table", lambda df, label: staged.setdefault(label, df) and stage(df, label))
    last = ann.nearest(table(spark, range(3000), x), F.col("vec_id") % 100 == 0)
    assert spark.conf.get(key) == before and last.count() == 300
    hits = staged.get("hits", last)
    assert len(hits.collect()) == 300
    plan = hits._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "isFinalPlan=true" in plan and "SortMergeJoin" in plan and "Broadcast" not in plan


def test_folds_and_groups_lose_nothing(spark, monkeypatch):
    """Every list probed: exact where hits are folded and given out often, whatever the number of groups."""
    monkeypatch.setattr(ann, "FOLD_ROWS", 40)
    monkeypatch.setattr(ann, "CHUNK_ROWS", 50)
    x = np.random.default_rng(8).normal(size=(700, 12)).astype(np.float32).astype(float)
    ids = list(range(700))
    every = ann.usable_vectors(table(spark, ids, x), "vec_id", "embedding", (F.col("vec_id") % 20 == 0).alias("asked"))
    model = ann.fit(every, 700, 10)
    index = ann.build_index(every.select("id", "vector"), model)
    want = brute(ids, x, range(0, 700, 20), 10)
    for groups in (1, 4, 1000):
        monkeypatch.setattr(ann, "GROUPS", groups)
        got = found(ann.search(every.where("asked"), index, model, 10, probes=len(model.centroids)))
        assert {q: [i for _, i in v] for q, v in got.items()} == {q: [i for _, i in v] for q, v in want.items()}


def test_blocks_of_queries_are_scanned_as_one_query_is(monkeypatch):
    """Own ids left out, ties by id, few rows, pairs in place of whole blocks of dimensions."""
    rng = np.random.default_rng(9)
    turn = np.linalg.qr(rng.normal(size=(48, 48)))[0]
    for n, copies, spread in ((5, 1, 0), (10, 1, 0), (11, 1, 0), (400, 130, 0), (600, 1, 40)):
        raw = rng.normal(size=(n, 48)) + spread * rng.normal(size=(6, 48))[rng.integers(0, 6, n)]
        raw[:copies] = raw[0]
        raw, ids = raw.astype(np.float32), rng.permutation(n)
        turned = (raw @ turn).astype(np.float32)
        blocks = [np.ascontiguousarray(turned[:, b:b + 16]) for b in range(0, 48, 16)]
        asks = np.arange(0, n, 3)
        q = raw[asks].astype(float)
        for sparse in (1, 10 ** 9):
            monkeypatch.setattr(ann, "SPARSE", sparse)
            row, at, d = ann.adaptive_scans(q, turned[asks], ids[asks], ids, blocks, raw, 10)
            for i, a in enumerate(asks):
                want = np.sqrt(((raw.astype(float) - q[i]) ** 2).sum(1))
                order = [j for j in np.lexsort((ids, want)) if j != a][:10]
                alone = ann.adaptive_scan(q[i], turned[a], ids[a], ids, blocks, raw, 10)
                assert len(set(at[row == i]) & set(order)) >= min(9, len(order))
                assert at[row == i].tolist() == alone[0].tolist() and d[row == i].tolist() == want[alone[0]].tolist()


def test_the_best_so_far_spares_the_rest_and_loses_nothing():
    rng = np.random.default_rng(10)
    raw = rng.normal(size=(500, 32)).astype(np.float32)
    ids, q = np.arange(500), rng.normal(size=(7, 32))
    args = (q, q.astype(np.float32), np.full(7, -1), ids, [raw[:, :16], raw[:, 16:]], raw, 10)
    row, at, d = ann.adaptive_scans(*args)
    limit = np.array([d[row == i][3] for i in range(7)])
    kept = d <= limit[row]
    again = ann.adaptive_scans(*args, limit)
    assert all(np.array_equal(x, y[kept]) for x, y in zip(again, (row, at, d)))
    assert len(again[0]) == 28
