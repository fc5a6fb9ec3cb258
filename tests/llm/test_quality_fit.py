"""The quality classifier's fit against numpy: moments, ridge weights, calibration, scores."""

import random
import zlib

import numpy as np
import pytest

from millrace.llm import quality as ql


@pytest.fixture(scope="module")
def table():
    rng = random.Random(21)
    words = "the of river market stone winter reads opens quiet bridge letter and to in harbour".split()
    rows = []
    for i in range(400):
        n = rng.randrange(1, 120)
        if rng.random() < 0.5:
            text = ". ".join(" ".join(rng.choice(words) for _ in range(rng.randrange(3, 12))) for _ in range(1 + n // 10))
            y = 1
        else:
            text = " ".join(rng.choice(["BUY!!!", "$$$", "click", "win", "http://x.y"]) for _ in range(n))
            y = 0
        rows.append((i, text, 1 - y if rng.random() < 0.1 else y))
    return rows


def best_monotone(y, n):
    """Isotonic rates by the max-min formula: no pooling involved."""
    total, rows = np.append(0.0, np.cumsum(y)), np.append(0.0, np.cumsum(n))
    mean = [[(total[b + 1] - total[a]) / (rows[b + 1] - rows[a]) if b >= a else 0 for b in range(len(y))] for a in range(len(y))]
    return [max(min(mean[a][b] for b in range(i, len(y))) for a in range(i + 1)) for i in range(len(y))]


def test_fit_equals_numpy(spark, table):
    docs = spark.createDataFrame([(i, t) for i, t, _ in table], "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(i, y) for i, _, y in table], "doc_id long, quality int")
    model = ql.train(ql.document_statistics(docs), labels)
    x = np.array([ql.statistics(t.encode()) for _, t, _ in table])
    y = np.array([v for *_, v in table], float)
    folds = np.array([zlib.crc32(str(i).encode()) % 5 for i, *_ in table])
    fit, cal = folds > 1, folds == 1
    spread = x[fit].std(axis=0)
    assert model.mean == pytest.approx(x[fit].mean(axis=0), rel=1e-9, abs=1e-12)
    assert model.scale == pytest.approx(np.where(spread > 1e-9, spread, 1.0), rel=1e-9)

    def features(s):
        z = np.cos((s - model.mean) / model.scale @ model.waves + model.phase) * np.sqrt(2 / ql.FEATURES)
        return np.hstack([z, np.ones((len(z), 1))])

    # Ridge as least squares over rows added for the penalty, instead of normal equations.
    penalty = np.sqrt(ql.RIDGE * fit.sum() / ql.FEATURES) * np.eye(ql.FEATURES + 1)
    beta = np.linalg.lstsq(np.vstack([features(x[fit]), penalty]), np.append(y[fit], np.zeros(ql.FEATURES + 1)), rcond=None)[0]
    assert features(x) @ model.beta == pytest.approx(features(x) @ beta, abs=1e-6)

    bins = np.round(np.clip(features(x[cal]) @ model.beta, -0.5, 1.5) * ql.BINS).astype(int)
    at = np.unique(bins)
    n = np.array([(bins == b).sum() for b in at])
    hits = np.array([y[cal][bins == b].sum() for b in at])
    want = best_monotone(hits, n)
    rates = sorted(set(np.round(want, 9)))
    assert model.rates == pytest.approx(rates, abs=1e-8)
    for rate, knot in zip(rates, model.knots):
        mine = np.abs(np.array(want) - rate) < 1e-8
        assert knot == pytest.approx((at[mine] * n[mine]).sum() / n[mine].sum() / ql.BINS)

    got = {r["doc_id"]: r for r in ql.score_quality(docs, labels).collect()}
    scores = np.interp(np.clip(features(x) @ model.beta, -0.5, 1.5), model.knots, model.rates)
    assert [got[i]["score"] for i, *_ in table] == pytest.approx(scores.tolist(), abs=1e-9)
    assert [got[i]["held_out"] for i, *_ in table] == (folds == 0).tolist()
