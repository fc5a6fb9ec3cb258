"""Effects of pieces of a busy stretch on a token bucket's credit, and their composition."""

import random

import numpy as np
import pytest

from millrace.operators import rate_limit as rl


def walked(t, n, credit, capacity, tokens, period):
    """Credit after the last instant, one request at a time."""
    last = t[0]
    for at, many in zip(t, n):
        credit, last = min(capacity * period, credit + (at - last) * tokens), at
        for _ in range(many):
            if credit >= period:
                credit -= period
    return credit


@pytest.mark.parametrize("capacity,tokens,period", [(1, 1, 7), (2, 1, 10), (3, 2, 5), (5, 3, 4), (4, 7, 3), (20, 1, 6)])
def test_effect_equals_walk_for_every_credit(capacity, tokens, period):
    rng = random.Random(capacity * 100 + period)
    for _ in range(60):
        size, gap = rng.randrange(1, 40), rng.choice([1, 3, period, 2 * period])
        t = np.cumsum([rng.randrange(1, gap + 1) for _ in range(size)])
        n = np.array([rng.choice([1, 1, 2, capacity, 3 * capacity]) for _ in range(size)])
        effect, cut = rl._Effect(capacity, tokens, period), rng.randrange(size + 1)
        effect.feed(t[:cut], n[:cut])
        effect.feed(t[cut:], n[cut:])
        lo, val, slope = effect.steps()
        for credit in range(capacity * period + 1):
            i = int(np.searchsorted(lo, credit, side="right")) - 1
            closing = val[i] + slope[i] * (credit - lo[i])  # at effect.last; instants after it had no token to give
            closing = min(capacity * period, closing + int(t[-1] - effect.last) * tokens)
            assert closing == walked(t.tolist(), n.tolist(), credit, capacity, tokens, period)


def test_steps_stay_few():
    """Each step is a different number of whole tokens, so the steps follow the capacity and not the instants."""
    rng = random.Random(3)
    for capacity in (1, 2, 8, 64):
        effect, most, at = rl._Effect(capacity, 1, 1_000_000), 0, 0
        for _ in range(1500):
            at += rng.randrange(1, 2_000_000)
            effect.feed(np.array([at]), np.array([rng.randrange(1, 3)]))
            most = max(most, len(effect.lo))
        assert most <= 4 * capacity + 4


@pytest.mark.parametrize("kind", ["long", "double"])
def test_hot_key_without_a_pause(spark, kind, monkeypatch):
    rng = random.Random(11)
    rows, seq = [], 0
    for key, size in (("hot", 400), (None, 300), ("cool", 30)):
        at = 0
        for _ in range(size):
            at += rng.choice([0, 1, 2, 5]) if key != "cool" else rng.choice([1, 60])
            rows.append((key, at if kind == "long" else at / 2, seq))
            seq += 1
    df = spark.createDataFrame(rows, f"k string, t {kind}, seq long").repartition(4)
    found, inner = [], rl._openings
    monkeypatch.setattr(rl, "_openings", lambda *a: (found.append(a[0]), inner(*a))[1])
    want = sorted(map(tuple, rl.token_bucket(df, ["k"], "t", "seq", 3, 1, 9).collect()), key=lambda r: r[2])
    assert not found
    got = sorted(map(tuple, rl.token_bucket(df, ["k"], "t", "seq", 3, 1, 9, hot_rows=20, piece_rows=30).collect()), key=lambda r: r[2])
    assert got == want and len(got) == len(rows) and 0 < sum(r[3] for r in got) < len(rows)
    pieces = found[0].groupBy("k").agg({"_piece": "max"}).collect()
    assert found[0].select("_piece").distinct().count() >= 8 and {r[0] for r in pieces} >= {"hot", None}
