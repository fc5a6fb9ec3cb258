"""SimHash groups against brute force, components against union-find."""

import random
import re

import numpy as np
import pytest
import xxhash

from millrace.llm.components import connected_components
from millrace.llm.simhash_vp import (build_tree, deal, fingerprint, fitting_leaves, forest, keep_one,
                                     linked_fingerprints, near_duplicates)


def groups(n, pairs):
    up = list(range(n))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i
    for i, j in pairs:
        a, b = find(i), find(j)
        up[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def plain_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in (text or ""))
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", low) if w]
    if not words:
        return 0
    grams = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def test_fingerprint():
    rng = random.Random(5)
    for _ in range(200):
        text = "".join(rng.choice("aAbZÉß\t\n\x0b \x1c,") for _ in range(rng.randrange(60)))
        assert fingerprint(text.encode()) == plain_fingerprint(text)
    long = "one two three four " * 40_000  # beyond one chunk
    assert fingerprint(long.encode()) == plain_fingerprint(long)
    assert fingerprint(None) == fingerprint(b" \n") == 0


@pytest.mark.parametrize("seed,leaves", [(1, 1), (2, 7), (3, 16)])
def test_every_close_pair_meets_in_a_leaf(seed, leaves):
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 1 << 63, 300, np.uint64)
    near = np.concatenate([base ^ (np.uint64(1) << rng.integers(0, 64, 300, np.uint64)) for _ in range(3)])
    fps = np.unique(np.concatenate([base, near]))
    tree, edges = build_tree(fps[::3], leaves), []
    seen = np.zeros(len(fps), int)

    def put(leaf, at, home):
        seen[at[home]] += 1
        a, b = forest(fps[at[home]], fps[at[~home]], 2)
        edges.extend(zip(a.tolist(), b.tolist()))
    deal(tree, fps, 2, put)
    assert (seen == 1).all()
    place = {f: i for i, f in enumerate(fps.tolist())}
    close = np.argwhere(np.triu(np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 2, 1))
    assert groups(len(fps), close) == groups(len(fps), [(place[a], place[b]) for a, b in edges])


def test_linked_over_many_leaves(spark):
    rng = np.random.default_rng(9)
    base = rng.integers(-(1 << 63), (1 << 63) - 1, 500)
    fps = sorted({int(x) for x in base} | {int(x ^ 5) for x in base[:80]} | {int(x ^ 1) for x in base[40:120]}
                 | {int(base[7] ^ (1 << i)) for i in range(63)})
    got = dict(map(tuple, linked_fingerprints(spark.createDataFrame([(f,) for f in fps], "fp long"),
                                              leaf_rows=40, sample_rows=200).collect()))
    u = np.array(fps, np.int64).view(np.uint64)
    want = groups(len(fps), np.argwhere(np.triu(np.bitwise_count(u[:, None] ^ u[None, :]) <= 2, 1)))
    size = {r: want.count(r) for r in want}
    assert set(got) == {f for f, r in zip(fps, want) if size[r] > 1}
    assert len({(r, got[f]) for f, r in zip(fps, want) if f in got}) == len({r for r in want if size[r] > 1})


def close_cloud(seed):
    """Scattered fingerprints, pairs, and a dense ball whose members nearly all visit both sides of a cut."""
    rng = np.random.default_rng(seed)
    base = rng.integers(-(1 << 63), (1 << 63) - 1, 700)
    ball = {int(base[7] ^ (1 << i) ^ (1 << j)) for i in range(24) for j in range(i, 24)}
    return sorted({int(x) for x in base} | {int(x ^ 5) for x in base[:90]} | ball)


@pytest.mark.parametrize("leaf_rows,group_rows", [(16, 120), (200, 60), (1, 40)])
def test_overfull_leaves_are_dealt_again(spark, leaf_rows, group_rows):
    """A tree of two leaves from a sample of 40; the rest of the dealing is left to the overfull leaves."""
    fps = close_cloud(4)
    distinct = spark.createDataFrame([(f,) for f in fps], "fp long")
    got = dict(map(tuple, linked_fingerprints(distinct, leaf_rows=leaf_rows, sample_rows=40,
                                              group_rows=group_rows).collect()))
    u = np.array(fps, np.int64).view(np.uint64)
    want = groups(len(fps), np.argwhere(np.triu(np.bitwise_count(u[:, None] ^ u[None, :]) <= 2, 1)))
    size = {r: want.count(r) for r in want}
    assert set(got) == {f for f, r in zip(fps, want) if size[r] > 1}
    assert len({(r, got[f]) for f, r in zip(fps, want) if f in got}) == len({r for r in want if size[r] > 1})


def test_fitting_leaves_are_bounded_and_whole(spark):
    fps = close_cloud(5)
    dealt = spark.createDataFrame([(0, f, True) for f in fps], "leaf long, fp long, home boolean")
    rows = [tuple(r) for r in fitting_leaves(dealt, 2, 32, 150).collect()]
    assert {f for _, _, f, home in rows if home} == set(fps)
    home = {}
    for leaf, _, f, own in rows:
        if own:
            assert home.setdefault(f, leaf) == leaf  # members have one leaf, though several pieces
    total, members = {}, {}
    for leaf, piece, _, own in rows:
        total[leaf, piece] = total.get((leaf, piece), 0) + 1
        members[leaf, piece] = members.get((leaf, piece), 0) + own
    crowded = {k for k, n in total.items() if members[k] > 32 and n > 150}
    assert not crowded and max(total.values()) <= 32 + 2 * 150
    assert len({leaf for leaf, _ in total}) > 16  # more than one round


def test_components(spark):
    rng = random.Random(3)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(0, 300 + i) for i in range(200)]
    pairs += [(600 + i, 601 + i) for i in range(60)]  # a chain
    want = groups(700, pairs)
    got = dict(map(tuple, connected_components(spark.createDataFrame(pairs, "a long, b long")).collect()))
    linked = {x for p in pairs if p[0] != p[1] for x in p}
    assert got == {i: want[i] for i in linked}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


ROWS = [(1, "alpha beta gamma delta"), (2, "ALPHA beta\tgamma delta"), (3, None), (4, ""), (5, " \n "), (6, "lone"),
        (None, "alpha beta gamma delta"), (7, "quite another text with other words in it"), (7, "lone"), (6, "lone")]


def test_near_duplicates_odd_rows(spark):
    docs = spark.createDataFrame([(i, t, "x", 9, "y") for i, t in ROWS],
                                 "doc_id long, text string, fp string, component_id int, least string")
    got = {(r["doc_id"], r["fp"], r["component_id"]) for r in near_duplicates(docs).collect()}
    fps = [plain_fingerprint(t) for _, t in ROWS]
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    root = groups(len(ROWS), [(i, j) for i in range(len(ROWS)) for j in range(i) if bin(fps[i] ^ fps[j]).count("1") <= 2])
    ids = {r: min(i for (i, _), q in zip(ROWS, root) if q == r and i is not None) for r in root}
    assert got == {(i, s, ids[r]) for (i, _), s, r in zip(ROWS, signed, root)}
    assert near_duplicates(docs).count() == len(ROWS)
    kept = keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 3, 6, 7]
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert near_duplicates(empty).count() == 0 and keep_one(empty).count() == 0


def test_query_against_brute_force(spark):
    """All documents of the smallest tables."""
    from pathlib import Path

    from millrace.llm.queries import QUERIES
    folder = "/root/testdata/sf0.001"
    if not Path(folder).exists():
        pytest.skip("no test tables")
    docs = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    fps = np.array([plain_fingerprint(t) for _, t in docs], np.uint64)
    root = groups(len(docs), np.argwhere(np.triu(np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 2, 1)))
    least = {r: min(i for (i, _), q in zip(docs, root) if q == r) for r in set(root)}
    want = {(i, f"{int(f):016x}", least[r]) for (i, _), f, r in zip(docs, fps, root)}
    assert {tuple(r) for r in QUERIES["op9_simhash_near_dedup"](spark, folder).collect()} == want
