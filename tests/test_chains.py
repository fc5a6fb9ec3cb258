"""Pointer doubling: chains of pages and of dependencies."""

import json
import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import graph
from millrace.operators.chains import follow
from millrace.sources import payloads as pay


def test_follow(spark):
    """A long chain, a star, a loop with a tail."""
    links = [(i, i - 1) for i in range(1, 1000)] + [(5000 + i, 999) for i in range(300)]
    links += [(1, 0), (20_001, 20_000), (20_000, 20_002), (20_002, 20_001), (20_003, 20_002)][1:]
    got = {r["node"]: (r["head"], r["distance"]) for r in follow(spark.createDataFrame(links, "node long, up long")).collect()}
    assert len(got) == len(links)
    assert all(got[i] == (0, i) for i in range(1, 1000)) and all(got[5000 + i] == (0, 1000) for i in range(300))
    assert all(got[i][0] is None for i in range(20_000, 20_004))
    assert follow(spark.createDataFrame([], "node long, up long")).collect() == []


def levels(edges):
    parents = {}
    for n, p in edges:
        parents.setdefault(n, set()).add(p)
        parents.setdefault(p, set())
    out = {}
    while len(out) < len(parents):
        out |= {n: 1 + max((out[p] for p in ps), default=-1) for n, ps in parents.items() if n not in out and ps <= out.keys()}
    return out


@pytest.mark.parametrize("seed", range(3))
def test_levels_of_random_graphs(spark, seed):
    rng = random.Random(seed)
    edges = [(n, rng.randrange(max(0, n - 6), n)) for n in range(1, 120) for _ in range(rng.choice([0, 1, 1, 1, 2, 3]))]
    edges += edges[:5]
    got = {r["node"]: r["level"] for r in graph.topo_levels(spark.createDataFrame(edges, "node long, parent long")).collect()}
    assert got == levels(edges)


def test_long_chain_beside_a_wide_graph(spark):
    """Five thousand levels are no rounds of their own."""
    chain = [(i, i - 1) for i in range(1, 5000)]
    wide = [(100_000 + i, 90_000 + i % 7) for i in range(2000)] + [(100_000 + i, 4000) for i in range(0, 2000, 2)]
    df = spark.createDataFrame(chain + wide, "node long, parent long")
    got = {r["node"]: r["level"] for r in graph.topo_levels(df).collect()}
    assert all(got[i] == i for i in range(5000))
    assert all(got[100_000 + i] == (4001 if i % 2 == 0 else 1) for i in range(2000)) and len(got) == 7007


@pytest.mark.parametrize("edges,sample", [
    ([(1, 2), (2, 1)], {"1", "2"}), ([(1, 2), (2, 3), (3, 2), (3, 9), (2, 8)], {"1", "2", "3"}),
    ([(5, 5), (6, 5)], {"5", "6"}), ([(1, 0), (2, 0), (3, 1), (3, 4), (4, 3), (4, 2)], {"3", "4"})])
def test_cycles(spark, edges, sample):
    with pytest.raises(graph.CycleError) as e:
        graph.topo_levels(spark.createDataFrame(edges, "node long, parent long"))
    assert {str(r[0]) for r in e.value.residual.collect()} <= sample and e.value.residual.count() > 0


def landed(spark, chain, records=None):
    rows = [(c, json.dumps({"records": (records or {}).get(c, []), "next_cursor": n})) for c, n in chain]
    return spark.createDataFrame(rows, "cursor string, body string")


def test_first_record_by_chain_place(spark):
    """Cursors whose text order is not the order of the chain; records without the key all stay."""
    chain = [(None, "10"), ("10", "2"), ("2", "1"), ("1", None)]
    records = {"10": [{"id": 7, "name": "first"}, {"name": "x"}], "2": [{"id": 7, "name": "second"}, {"id": 8}],
               "1": [{"id": 8, "name": "late"}, {"name": "y"}], None: [{"name": "x"}]}
    out = pay.page_payload_ingest(landed(spark, chain[::-1], records).repartition(3), "cursor", "body", dedup_on="id").collect()
    assert sorted(((r["page"], r["id"], r["name"]) for r in out), key=str) == sorted([
        ("10", 7, "first"), ("10", None, "x"), ("2", 8, None), ("1", None, "y"), (None, None, "x")], key=str)
    places = {r["page"]: r["place"] for r in pay.chain_places(spark.createDataFrame(
        [(c or pay.FIRST, n) for c, n in chain], "page string, next string")).collect()}
    assert places == {pay.FIRST: 0, "10": 1, "2": 2, "1": 3}


@pytest.mark.parametrize("chain,told", [
    ([(None, "a"), ("a", "b"), ("b", "a")], "more than one|loop"), ([(None, "a"), ("a", None), ("z", None)], "reaches page z"),
    ([(None, "a"), ("a", None), ("l", "m"), ("m", "l")], "loop"), ([(None, "a"), ("b", "a"), ("a", "")], "more than one")])
def test_broken_chains(spark, chain, told):
    with pytest.raises(pay.BrokenChain, match=told):
        pay.page_payload_ingest(landed(spark, chain), "cursor", "body")


def test_a_page_landed_twice(spark):
    chain = [(None, "a"), ("a", None)]
    out = pay.page_payload_ingest(landed(spark, chain + chain[1:], {"a": [{"id": 1}]}), "cursor", "body")
    assert out.where(F.col("id") == 1).count() == 1


def test_rounds_send_nothing_through_the_driver(spark, monkeypatch):
    """Joins of the rounds are shuffled although these tables are small enough for the planner to broadcast."""
    from millrace.operators import chains, graph

    plans, stage = [], chains.stage_table

    def seen(df, label):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return stage(df, label)

    for module in (chains, graph):
        monkeypatch.setattr(module, "stage_table", seen)
    links = spark.range(1, 9).selectExpr("id AS node", "id - 1 AS up")
    assert {r["node"]: r["distance"] for r in chains.follow(links).collect()} == {i: i for i in range(1, 9)}
    edges = spark.range(2, 40).selectExpr("id AS node", "explode(array(id div 2, id div 3)) AS parent")
    levels = graph.topo_levels(edges)
    assert levels.count() == 40
    assert "BroadcastExchange" not in "".join(plans)
