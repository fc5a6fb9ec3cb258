"""Chunks, vectors and rankings: literal cases and brute force."""

import hashlib
import math
import random
import re
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from millrace.functions import text as tx
from millrace.functions.vectors import cosine
from millrace.operators import chunking as ch, search as se


def one(spark, text, col):
    return spark.createDataFrame([(text,)], "t string").select(col("t")).first()[0]


def test_sentences_and_estimates(spark):
    assert one(spark, "A b. c。 。d", tx.sentences) == ["A b", "c", "d"]
    assert [one(spark, t, tx.token_estimate) for t in ("", "x" * 20, "x" * 21, "日本語" * 10)] == [5, 5, 6, 8]
    assert one(spark, "The Cat, and the (dog)!", tx.tokenize) == "cat dog"
    assert one(spark, "", tx.tokenize) == ""


@pytest.mark.parametrize("n", [0, 1, 19, 20, 180, 199, 200, 201, 360, 380, 381, 1000])
def test_fixed_chunks(spark, n):
    text = "".join(chr(97 + i % 26) for i in range(n))
    expected, start = [], 0
    while n:
        expected.append(text[start:start + 200])
        if start + 200 >= n:
            break
        start += 180
    assert one(spark, text, tx.fixed_chunks) == expected


def test_fixed_chunk_counts_characters(spark):
    out = ch.fixed_chunk(spark.createDataFrame([(1, "日𠮷" * 150, "s")], "id int, t string, src string"), "t", "src").collect()
    assert [(r["chunk_id"], len(r["content"]), r["source"]) for r in out] == [("chunk_001", 200, "s"), ("chunk_002", 120, "s")]


def test_cut_points_cover_the_text():
    rng = random.Random(1)
    for _ in range(300):
        text = "".join(rng.choice(["a", "b", " ", "\n", "\n\n", "。", "、"]) for _ in range(rng.randrange(0, 400)))
        cuts = list(ch.cut_points(text, 40, 8))
        assert all(b - a <= 40 for a, b in cuts)
        assert cuts[0][0] == 0 and cuts[-1][1] == len(text)
        for (a, b), (c, e) in zip(cuts, cuts[1:]):
            assert a < c <= b < e
            assert b - c <= 8


def test_cut_prefers_strong_separators():
    text = "x" * 30 + "\n\n" + "y" * 5 + " " + "z" * 30
    assert list(ch.cut_points(text, 40, 4))[0] == (0, 32)


@pytest.mark.parametrize("hot", [None, 2])
def test_semantic_chunk(spark, hot):
    data = [(1, 0, "A", [1.0, 0.0]), (1, 1, "B", [1.0, 0.1]), (1, 2, "C", [0.0, 1.0]), (2, 0, "Solo", [1.0, 1.0])]
    df = spark.createDataFrame(data, "doc int, pos int, s string, v array<float>")
    out = ch.semantic_chunk(df, "doc", "pos", "s", "v", hot_rows=hot).collect()
    assert sorted((r["doc"], r["content"]) for r in out) == [(1, "A. B."), (1, "C."), (2, "Solo")]


def test_cosine(spark):
    data = [([1.0, 0.0], [1.0, 1.0]), ([0.0, 0.0], [1.0, 1.0])]
    df = spark.createDataFrame(data, "a array<float>, b array<float>")
    assert [r[0] for r in df.select(cosine("a", "b")).collect()] == [pytest.approx(1 / math.sqrt(2)), 0.0]
    with pytest.raises(Exception, match="differ in size"):
        spark.createDataFrame([([1.0], [1.0, 1.0])], "a array<float>, b array<float>").select(cosine("a", "b")).collect()


def vectors(spark, n=300, dim=8, ids="long"):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(n, dim)).astype(np.float32)
    x[7] = 0
    name = (lambda i: f"c{i:04d}") if ids == "string" else (lambda i: i)
    base = spark.createDataFrame([(name(i), v.tolist()) for i, v in enumerate(x)], f"id {ids}, v array<float>").repartition(5)
    q = spark.createDataFrame([(i, x[i].tolist()) for i in range(0, 300, 50)], "q int, qv array<float>")
    return x, base, q, name


@pytest.mark.parametrize("metric", ["cosine", "l2"])
@pytest.mark.parametrize("ids", ["long", "string"])
def test_vector_topk_brute_force(spark, metric, ids, monkeypatch):
    monkeypatch.setattr(se, "QUERY_BLOCK", 2)
    x, base, q, name = vectors(spark, ids=ids)
    out = se.vector_topk(base, q, "id", "v", "q", "qv", 5, metric)
    got = {}
    for r in sorted(out.collect(), key=lambda r: (r["q"], r["rank"])):
        got.setdefault(r["q"], []).append(r["id"])
    y = x.astype(np.float64)
    for i, ids_found in got.items():
        size = np.linalg.norm(y, axis=1) * np.linalg.norm(y[i])
        s = np.divide(y @ y[i], size, out=np.zeros(len(y)), where=size > 0) if metric == "cosine" else -((y - y[i]) ** 2).sum(axis=1)
        assert ids_found == [name(j) for j in sorted(range(len(y)), key=lambda j: (-round(s[j], 9), j))[:5]]
    assert len(got) == 6


def test_cell_index(spark, monkeypatch):
    monkeypatch.setattr(se, "CELL_FILE_ROWS", 20)
    x, base, q, _ = vectors(spark)
    index = se.CellIndex.build(base, "id", "v", cells=6, iterations=5)
    assert spark.read.parquet(index.path).count() == 300
    exact = {(r["q"], r["rank"]): r["id"] for r in se.vector_topk(base, q, "id", "v", "q", "qv", 5).collect()}
    every = {(r["q"], r["rank"]): r["id"] for r in index.search(q, "q", "qv", 5, nprobe=6).collect()}
    assert every == exact
    few = {(r["q"], r["id"]) for r in index.search(q, "q", "qv", 5, nprobe=2).collect()}
    assert len(few & {(k[0], v) for k, v in exact.items()}) / len(exact) > 0.3


def test_vector_topk_rounds(spark, monkeypatch, capsys):
    """More query vectors than one broadcast may hold: rounds over the base in place, every query answered once."""
    x, base, q, _ = vectors(spark)
    want = sorted(map(tuple, se.vector_topk(base, q, "id", "v", "q", "qv", 5).collect()))
    monkeypatch.setattr(se, "QUERY_BLOCK", 1)
    monkeypatch.setattr(se, "BROADCAST_BYTES", 2 * (8 * 8 + 32))
    monkeypatch.setattr(se, "CHUNK_BYTES", 8 * 8 * 7)
    plans, staged = [], se.stage_table
    monkeypatch.setattr(se, "stage_table", lambda df, label: (plans.append(df) if label == "hits" else None, staged(df, label))[1])
    assert sorted(map(tuple, se.vector_topk(base, q, "id", "v", "q", "qv", 5).collect())) == want
    assert len(plans) == 3
    capsys.readouterr()
    plans[0].explain()
    plan = capsys.readouterr().out
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan
    assert se.vector_topk(base, q.limit(0), "id", "v", "q", "qv", 5).count() == 0


def test_cell_search_reads_probed_cells(spark, capsys):
    x, base, q, _ = vectors(spark)
    index = se.CellIndex.build(base, "id", "v", cells=6, iterations=5)
    index.search(q.where("q = 50"), "q", "qv", 5, nprobe=1).explain()
    plan = capsys.readouterr().out
    assert re.search(r"PartitionFilters: \[[^\]]*cell#\d+ = \d", plan) and "SortMergeJoin" not in plan


@pytest.mark.skipif(not Path("/root/testdata/sf0.001").exists(), reason="no test tables")
def test_ivf_row_against_brute_force(spark):
    from __spark_entry__ import queries
    folder = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").toPandas()
    x, labels = np.stack(rows["embedding"]).astype(np.float64), rows["label"].to_numpy()
    got = queries()["ann_ivf_search"](spark, folder).toPandas()
    recalls = []
    for label, mine in got.groupby("label"):
        probe = x[labels == label].mean(axis=0)
        scores = np.round(x @ probe / np.linalg.norm(x, axis=1) / np.linalg.norm(probe), 9)
        best = sorted(zip(-scores, rows["vec_id"]))[:10]
        mine = mine.sort_values("rank")
        by_id = dict(zip(rows["vec_id"], scores))
        assert list(mine["rank"]) == list(range(1, 11))
        assert [round(by_id[i], 6) for i in mine["vec_id"]] == pytest.approx(list(mine["score"]), abs=2e-6)
        recalls.append(len(set(mine["vec_id"]) & {i for _, i in best}) / 10)
        assert set(mine["recall"]) == {recalls[-1]}
    assert set(got["label"]) == set(labels) and np.mean(recalls) >= 0.9


def test_nearest_matches_topk(spark):
    x, base, q, _ = vectors(spark)
    got = [r["id"] for r in se.nearest(base, "v", x[50].tolist(), 5).collect()]
    assert got == [r["id"] for r in se.vector_topk(base, q.where("q = 50"), "id", "v", "q", "qv", 5).orderBy("rank").collect()]


def test_bm25_brute_force(spark):
    rng = random.Random(9)
    docs = {i: [rng.choice("abcdefgh") for _ in range(rng.randrange(0, 12))] for i in range(60)}
    asked = {0: ["a", "b", "a"], 1: ["h", "zz"]}
    d = spark.createDataFrame(list(docs.items()), "id int, t array<string>")
    q = spark.createDataFrame(list(asked.items()), "q int, terms array<string>")
    got = {(r["q"], r["id"]): r["score"] for r in se.bm25_search(d, q, "id", "t", "q", "terms", 100).collect()}
    n, avg = len(docs), sum(map(len, docs.values())) / len(docs)
    expected = {}
    for qi, terms in asked.items():
        for i, t in docs.items():
            s = 0.0
            for w in set(terms):
                df, tf = sum(w in x for x in docs.values()), t.count(w)
                if tf:
                    s += math.log(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(t) / avg))
            if s:
                expected[qi, i] = pytest.approx(s, abs=1e-8)
    assert got == expected


def rank_rows(lists):
    return [(s, p, d) for s, one in enumerate(lists) for p, d in enumerate(one)]


def test_rrf(spark):
    df = spark.createDataFrame(rank_rows([["A", "B", "C"], ["B", "D", "A"]]), "system int, position int, doc string")
    out = se.rrf_fuse(df, "doc").orderBy(F.col("rrf_score").desc(), "first_system", "first_position").collect()
    assert [r["doc"] for r in out] == ["B", "A", "D", "C"]
    assert [r["rrf_score"] for r in out] == [pytest.approx(s, abs=1e-9) for s in (1 / 62 + 1 / 61, 1 / 61 + 1 / 63, 1 / 62, 1 / 63)]


def test_rrf_duplicates_and_bad_input(spark):
    df = spark.createDataFrame(rank_rows([["A", "A", "B"]]), "system int, position int, doc string")
    assert {r["doc"]: r["rrf_score"] for r in se.rrf_fuse(df, "doc").collect()} == {
        "A": pytest.approx(1 / 61), "B": pytest.approx(1 / 63)}
    with pytest.raises(ValueError):
        se.rrf_fuse(df, "doc", k=-1)
    dirty = spark.createDataFrame(rank_rows([["A", "B", "A"], ["B", " ", "D"]]), "system int, position int, doc string")
    with pytest.raises(Exception, match="blank document id"):
        se.rrf_fuse(dirty, "doc").collect()


def test_candidate_pool_and_rank_compare(spark):
    ranked = lambda ids: spark.createDataFrame([(1, d, i + 1) for i, d in enumerate(ids)], "q int, id string, rank int")
    pool = se.candidate_pool([ranked("abcd"), ranked("bxe"), ranked("ayz")], "q", "id").collect()
    assert sorted((r["id"], r["list"]) for r in pool) == [("a", 0), ("b", 0), ("c", 0), ("e", 1), ("x", 1), ("y", 2), ("z", 2)]
    out = se.rank_compare(ranked("bq"), ranked("abc"), "q", "id", depth=2).collect()
    assert {r["id"]: r["exact_rank"] for r in out} == {"b": "2", "q": ">2"}


def test_chunks_are_stable_and_unique(spark):
    speeches = spark.createDataFrame([("M1", "M1-1", "A", "2026-01-01", "X", "same line\n" * 400),
                                      ("M1", "M1-2", "B", "2026-01-01", "X", "short")],
                                     "issue_id string, speech_id string, speaker string, date string, name_of_meeting string, speech string")
    encoder = ch.hashed_bag_encoder(16)
    one, two = (ch.build_chunks(speeches, encoder).collect() for _ in range(2))
    assert sorted(r["chunk_id"] for r in one) == sorted(r["chunk_id"] for r in two)
    assert len({r["chunk_id"] for r in one}) == len(one) and all(len(r["content"]) <= 2000 for r in one)
    assert all(len(r["vector"]) == 16 for r in one)


def test_query_and_passage_vectors_differ(spark):
    df = spark.createDataFrame([("hello",)], "t string")
    encoder = ch.hashed_bag_encoder(32)
    a, b = (ch.embed_rows(df, "t", encoder, is_query=x).first()["vector"] for x in (True, False))
    assert a != b


def test_embed_rows_near_a_cut(spark, tmp_path):
    """12 of a length whose square is 24395 are 8.00000003 hundredths after the offset; single precision made 7 of it."""
    from millrace.plans.retrieval import embed_rows

    slot = lambda w: int(hashlib.md5(w.encode()).hexdigest()[:8], 16) % 64
    words = {slot("passage:"): "passage:"}
    for i in range(100):
        words.setdefault(slot(f"w{i}"), f"w{i}")
    a, b, c = [w for w in words.values() if w != "passage:"][:3]
    text = " ".join([a] * 12 + [b] * 155 + [c] * 15)
    spark.createDataFrame([(1, text)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = {r["slot"]: r["weight"] for r in embed_rows(spark, str(tmp_path)).collect()}
    assert found[slot(a)] == 8


def test_bm25_pieces_follow_the_pairs(spark, monkeypatch):
    """The pairs of question and document are added up where the words were dealt to, in pieces of bounded size."""
    docs = spark.range(400).select(F.col("id").alias("d"), F.array(F.lit("x"), F.concat(F.lit("y"), F.col("id") % 7)).alias("t"))
    asked = spark.range(10).select(F.col("id").alias("q"), F.array(F.lit("x"), F.concat(F.lit("y"), "id")).alias("w"))
    whole = se.bm25_search(docs, asked, "d", "t", "q", "w", 5)
    monkeypatch.setattr(se, "PIECE_PAIRS", 100)
    cut = se.bm25_search(docs, asked, "d", "t", "q", "w", 5)
    plan = cut._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"RepartitionByExpression \[d#\d+L\], 40", plan)
    physical = cut._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"Exchange hashpartitioning\(q#\d+L, d#\d+L", physical)
    assert sorted(map(tuple, cut.collect())) == sorted(map(tuple, whole.collect()))


def test_recursive_chunks_unpack_few_texts_at_a_time(spark):
    texts = pa.array(["x" * 10_000] * 1000 + [None, ""])
    parts = list(ch.text_slices(texts))
    assert max(p.nbytes for p in parts) <= 1.1 * ch.SLICE_BYTES and sum(map(len, parts)) == len(texts)
    assert list(ch.text_slices(texts.slice(0, 0))) == []
    rows = spark.range(600).select("id", F.when(F.col("id") % 5 > 0, F.repeat(F.lit("ab cd\n"), 2000)).alias("t")).coalesce(1)
    out = rows.select("id", ch.recursive_chunks("t").alias("p")).collect()
    text = "ab cd\n" * 2000
    want = [(a, text[a:b]) for a, b in ch.cut_points(text, ch.RECURSIVE_SIZE, ch.RECURSIVE_OVERLAP)]
    assert all([tuple(p) for p in r["p"]] == (want if r["id"] % 5 else []) for r in out) and len(out) == 600


def word_counts(texts, dim):
    """Hashed counts, word by word."""
    out = np.zeros((len(texts), dim))
    for i, t in enumerate(texts):
        for w in t.lower().split():
            out[i, int(hashlib.md5(w.encode()).hexdigest()[:8], 16) % dim] += 1
    return out


def test_encoder_hashes_each_distinct_word_once(monkeypatch):
    """Also words parted by any Unicode blank, empty texts and no texts at all."""
    hashed = []
    monkeypatch.setattr(ch.hashlib, "md5", lambda b, md5=hashlib.md5: hashed.append(b) or md5(b))
    blanks = [chr(c) for c in range(0x3100) if chr(c).isspace()]
    texts = ["", " ", "The theİ x", *[f"{b}a{b}{b}B x{b}" for b in blanks], "w" * 5000]
    got = ch.hashed_bag_encoder(16, unit=False)(texts)
    assert sorted(hashed).count(b"x") == 1 and len(hashed) <= 7
    monkeypatch.undo()
    assert (got == word_counts(texts, 16)).all() and ch.hashed_bag_encoder(16)([]).shape == (0, 16)


def test_neighbours_are_compared_in_batches(spark):
    """No lambda runs per part of a vector; results equal ``cosine``, nulls and zero vectors included."""
    rng = random.Random(8)
    rows = [(i // 40, i, f"s{i}", None if i % 17 == 0 else [0.0] * 3 if i % 13 == 0 else
             [None if i % 29 == 0 and j == 1 else rng.random() for j in range(3)]) for i in range(200)]
    df = spark.createDataFrame(rows, "doc int, pos int, s string, v array<float>")
    numbered = ch.number_semantic_chunks(df, "doc", "pos", "v", 0.8)
    assert "zip_with" not in numbered._jdf.queryExecution().optimizedPlan().toString()
    pairs = spark.createDataFrame([(a[3], b[3]) for a, b in zip(rows, rows[1:])], "a array<float>, b array<float>")
    near = pairs.select(F.arrow_udf(ch.paired_cosine, "double")("a", "b").alias("got"), cosine("a", "b").alias("want")).collect()
    assert [r["got"] for r in near] == [r["want"] for r in near] and any(r["got"] for r in near)
    cuts = [1 if i % 40 == 0 or near[i - 1]["want"] is None or near[i - 1]["want"] < 0.8 else 0 for i in range(200)]
    want = [sum(cuts[i - i % 40:i + 1]) for i in range(200)]
    assert [r["chunk_index"] for r in numbered.orderBy("pos").collect()] == want


def test_texts_are_tokenized_after_the_shuffle(spark):
    """The shuffle that finds equal pieces carries each text once."""
    kinds = ", ".join(f"{c} string" for c in ("issue_id", "speech_id", "speaker", "date", "name_of_meeting", "speech"))
    built = ch.build_chunks(spark.createDataFrame([("M1", "M1-1", "s", "d", "n", "The cat sat.")], kinds), ch.hashed_bag_encoder(8))
    plan = built._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("Exchange hashpartitioning(chunk_id"):]
    assert "regexp_extract_all" in plan and "regexp_extract_all" not in below
    assert [r["content_tokenized"] for r in built.collect()] == ["cat sat"]
