"""Exact dedup, chat snapshots, url rules, mixing, language ID and quality on small tables."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm.chat import render_chats
from millrace.llm.exact_dedup import build_index, exact_dedup, grow, mark_duplicates
from millrace.llm.language_id import Compressors, accepted, predict_languages, train_dictionaries
from millrace.llm.mixing import Targets, calibrated, missing_share, rake, sample_mixture, sampling_table
from millrace.llm.quality import isotonic, score_quality, statistics
from millrace.llm.url_filter import judge_urls, labelled_urls


# -- exact dedup

ROWS = [(1, "a"), (2, "a"), (3, "b"), (4, None), (5, ""), (None, "a"), (None, "z"), (2, "a"), (6, "x" * 300_000),
        (7, "x" * 300_000), (8, "A"), (9, "a ")]


def expected(rows):
    out = []
    for i, t in rows:
        same = [j for j, u in rows if (u or "") == (t or "")]
        keep = max((j for j in same if j is not None), default=None)
        out.append((i, keep, len(same), hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("key,rows_per_bucket", [(None, 500), (None, 1), ("weak", 1), ("same", 2)])
def test_exact(spark, key, rows_per_bucket):
    """Also with a key that collides often, or always."""
    key = {"weak": F.shiftleft(F.length("text").cast("long") % 3, 62), "same": F.lit(0).cast("long")}.get(key)
    docs = spark.createDataFrame([(i, t, "k", 1) for i, t in ROWS], "doc_id long, text string, key string, bucket int")
    got = exact_dedup(docs, key=key, bucket_rows=rows_per_bucket, max_depth=6).collect()
    assert sorted([(r[0], r[1], r[2], r[4]) for r in got], key=str) == expected(ROWS)
    kept = Counter(r["text_sha256"] for r in got if r["kept"])
    assert set(kept.values()) == {1} and len(kept) == len({t or "" for _, t in ROWS})
    assert all(r["doc_id"] == r["keep_id"] for r in got if r["kept"])


def test_exact_empty_and_index(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert exact_dedup(empty).count() == 0
    docs = spark.createDataFrame([(i, f"t{i % 40}") for i in range(400)], "doc_id long, text string")
    index = build_index(docs, bucket_rows=20)
    assert index.count() == 40 and index.select("bucket").distinct().count() > 8
    assert mark_duplicates(docs, index).where("kept").count() == 40


def test_directory():
    rng = np.random.default_rng(1)
    cells = rng.integers(0, 9, 256)
    cells[77] = 5000
    d = grow(cells, 40)
    keys = np.repeat(np.arange(256, dtype=np.uint64), cells) << np.uint64(56)
    load = np.bincount(d.bucket(keys))
    assert d.depth == 8 and load.max() >= 5000 and (np.sort(load)[:-1] <= 40).all()
    assert grow(np.array([3]), 5).depth == 0
    for b in range(d.slots.max() + 1):  # every bucket is one key range
        at = np.flatnonzero(d.slots == b)
        assert len(at) and at[-1] - at[0] == len(at) - 1


# -- chat

def chats(spark, rows):
    return spark.createDataFrame([(c, t, r, x, "e", 0) for c, t, r, x in rows],
                                 "conv_id long, turn long, role string, text string, pos string, part int")


def plain_chats(rows, part):
    convs = {}
    for c, t, r, x in rows:
        convs.setdefault(c, []).append((t is None, t or 0, r or "unknown", x or ""))
    convs = {c: tuple((r, x) for _, _, r, x in sorted(v)) for c, v in convs.items()}
    out = set()
    for c, v in convs.items():
        if any(len(w) > len(v) and w[:len(v)] == v for w in convs.values()):
            continue
        same = [d for d, w in convs.items() if w == v]
        if c != min((d for d in same if d is not None), default=None):
            continue
        for p in range(0, len(v), part):
            out.add((c, p // part, len(v), len(same), "".join(f"<|{r}|>\n{x}\n<|end|>\n" for r, x in v[p:p + part])))
    return out


@pytest.mark.parametrize("hot_rows", [None, 30])
def test_chats(spark, hot_rows):
    rng, rows = random.Random(4), []
    for c in range(30):
        n = rng.randrange(1, 6)
        rows += [(c, i, rng.choice(["user", "assistant"]), rng.choice("ab")) for i in range(n)]
    rows += [(100, i, "user", f"t{i}") for i in range(60)] + [(101, i, "user", f"t{i}") for i in range(20)]
    rows += [(102, None, None, None), (None, 1, "user", "only"), (103, 5, "user", "x"), (103, 5, "user", "x")]
    got = {tuple(r) for r in render_chats(chats(spark, rows), part_turns=7, hot_rows=hot_rows).select(
        "conv_id", "part", "turns", "copies", "rendered").collect()}
    assert got == plain_chats(rows, 7)
    assert render_chats(chats(spark, [])).count() == 0


# -- urls

def test_urls(spark):
    urls = ["http://example.com/en/a", "http://www.example.com/en/a", "HTTP://X.Example.COM/de/?q=/en/", "http://a.net/es/x",
            "http://a.net/es", "http://net/fr/", "http://notexample.com/en/", "https://example.com", None, "", "no url",
            "x://com/://y", "http://a.com#/en/", "http://ÀB.org/p?x", "http://casino-poker.org/", "http://library.org/en/7"]
    pages = spark.createDataFrame([(i, u, "h", "p", "w") for i, u in enumerate(urls)] + [(0, urls[0], "h", "p", "w")],
                                  "page_id long, url string, host string, path string, w string")
    got = {r["page_id"]: r for r in judge_urls(pages).collect()}
    host = [("example.com", "/en/a"), ("www.example.com", "/en/a"), ("x.example.com", "/de/"), ("a.net", "/es/x"),
            ("a.net", "/es"), ("net", "/fr/"), ("notexample.com", "/en/"), ("example.com", ""), ("", ""), ("", ""),
            ("", ""), ("com", "/://y"), ("a.com", ""), ("Àb.org", "/p"), ("casino-poker.org", "/"), ("library.org", "/en/7")]
    rule = ["example.com/en/", "www.example.com/en/", "com/", "net/es/", None, "net/fr/", "com/", None, None, None, None,
            "com/", None, None, None, None]
    assert [(got[i]["host"], got[i]["path"]) for i in range(len(urls))] == host
    assert [got[i]["rule"] for i in range(len(urls))] == rule
    verdicts = {"example.com/en/": "block", "www.example.com/en/": "allow", "com/": "allow", "net/es/": "block",
                "net/fr/": "block"}
    for i, r in enumerate(rule):
        assert got[i]["verdict"] == (verdicts[r] if r else "block" if got[i]["score"] >= 0.5 else "allow")
    assert got[14]["verdict"] == "block" and got[15]["verdict"] == "allow"
    assert judge_urls(pages).count() == len(urls) + 1
    assert judge_urls(pages.limit(0)).count() == 0
    nothing = labelled_urls(spark).limit(0)
    assert {r["score"] for r in judge_urls(pages, nothing).collect()} == {0.5}


def test_url_model_learns(spark):
    """Labelled urls are told apart, unseen combinations of known words too."""
    pages = labelled_urls(spark).select(F.monotonically_increasing_id().alias("page_id"), "url", "blocked")
    got = judge_urls(pages, rules=[]).join(pages, "page_id")
    wrong = got.where((F.col("verdict") == "block") != (F.col("blocked") == 1)).count()
    assert wrong <= 0.02 * pages.count()
    new = spark.createDataFrame([(1, "https://best-casino-slots.example.org/de/4"), (2, "https://museum-river.example.org/de/4")],
                                "page_id long, url string")
    assert [r["verdict"] for r in judge_urls(new, rules=[]).orderBy("page_id").collect()] == ["block", "allow"]


# -- mixing

def mixed(spark, rows):
    return spark.createDataFrame([(i, t, la, s, "d", 7) for i, t, la, s in rows],
                                 "doc_id long, text string, lang string, source string, doc string, tokens int")


def test_rake_meets_all_marginals(spark):
    rng = random.Random(6)
    cells = [(f"s{i}", la, t, rng.randrange(1, 10_000)) for i in range(5) for la in ("en", "de") for t in ("x", "y", "z")]
    targets = Targets({"source": {f"s{i}": i + 1.0 for i in range(5)}, "lang": {"en": 1.0, "de": 3.0}}, {"topic": 0.0})
    out = rake(spark.createDataFrame(cells, "source string, lang string, topic string, tokens long"), targets, 40).toPandas()
    whole = out.weight.sum()
    assert abs(whole - out.tokens.sum()) < 1
    for dim, want in (("source", {f"s{i}": (i + 1) / 15 for i in range(5)}), ("lang", {"en": 0.25, "de": 0.75}),
                      ("topic", {t: 1 / 3 for t in "xyz"})):
        got = out.groupby(dim).weight.sum() / whole
        assert all(abs(got[v] - s) < 1e-6 for v, s in want.items())


def test_sampling(spark):
    rng = random.Random(7)
    rows = [(i, " ".join(["w"] * rng.randrange(1, 30)), rng.choice(["en", "en", "de"]), rng.choice("aaab")) for i in range(4000)]
    targets = Targets({"source": {"a": 0.5, "b": 0.5}, "lang": {"en": 0.5, "de": 0.5}}, {})
    taken = sample_mixture(mixed(spark, rows), targets=targets)
    assert taken.columns == mixed(spark, rows).columns
    got = taken.toPandas()
    n = got.text.str.count("w")
    assert abs(n[got.source == "a"].sum() / n.sum() - 0.5) < 0.05 and abs(n[got.lang == "en"].sum() / n.sum() - 0.5) < 0.05
    assert set(got.doc_id) == set(sample_mixture(mixed(spark, rows).repartition(3), targets=targets).toPandas().doc_id)


def test_one_tiny_source_does_not_shrink_the_sample(spark):
    rng = random.Random(9)
    rows = [(i, "w " * 50, rng.choice(["en", "en", "de"]), rng.choice("aaab")) for i in range(3000)]
    few, n = [(9001, "w " * 5, "en", "own")], 3000 * 50

    def kept(rows, **how):
        return sampling_table(mixed(spark, rows), **how).where("kept").agg(F.sum("tokens")).first()[0] / n
    alone, beside = kept(rows), kept(rows + few)
    assert alone > 0.6 and abs(alone - beside) < 0.05
    assert kept(rows + few, unreached=0) < 0.2  # by the largest ratio
    assert abs(kept(rows + few, size=0.3 * n) - 0.3) < 0.03


def test_cells_that_are_too_small_are_taken_whole_and_reported(spark):
    cells = [(s, la, "general", n) for s, la, n in (("a", "en", 6000), ("a", "de", 3000), ("b", "en", 900), ("b", "de", 100))]
    frame = spark.createDataFrame(cells, "source string, lang string, topic string, tokens long")
    raked = rake(frame, Targets({"source": {"a": 0.5, "b": 0.5}, "lang": {"en": 0.5, "de": 0.5}}, {}))
    out = calibrated(raked, size=1800).toPandas()  # 450 of b x de are wanted, 100 are there
    got = out.set_index(["source", "lang"]).taken
    assert abs(got["b", "de"] - 100) < 1e-6 and abs(got["b", "en"] - 800) < 10
    assert abs(got["a"].sum() - 900) < 10 and abs(out[out.lang == "de"].taken.sum() - 900) < 10
    assert missing_share(calibrated(raked, size=1800)) < 0.01
    assert abs(missing_share(calibrated(raked, size=4000)) - 0.25) < 0.02  # all 1000 of b, 2000 are wanted
    assert 0 < missing_share(calibrated(raked)) <= 0.011


def test_sampling_odd_rows(spark):
    rows = [(1, None, None, None), (2, "", "en", "a"), (3, " \n", "en", "a"), (None, "word", None, "a"),
            (4, "word " * 50_000, "en", "b"), (4, "word " * 50_000, "en", "b"), (5, "mail@x.y", "de", "a")]
    out = sampling_table(mixed(spark, rows)).toPandas()
    assert len(out) == len(rows)
    assert (out.probability[out.tokens == 0] == 1).all() and out.kept[out.tokens == 0].all()
    assert out.probability.between(0, 1).all() and out.probability.max() == 1
    assert set(out.topic) == {"general", "contact"} and set(out.source) == {"a", "b", "unknown"}
    assert sampling_table(mixed(spark, [])).count() == 0
    never = sampling_table(mixed(spark, rows), targets=Targets({"source": {"b": 1.0}}, {})).toPandas()
    assert not never.kept[(never.source == "a") & (never.tokens > 0)].any()


# -- language ID

WORDS = {"xx": "mora tiluna sevati ponuri galeso", "yy": "krschen blunft dorgsch zwenk hrapft"}


def language_docs(spark, n=80):
    rng, rows = random.Random(3), []
    for i in range(n):
        la = "xx" if i % 2 else "yy"
        rows.append((i, " ".join(rng.choice(WORDS[la].split()) for _ in range(40)), la))
    return rows, spark.createDataFrame([(*r, "s", 1.0) for r in rows],
                                       "doc_id long, text string, lang string, lang_pred string, score double")


def test_language(spark):
    rows, docs = language_docs(spark)
    contents = train_dictionaries(docs)
    assert list(contents) == ["xx", "yy"]
    out = predict_languages(docs, contents)
    assert all(r["lang_pred"] == r["doc"]["lang"] and not r["rejected"] and 0.5 < r["score"] <= 1 for r in out.collect())
    odd = spark.createDataFrame([(1, None, None), (2, "", "xx"), (3, "12 % 4", "xx"), (None, WORDS["xx"], None),
                                 (5, "mora " * 100_000, "zz"), (5, "Krschen BLUNFT", "xx")],
                                "doc_id long, text string, lang string")
    got = [tuple(r) for r in predict_languages(odd, contents).select("doc.doc_id", "lang_pred", "rejected").collect()]
    assert got == [(1, "und", True), (2, "und", True), (3, "und", True), (None, "xx", False), (5, "xx", False),
                   (5, "yy", False)]
    kept = accepted(docs)
    assert kept.columns == docs.columns and kept.count() == len(rows)
    assert accepted(docs.limit(0)).count() == 0
    assert predict_languages(odd, {}).where("lang_pred != 'und' or not rejected").count() == 0


def test_dictionaries_never_read_the_held_out_fold(spark):
    rows, docs = language_docs(spark)
    fold = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 5 == 0]
    assert fold
    other = docs.withColumn("text", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, "poison")
                            .otherwise(F.col("text")))
    assert train_dictionaries(other) == train_dictionaries(docs)


def test_whole_texts_are_compressed():
    model = Compressors({k: (f" {v} " * 20).encode() for k, v in WORDS.items()})
    head = WORDS["xx"] + " "
    assert model.predict(head * 50 + (WORDS["yy"] + " ") * 400)[0] == "yy"


# -- quality

def quality_docs(spark):
    rng, rows, labels = random.Random(1), [], []
    for i in range(600):
        good = i % 3 > 0
        words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 9))) for _ in range(60)]
        rows.append((i, " ".join(words) + "." if good else "!! ".join(w.upper() for w in words), "x"))
        labels.append((i, int(good), None))
    schema = "doc_id long, text string, stats string"
    return spark.createDataFrame(rows, schema), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_quality(spark):
    docs, labels = quality_docs(spark)
    out = score_quality(docs, labels).toPandas().sort_values("doc_id")
    held = out[out.held_out]
    assert set(held.doc_id) == {i for i in range(600) if zlib.crc32(str(i).encode()) % 5 == 0}
    assert ((held.doc_id % 3 > 0).astype(int) == held.predicted).all()
    assert out.score.between(0, 1).all() and ((out.score >= 0.3).astype(int) == out.predicted).all()
    flipped = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0,
                                                  1 - F.col("quality")).otherwise(F.col("quality")))
    again = score_quality(docs, flipped).toPandas().sort_values("doc_id")
    assert np.allclose(out.score, again.score, atol=1e-6)  # held-out labels teach nothing


def test_quality_odd_rows(spark):
    docs, labels = quality_docs(spark)
    odd = spark.createDataFrame([(1, None, "s"), (2, "", "s"), (None, "text", "s"), (3, "x" * 400_000, "s"), (3, "x", "s")],
                                docs.schema)
    out = score_quality(docs.union(odd), labels).toPandas()
    assert len(out) == 605 and out.score.notna().all()
    none = score_quality(docs, labels.limit(0)).toPandas()
    assert (none.score == 0.5).all()
    bad = labels.withColumn("quality", F.lit(7))
    assert (score_quality(docs, bad).toPandas().score == 0.5).all()
    assert score_quality(docs.limit(0), labels).count() == 0
    ones = score_quality(docs, labels.withColumn("quality", F.lit(1))).toPandas()
    assert (ones.score > 0.9).all()


def test_isotonic():
    x, y = isotonic(np.arange(6.0), np.array([0, 3, 1, 2, 9, 10.0]), np.array([10.0] * 6))
    assert (np.diff(y) > 0).all() and np.allclose(y, [0, 0.2, 0.9, 1.0])
    assert np.allclose(x, [0, 2, 4, 5])


def test_statistics():
    assert not statistics(None).any() and not statistics(b"").any()
    assert np.isfinite(statistics(b" \n ")).all() and np.isfinite(statistics("é|A9!".encode())).all()


def test_sample_shares(spark):
    """Also shares far below a millionth choose rows; a share of one chooses all."""
    from millrace.llm.sampling import in_sample
    keys = spark.range(200_000).select(F.xxhash64("id").alias("h"))
    assert keys.where(in_sample(F.col("h"), 1.0)).count() == 200_000
    assert 300 < keys.where(in_sample(F.col("h"), 0.002)).count() < 500
    tiny = spark.range(1).select(in_sample(F.lit(5).cast("long"), 1e-12).alias("a"), in_sample(
        F.lit(1 << 40).cast("long"), 1e-12).alias("b")).first()
    assert tuple(tiny) == (True, False)


def test_dictionaries_do_not_see_shared_heads(spark):
    """Texts that begin alike fill the dictionary with what follows, and short texts with more texts."""
    from millrace.llm import language_id as li
    rows = [(i, "same licence head " * 100 + f"word{i} " * 400, "en") for i in range(90)]
    rows += [(1000 + i, f"kurz{i} wort", "de") for i in range(600)]
    body = li.train_dictionaries(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert body["en"].count(b"licence") * len("same licence head ") < 0.6 * len(body["en"])
    assert body["de"].count(b"kurz") == li.FILL * li.SAMPLE_DOCS
