"""The url filter's regression: numpy over the same n-grams, and words it was not trained on in host and path."""

import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import url_filter as uf


def buckets_of(url, buckets):
    found = re.search(r"://([^/?#]*)([^?#]*)", url or "")
    host, path = (found[1].lower(), found[2]) if found else ("", "")
    out = []
    for tag, text in (("h", f"^{host}$"), ("p", f"^{path}$")):
        for n in range(3, 6):
            out += [tag + text[i:i + n] for i in range(len(text) - n + 1)]
    return [int(hashlib.md5(g.encode()).hexdigest()[:8], 16) % buckets for g in out] + [buckets]


def test_weights_and_scores_against_numpy(spark):
    labelled = uf.labelled_urls(spark).where("xxhash64(url) % 4 = 0")
    rows = [(r["url"], r["blocked"]) for r in labelled.collect()]
    buckets, rounds, rate, decay = 512, 30, 40.0, 0.0001
    x = np.zeros((len(rows), buckets + 1))
    for i, (url, _) in enumerate(rows):
        at = buckets_of(url, buckets)
        np.add.at(x[i], at, 1 / np.sqrt(len(at)))
    y, w = np.array([b for _, b in rows], float), np.zeros(buckets + 1)
    for _ in range(rounds):
        w = w * (1 - rate * decay) - rate / len(rows) * x.T @ (1 / (1 + np.exp(-x @ w)) - y)
    got = uf.train(labelled, buckets, rounds, rate, decay).first()["w"]
    assert got == pytest.approx(w.tolist(), abs=1e-9)
    urls = [u for u, _ in rows[:50]] + [None, "no url", "http://a.b/" + "long/" * 3000]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    scores = {r["page_id"]: r["score"] for r in uf.judge_urls(
        pages, labelled, [], buckets=buckets, rounds=rounds, rate=rate, decay=decay).collect()}
    for i, u in enumerate(urls):
        at = buckets_of(u, buckets)
        assert scores[i] == pytest.approx(1 / (1 + np.exp(-w[at].sum() / np.sqrt(len(at)))), abs=2e-6)


BLOCKED = ["https://shop.example.org/casino/poker/", "https://www.example.org/viagra/pills", "https://library.org/xxx/porn/1",
           "https://videopoker.net/", "http://www.onlinecasino.co.uk/play", "https://news.example.org/en/casinos/7",
           "https://museum.org/cheap-viagra-pills", "https://pornstars.example.com/x/2", "https://college.edu/gambling-tips/"]
ALLOWED = ["https://shop.example.org/library/recipes/", "https://www.example.org/gardening/tips", "https://libraries.org/a/1",
           "https://history-museum.net/", "http://www.newsroom.co.uk/today", "https://news.example.org/en/schools/7",
           "https://museum.org/science-courses", "https://musicians.example.com/x/2", "https://college.edu/research-tips/"]


def test_held_out_words_in_host_and_path(spark):
    pages = spark.createDataFrame(list(enumerate(BLOCKED + ALLOWED)), "page_id long, url string")
    seen = pages.join(uf.labelled_urls(spark), "url", "left_semi").count()
    got = {r["page_id"]: r for r in uf.judge_urls(pages, rules=[]).collect()}
    assert seen == 0
    caught = [got[i]["verdict"] == "block" for i in range(len(BLOCKED))]
    left = [got[i]["verdict"] == "allow" for i in range(len(BLOCKED), len(got))]
    # Combinations of known words in the path are all judged right; of new words most are.
    assert all(caught[:3]) and left[0] and sum(caught) >= 7 and sum(left) >= 7


def test_ties_repeats_and_nothing(spark):
    pages = spark.createDataFrame([(1, "http://a.b/x"), (1, "http://a.b/x"), (2, None)], "page_id long, url string")
    rules = [("block", "a.b", "/x"), ("allow", "a.b", "/x"), ("allow", "b", "/x")]
    got = uf.judge_urls(pages, rules=rules).collect()
    assert len(got) == 3 and got[0]["rule"] == got[1]["rule"] == "a.b/x" and got[0]["verdict"] == got[1]["verdict"]
    assert uf.judge_urls(pages.limit(0)).count() == 0


def test_both_classes_have_the_same_shapes(spark):
    counts = uf.labelled_urls(spark).groupBy("blocked").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("url").alias("d"))
    sizes = {r["blocked"]: (r["n"], r["d"]) for r in counts.collect()}
    shapes = len(uf.TEMPLATES + uf.PATH_TEMPLATES)
    assert sizes[1][0] == len(uf.BAD_WORDS) * shapes and sizes[0][0] == len(uf.GOOD_WORDS) * shapes
    assert all(n == d for n, d in sizes.values())
