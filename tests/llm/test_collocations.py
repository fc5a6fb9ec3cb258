"""Collocations against brute force in plain integers."""

import random
import re
from collections import Counter, defaultdict

import pytest

from millrace.llm import collocations as co

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(docs, least, top, kill=50):
    f, n = Counter(), Counter()
    for text, lang in docs:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang or "und"] += len(words)
            for size in (1, 2, 3):
                f.update((lang or "und", tuple(words[i:i + size])) for i in range(len(words) - size + 1))
    by_lang = defaultdict(list)
    for (lang, g), a in f.items():
        if len(g) < 2 or a < least:
            continue
        longer = [h for (other, h), b in f.items() if other == lang and len(h) == 3 and b >= least
                  and g in (h[:2], h[1:]) and 100 * b >= kill * a] if len(g) == 2 else []
        if not longer:
            cuts = [((1_000_000 * a * a) // (f[lang, g[:k]] * f[lang, g[k:]]), k) for k in range(1, len(g))]
            score, k = min(cuts)
            by_lang[lang].append((-score, -a, " ".join(g).encode(), f[lang, g[:k]], f[lang, g[k:]]))
    return sorted((lang, rank + 1, p.decode(), -a, l, r, n[lang], -s) for lang, found in by_lang.items()
                  for rank, (s, a, p, l, r) in enumerate(sorted(found)[:top]))


def corpus(seed):
    rng = random.Random(seed)
    words = ["a", "b", "c", "the", "The", "é", "x\x01", "x", "日本", "z ", "\u0085", "%09", "q"]
    weights = [9, 7, 5, 9, 2, 3, 3, 6, 2, 3, 2, 2, 1]
    docs = []
    for i in range(160):
        gaps = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", "! "]
        text = "".join(rng.choice(gaps) + w for w in rng.choices(words, weights, k=rng.choice([1, 2, 9, 60])))
        docs.append((text, rng.choice(["en", "en", "en", "fr", None, "a\tb", "a\nb", "%0A"])))
    docs += [docs[0]] * 40 + [(None, "en"), ("", None), (" .,\n", "fr"), ("only", "de"), ("the b " * 20_000, "en"),
                              ("b, the. " * 4_000, "fr")]
    return docs


@pytest.mark.parametrize("chunk,pieces,partitions", [(8 << 20, 250_000, 4), (50, 40, 40)])
def test_equals_brute_force(spark, monkeypatch, chunk, pieces, partitions):
    """Also with texts cut into tiny chunks and streams into tiny ranges."""
    monkeypatch.setattr(co, "CHUNK_BYTES", chunk)
    docs = corpus(2)
    frame = spark.createDataFrame([(i, t, g, 1, "p") for i, (t, g) in enumerate(docs)],
                                  "doc_id long, text string, lang string, rank int, phrase string")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = co.collocations(frame.repartition(3), least=4, top=60, piece_rows=pieces).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted(tuple(r) for r in got) == brute(docs, 4, 60)


def test_empty_and_rare(spark):
    empty = spark.createDataFrame([], "text string, lang string")
    assert co.collocations(empty).collect() == []
    assert co.collocations(spark.createDataFrame([("a b c", "en")], empty.schema)).collect() == []


def test_exact_beyond_64_bits(spark):
    row = spark.createDataFrame([(3_000_000_000_000, 4_000_000_000_000, 5_000_000_000_001)], "a long, l long, r long")
    a, left, right = row.first()
    assert row.select(co._score(row.a, row.l, row.r)).first()[0] == 1_000_000 * a * a // (left * right)


def test_fold_of_wide_numbers():
    """Numbers that do not fit into 62 bits together."""
    import numpy as np
    rng = np.random.default_rng(0)
    columns = [rng.integers(0, 3, 500), *(rng.integers(0, 3, 500) * (1 << 23) for _ in range(3))]
    rows, counts = co._fold(columns, [3] + [1 << 25] * 3)
    assert Counter(dict(zip(zip(*(r.tolist() for r in rows)), counts.tolist()))) == Counter(
        zip(*(c.tolist() for c in columns)))
