"""Fuzzy line groups against brute force."""

import random

import pytest
import regex
import xxhash

from millrace.llm import line_dedup
from millrace.llm.line_dedup import (BITS, drop_repeated_lines, fingerprinted, line_segments, near_fingerprints,
                                      without_repeated_lines)


def plain_simhash(words):
    hs = [xxhash.xxh64_intdigest(w.encode(), 42) for w in words]
    return sum(1 << b for b in range(BITS) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def brute_force(docs, radius=3, similarity=0.8):
    """Text per row after dropping all but the first occurrence of each group."""
    key = {}  # normalised line -> occurrences
    for i, t in docs:
        for n, line in enumerate((t or "").split("\n")):
            norm = regex.sub(r"[^\p{L}\p{N}]+", " ", line.lower()).strip()
            if norm:
                th = xxhash.xxh64_intdigest((t or "").encode(), 42)
                th -= (th >> 63) << 64
                key.setdefault(norm, []).append((i is None, i or 0, th, n))
    norms = list(key)
    fps = [plain_simhash(n.split(" ")) for n in norms]
    up = list(range(len(norms)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i
    for i in range(len(norms)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= radius:
                a, b = norms[i].split(" "), norms[j].split(" ")
                if edits(a, b) <= int(max(len(a), len(b)) * (1 - similarity) + 1e-9):
                    up[find(i)] = find(j)
    first = {}
    for i, n in enumerate(norms):
        first[find(i)] = min([first.get(find(i), min(key[n]))] + key[n])
    gone = {o for i, n in enumerate(norms) for o in key[n] if o != first[find(i)]}
    out = []
    for i, t in docs:
        if t is None:
            out.append((i, None))
            continue
        th = xxhash.xxh64_intdigest(t.encode(), 42)
        th -= (th >> 63) << 64
        out.append((i, "\n".join(x for n, x in enumerate(t.split("\n")) if (i is None, i or 0, th, n) not in gone)))
    return out


@pytest.mark.parametrize("n", [1, 2, 63, 254, 255, 256, 510, 3000])
def test_fingerprints(spark, n):
    rng = random.Random(n)
    words = [f"w{rng.randrange(50)}" for _ in range(n)]
    docs = spark.createDataFrame([(1, "\n".join([" ".join(words), "- -", "other"]))], "doc_id long, text string")
    got = [(r["line_no"], r["fp"]) for r in fingerprinted(line_segments(docs)).orderBy("line_no").collect()]
    assert got == [(0, plain_simhash(words)), (2, plain_simhash(["other"]))]


@pytest.mark.parametrize("blocks", [4, 5, 6])
def test_near_fingerprints(spark, blocks):
    rng = random.Random(blocks)
    fps = [rng.getrandbits(63) for _ in range(150)]
    fps += [f ^ (1 << rng.randrange(63)) ^ (1 << rng.randrange(63)) ^ (1 << rng.randrange(63)) for f in fps[:100]]
    fps += [f ^ 1 for f in fps[120:200]]
    fps = sorted(set(fps))
    got = [tuple(r) for r in near_fingerprints(spark.createDataFrame(
        [(f, 9, 9) for f in fps], "fp long, shortest int, longest int"), 3, blocks).collect()]
    want = {(a, b) for a in fps for b in fps if a < b and bin(a ^ b).count("1") <= 3}
    assert set(got) == want and len(got) == len(want)


def frame(spark, docs):
    return spark.createDataFrame([(i, t, "a", "b", 1) for i, t in docs],
                                 "doc_id long, text string, doc string, key string, lines int")


def texts(df):
    return sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=str)


def test_against_brute_force(spark):
    rng = random.Random(8)
    vocab = [f"{a}{b}" for a in "bcdfgh" for b in ("an", "en", "in", "on")]
    base = [[rng.choice(vocab) for _ in range(rng.choice([1, 2, 5, 30, 80, 120]))] for _ in range(40)]

    def line():
        w = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 2])):
            w[rng.randrange(len(w))] = rng.choice(vocab)
        return rng.choice([" ", ", "]).join(w).capitalize() + rng.choice([".", "!", ""])
    docs = [(i, "\n".join(line() for _ in range(rng.randrange(1, 6)))) for i in range(60)]
    want = brute_force(docs)
    assert texts(drop_repeated_lines(frame(spark, docs)).select("doc.doc_id", "text")) == sorted(want, key=str)
    assert want != docs


def test_dense_group_and_a_link_that_the_smallest_fingerprint_misses(spark):
    """Variants of one long line: many near each other, some only through others."""
    rng = random.Random(2)
    words = [f"term{i}" for i in range(150)]
    docs, now = [], list(words)
    for i in range(40):
        now = list(now)
        now[rng.randrange(150)] = f"other{i}"
        docs.append((i, " ".join(now if i % 2 else words[:i] + [f"new{i}"] + words[i + 1:])))
    assert texts(drop_repeated_lines(frame(spark, docs)).select("doc.doc_id", "text")) == sorted(brute_force(docs), key=str)


def test_odd_rows(spark):
    docs = [(1, "A line of words.\n\n ... \nOther"), (2, None), (3, ""), (4, "a LINE, of words\nfresh"), (None, "other\nmine"),
            (5, "same row\nsame row"), (5, "same row\nsame row"), (6, "\n"), (None, "mine"), (7, "x " * 5000 + "\nother")]
    df = frame(spark, docs)
    out = drop_repeated_lines(df)
    assert texts(out.select("doc.doc_id", "text")) == sorted(brute_force(docs), key=str)
    assert out.columns == ["doc", "lines", "dropped", "text"]
    left = without_repeated_lines(df)
    assert left.columns == df.columns
    assert sorted(str(r["doc_id"]) for r in left.collect()) == sorted(["1", "2", "3", "4", "5", "5", "6", "7", "None"])
    assert drop_repeated_lines(frame(spark, [])).count() == 0


def test_a_text_is_hashed_once_and_words_are_aggregated_in_steps(spark):
    """The hash of the whole text lies below the generator of its lines, and a row of the aggregation holds several words."""
    docs = spark.createDataFrame([(1, "\n".join(f"w{i} x y z u v" for i in range(50)))], "doc_id long, text string")
    plan = line_segments(docs)._jdf.queryExecution().optimizedPlan().toString()
    lines = [i for i, line in enumerate(plan.splitlines()) if "Generate posexplode" in line]
    assert lines and all("xxhash64(text" not in line for line in plan.splitlines()[:max(lines) + 1])
    assert "xxhash64(text" in plan and "posexplode(words" not in plan


def test_words_of_candidate_lines_are_read_once(spark, monkeypatch):
    """A second round of comparisons uses the words that the first one has read from the documents."""
    labels, write = [], line_dedup.stage_table
    monkeypatch.setattr(line_dedup, "stage_table", lambda df, label: labels.append(label) or write(df, label))
    words = [f"term{i}" for i in range(20)]  # one fingerprint in any order; two of the three orders are near
    back = words[::-1]
    docs = [(i, " ".join(ws)) for i, ws in enumerate([words, back, back[:-2] + back[:-3:-1]])]
    assert texts(drop_repeated_lines(frame(spark, docs)).select("doc.doc_id", "text")) == sorted(brute_force(docs), key=str)
    assert labels.count("pairs") == 2 and labels.count("codes") == 1


def test_links_are_numbers_and_a_second_round_ties_only_components(spark, monkeypatch):
    """Whichever of the four lines of one fingerprint stands for the others, the pair without it is left to the second round."""
    seen, tie = [], line_dedup.connected_components
    monkeypatch.setattr(line_dedup, "connected_components", lambda edges: seen.append((edges.dtypes, edges.count())) or tie(edges))
    words = [f"term{i}" for i in range(20)]
    back = words[::-1]
    docs = [(i, " ".join(ws)) for i, ws in enumerate(ws[:18] + end for ws in (words, back) for end in (ws[18:], ws[:17:-1]))]
    assert texts(drop_repeated_lines(frame(spark, docs)).select("doc.doc_id", "text")) == sorted(brute_force(docs), key=str)
    assert [t.count("term") > 0 for _, t in brute_force(docs)] == [True, False, True, False]
    assert seen == [([("a", "bigint"), ("b", "bigint")], 1)] * 2


def test_fingerprints_meet_in_narrow_rows(spark):
    """A row of the bucket join is three numbers; pairs whose word counts rule a link out are left out."""
    most = 2 ** 31 - 1
    rows = [(8, 5, 5), (9, 100, 100), (10, 5, 100), (11, most, most), (1 << 40, 6, 6)]
    near = near_fingerprints(spark.createDataFrame(rows, "fp long, shortest int, longest long"), 3, 5)
    assert {tuple(r) for r in near.collect()} == {(8, 10), (9, 10), (8, 1 << 40), (10, 1 << 40)}
    plan = near._jdf.queryExecution().optimizedPlan()
    assert [len(plan.children().apply(0).children().apply(side).output().mkString(" ").split()) for side in (0, 1)] == [3, 3]


def test_word_codes(spark):
    """One character a word, whatever stands between the words."""
    df = spark.createDataFrame([("  Ab, \u00c9t\u00e9 -- x9 \u2167! ab",), ("ab \u00e9t\u00e9 X9 \u2177 AB",)], "line string")
    a, b = (r[0] for r in df.select(line_dedup._word_codes(df["line"])).collect())
    assert a == b and len(a) == 5 and a[0] == a[4] and len(set(a)) == 4
