"""Packing: ids against the tokenizer itself, every id in one piece, full windows."""

import json
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from tokenizers import Tokenizer

from millrace.llm.packing import Packer, Shard, TokenIds, fast_encoder, pack_documents

PATH = public_tokenizers.path("byte_bpe_50k.json")


def plain_ids(texts):
    found = Tokenizer.from_file(PATH).encode_batch(list(texts), add_special_tokens=False)
    return [e.ids + [1] for e in found]


@pytest.mark.parametrize("fast", [True, False])
def test_token_ids(fast):
    rng = random.Random(1)
    bits = [" ", "  ", "\n", "\t", " ", "　", " ", "a", "B", "é", "漢", "1", "'s", "'", ",", "!!", "😀",
            "<|endoftext|>", "\x1c", "\x85", "x y", "\r\n", "_", "“", "words of text"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randrange(0, 14))) for _ in range(6000)]
    texts += ["", " ", "one two " * 300_000, "x" * 50_000]
    encode = TokenIds(PATH, 1)
    if not fast:
        encode.fast = None
        texts = texts[:1500]
    want = plain_ids(texts)
    for at in range(0, len(texts), 500):
        got = encode(pa.array(texts[at:at + 500]))
        assert [g.tolist() for g in got] == want[at:at + 500]


def thue_morse(n):
    return "".join("ab"[bin(i).count("1") % 2] for i in range(n))


@pytest.mark.parametrize("n", [1, 512, 1024, 4096])
def test_pieces_that_share_a_hash(n):
    """Words whose polynomial hashes are equal keep their own ids, in one call and across calls."""
    word = thue_morse(n)
    other = word.translate(str.maketrans("ab", "ba"))
    texts = [f"{word} {other} x", other, f"y {other}", word, f"{other}, {word}"]
    want = plain_ids(texts)
    encode = TokenIds(PATH, 1)
    assert [g.tolist() for g in encode(pa.array(texts))] == want
    assert [encode(pa.array([t]))[0].tolist() for t in texts[::-1]] == want[::-1]
    alone = TokenIds(PATH, 1)
    assert [alone(pa.array([t]))[0].tolist() for t in texts] == want


def test_random_collisions(monkeypatch):
    """A hash base that makes most pieces collide."""
    rng = random.Random(3)
    texts = [" ".join("".join(rng.choices("abcé,", k=rng.randint(1, 6))) for _ in range(rng.randint(0, 30)))
             for _ in range(300)]
    encode = TokenIds(PATH, 1)

    def weak(n):
        encode.powers = encode.inverse = np.ones(n, np.uint64)
    encode._grow = weak
    weak(1 << 20)
    for at in range(0, 300, 50):
        assert [g.tolist() for g in encode(pa.array(texts[at:at + 50]))] == plain_ids(texts[at:at + 50])
    assert len(encode.odd) > 100


def test_seeds_read_the_postings_of_their_terms():
    """A document without a common term costs nothing; used documents leave the postings."""
    shard = Shard([np.array([1, 2, 3]), np.array([3, 4]), np.array([50, 51]), np.array([50, 60])])
    entries = shard.first[1:] - shard.first[:-1]
    assert sorted(entries[entries > 0].tolist()) == [2, 2]  # terms 3 and 50; no other can find a neighbour
    shard.unused[:2] = False
    assert shard.neighbours(0).tolist() == [] and shard.neighbours(2).tolist() == [2, 3]
    assert len(shard.doc) == 2


def test_other_tokenizer_files_have_no_fast_path(tmp_path):
    spec = json.load(open(PATH))
    assert fast_encoder(PATH)
    for change in ({"normalizer": {"type": "Lowercase"}}, {"pre_tokenizer": {"type": "Whitespace"}},
                   {"model": {**spec["model"], "merges": spec["model"]["merges"][::-1]}}):
        path = tmp_path / "t.json"
        path.write_text(json.dumps({**spec, **change}))
        assert fast_encoder(str(path)) is None


def test_bm25_order():
    docs = [np.array(d) for d in ([1, 2, 3, 9], [1, 2, 3, 8], [1, 5, 6, 7], [4, 4, 5], [1, 2, 7, 7])]
    shard = Shard(docs)
    shard.unused[0] = False
    idf = {t: np.log1p((5 - df + 0.5) / (df + 0.5)) for t in range(10)
           for df in [sum(t in d for d in docs)]}
    mean = np.mean([len(d) for d in docs])
    score = [sum(idf[t] * (d == t).sum() * 2.2 / ((d == t).sum() + 1.2 * (0.25 + 0.75 * len(d) / mean))
                 for t in (1, 2, 3) if t in d) for d in docs]
    assert shard.neighbours(0).tolist() == [i for i in np.argsort([-s for s in score]) if i and score[i] > 0]


def test_all_terms_of_a_long_seed_count():
    rng = np.random.default_rng(5)
    docs = [rng.choice(400, int(rng.integers(100, 900)), p=np.arange(1, 401) / 80200.0) for _ in range(60)]
    shard, n = Shard(docs), len(docs)
    df = np.array([sum(t in d for d in docs) for t in range(400)])
    idf, mean = np.log1p((n - df + 0.5) / (df + 0.5)), np.mean([len(d) for d in docs])
    left = list(range(n))
    for seed in rng.permutation(n)[:50].tolist():  # also after most documents are used
        shard.unused[seed] = False
        left.remove(seed)
        score = {i: sum(idf[t] * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(docs[i]) / mean))
                        for t in set(docs[seed].tolist()) for tf in [(docs[i] == t).sum()] if tf) for i in left}
        got, want = shard.neighbours(seed).tolist(), sorted(left, key=lambda i: -score[i])[:16]
        assert len(got) == len(want)
        assert all(abs(score[a] - score[b]) < 1e-3 for a, b in zip(got, want))


def test_windows_take_neighbours_first():
    rng = np.random.default_rng(2)
    docs = [np.concatenate([rng.integers(1000 * (i % 4), 1000 * (i % 4) + 60, 40), [1]]) for i in range(80)]
    packer = Packer(0, 2048 // 8)
    packer.shard(list(range(80)), docs)
    packer.finish()
    windows = {}
    for doc_id, *_, sequence, _ in packer.rows:
        windows.setdefault(sequence, []).append(doc_id % 4)
    pure = sum(len(set(w)) == 1 for w in windows.values())
    assert pure >= 0.6 * len(windows)


def check(docs, rows, window):
    """Pieces cover every document once; sequences are gapless and full or a power of two."""
    by_doc, by_sequence = {}, {}
    for r in rows:
        ids = np.frombuffer(r["ids"], "<u4").tolist()
        by_doc.setdefault(r["doc_id"], []).append((r["start"], ids, r["doc_tokens"]))
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], len(ids)))
    want = {}
    for (i, _), ids in zip(docs, plain_ids(t or "" for _, t in docs)):
        want.setdefault(i, []).append(ids)
    for i, texts in want.items():
        assert sum(len(p[1]) for p in by_doc[i]) == sum(map(len, texts))
        if len(texts) == 1:
            got = sorted(by_doc[i])
            assert [p[0] for p in got] == np.cumsum([0] + [len(p[1]) for p in got])[:-1].tolist()
            assert sum((p[1] for p in got), []) == texts[0] and {p[2] for p in got} == {len(texts[0])}
    assert set(by_doc) == set(want)
    for parts in by_sequence.values():
        parts.sort()
        assert [p[0] for p in parts] == np.cumsum([0] + [p[1] for p in parts])[:-1].tolist()
        size = sum(p[1] for p in parts)
        assert size == window or (size < window and size & (size - 1) == 0)
    return by_sequence


def test_pack(spark):
    rng = random.Random(3)
    docs = [(i, " ".join(rng.choice(["tea", "milk", "sugar", "water"]) for _ in range(rng.choice([0, 1, 30, 900]))))
            for i in range(120)]
    docs += [(500, None), (501, ""), (None, "no id"), (502, "long " * 60_000), (7, "again"), (503, "a\n\n b  c\t")]
    df = spark.createDataFrame([(i, t, "n", "k") for i, t in docs], "doc_id long, text string, near string, key string")
    rows = pack_documents(df, PATH, window=256, shard_tokens=5000).collect()
    check(docs, rows, 256)
    again = pack_documents(df, PATH, window=256, shard_tokens=5000).collect()
    assert sorted(map(tuple, rows), key=str) == sorted(map(tuple, again), key=str)
    assert pack_documents(df.limit(0), PATH).count() == 0


def test_near_copies_with_distant_ids_meet_behind_a_common_smallest_hash(spark):
    """All documents share their smallest word hash; a shard holds few of them."""
    rng = random.Random(4)

    def signed(word):
        h = xxhash.xxh64_intdigest(word.encode(), 42)
        return h - (h >> 63 << 64)
    common = [f"common{i}" for i in range(30)]
    least = min(map(signed, common))
    words = [w for w in (f"word{i}" for i in range(6000)) if signed(w) > least]
    docs = []
    for i in range(60):
        own = rng.sample(words, 60)
        docs += [(i, " ".join((common + own) * 50)), (i + 1000, " ".join((common + own[:-1] + ["changed"]) * 50))]
    rows = pack_documents(spark.createDataFrame(docs, "doc_id long, text string"), PATH, window=512,
                          shard_tokens=1500).collect()
    at = {}
    for r in rows:
        at.setdefault(r["doc_id"], set()).add(r["sequence_id"])
    assert sum(bool(at[i] & at[i + 1000]) for i in range(60)) >= 36
