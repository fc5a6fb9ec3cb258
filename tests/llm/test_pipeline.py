"""The corpus pipeline: each stage on its own input, then all of them in a row."""

import hashlib
import re
from pathlib import Path

import numpy as np
import pytest
from test_line_dedup import brute_force
from test_near_dedup import groups, plain_fingerprint

import corpus_pipeline
from millrace.llm.language_id import train_dictionaries, predict_languages

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")
NAMES = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Input and output rows of every stage, written and read again between any two."""
    root, docs, out = tmp_path_factory.mktemp("stages"), spark.read.parquet(f"{FOLDER}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, FOLDER).write.parquet(str(root / name))
        done = spark.read.parquet(str(root / name))
        out[name] = (docs, done)
        docs = done
    return out


def pairs(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_order_and_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "simhash_near_dedup", "mixing", "packing"]
    assert all(stages[n][1].columns == NAMES for n in list(stages)[:-1])


def test_language_stage_drops_only_what_is_rejected(stages):
    before, after = stages["language_id"]
    found = predict_languages(before, train_dictionaries(before)).where("not rejected")
    assert pairs(after, "doc_id", "lang") == pairs(found, "doc.doc_id", "lang_pred")
    assert after.count() >= 0.98 * before.count()


def test_line_stage_against_brute_force(stages):
    before, after = stages["line_dedup"]
    want = [(i, t) for i, t in brute_force(pairs(before, "doc_id", "text")) if re.search(r"[^\W_]", t)]
    assert pairs(after, "doc_id", "text") == sorted(want)
    assert all(r["n_chars"] == len(r["text"]) for r in after.collect())


def test_near_stage_against_brute_force(stages):
    before, after = stages["simhash_near_dedup"]
    docs = pairs(before, "doc_id", "text")
    fps = np.array([plain_fingerprint(t) for _, t in docs], np.uint64)
    root = groups(len(docs), np.argwhere(np.triu(np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 2, 1)))
    least = {}
    for (i, t), r in zip(docs, root):
        least[r] = min(least.get(r, (i, t)), (i, t))
    assert pairs(after, "doc_id", "text") == sorted(least.values())


def test_mixing_stage_follows_its_probabilities(stages):
    from millrace.llm.mixing import sampling_table
    before, after = stages["mixing"]
    rows = sampling_table(before).select("doc.doc_id", "probability").collect()
    drawn = {r[0] for r in rows if int(hashlib.md5(f"mix:{r[0]}".encode()).hexdigest()[:8], 16) / 2**32 < r[1]}
    assert {r[0] for r in after.select("doc_id").collect()} == drawn and drawn


def test_packing_stage_holds_every_token(stages):
    from test_packing import check
    before, after = stages["packing"]
    check(pairs(before, "doc_id", "text"), after.collect(), 2048)


def test_run_is_the_stages_in_a_row(spark, stages):
    cols = ["doc_id", "start", "doc_tokens"]
    got = corpus_pipeline.run(spark, FOLDER)
    assert {(r[0], r[2]) for r in pairs(got, *cols)} == {(r[0], r[2]) for r in pairs(stages["packing"][1], *cols)}
