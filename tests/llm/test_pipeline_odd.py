"""Pipeline stages on odd tables: nulls, empty and long texts, repeats, ties, clashing names, no rows."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp long, kept boolean, tokens string"
WORDS = {"en": "the house and street over water goes with from not they were here under".split(),
         "de": "das haus und strasse wasser geht nicht mit von der sie waren hier unter".split()}


def odd_rows():
    rng = random.Random(8)
    rows = [(i, " ".join(rng.choice(WORDS[la]) for _ in range(60)), la, "web", None) for i, la in enumerate(["en", "de"] * 15)]
    rows += [(100, rows[0][1], "en", "web", None), (0, rows[0][1], "en", "web", None), (101, " ".join(WORDS["en"] * 2500), None, None, 3),
             (102, None, "en", "web", 0), (103, "", None, "web", 0), (104, "12 -- 34", "de", None, 8), (None, rows[4][1] + " more", "en", "web", 1)]
    return [(*r, 7, None, "x") for r in rows]


@pytest.mark.parametrize("name", [n for n, _ in cp.STAGES])
def test_stage_on_odd_rows(spark, name):
    stage, docs = dict(cp.STAGES)[name], spark.createDataFrame(odd_rows(), SCHEMA)
    out = stage(spark, docs, "unused")
    got = [r.asDict() for r in out.collect()]
    ids = [r["doc_id"] for r in got]
    nothing = stage(spark, docs.limit(0), "unused")
    assert nothing.columns == out.columns and nothing.count() == 0
    if name != "packing":
        assert out.columns == docs.columns and {r["tokens"] for r in got} == {"x"} and {r["fp"] for r in got} == {7}
    if name == "language_id":
        assert not {102, 103, 104} & set(ids) and ids.count(0) == 2 and {100, 101, None} <= set(ids)
        assert {r["lang"] for r in got} <= {"en", "de"}
    if name == "line_dedup":  # the copy under another id and the near copy go; rows that repeat whole share one fate
        texts = [r["text"] for r in got if r["text"] == odd_rows()[0][1]]
        assert len(got) == len(odd_rows()) - 2 and len(texts) == 2 and 100 not in ids and {102, 103, 104} <= set(ids)
    if name == "simhash_near_dedup":
        assert ids.count(0) == 1 and 100 not in ids and len([i for i in ids if i in (102, 103)]) == 1 and 101 in ids
    if name == "mixing":
        assert set(ids) <= {r[0] for r in odd_rows()} and len(got) > 0
    if name == "packing":
        for ident in {r[0] for r in odd_rows()}:
            pieces = sorted((r for r in got if r["doc_id"] == ident), key=lambda r: r["start"])
            assert sum(len(r["ids"]) // 4 for r in pieces) == pieces[0]["doc_tokens"] * [r[0] for r in odd_rows()].count(ident)
            assert int.from_bytes(pieces[-1]["ids"][-4:], "little") == 1
