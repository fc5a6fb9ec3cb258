"""Stored tables in key-hash buckets."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from millrace.operators.versioned import DuplicateSourceKey
from millrace.sources.buckets import CLOSED, CURRENT, BucketedTable, create_history, scd2_stored, upsert_stored


def files(t, version=None):
    """(part, bucket) -> data files of a version."""
    out = {}
    for r in t._lines(version):
        if r["bucket"] is not None:
            folder = Path(t.root, r["folder"], f"_part={r['part']}", f"_bucket={r['bucket']}")
            out.setdefault((r["part"], r["bucket"]), set()).update(str(p) for p in folder.glob("*.parquet"))
    return out


def pairs(df):
    return sorted(((r["k"], r["x"]) for r in df.collect()), key=str)


def test_upsert_rewrites_touched_buckets_only(spark, tmp_path):
    t = BucketedTable(spark, str(tmp_path / "t"), ["k"], buckets=16)
    t.commit(spark.range(200).select(F.col("id").alias("k"), F.lit("old").alias("x")), "WRITE")
    batch = spark.createDataFrame([(3, "new"), (5000, "new"), (None, "null key")], "k long, x string")
    touched = t.touched(batch)
    assert 1 <= len(touched) <= 3
    assert upsert_stored(t, batch) == 1
    want = {**{i: "old" for i in range(200)}, 3: "new", 5000: "new", None: "null key"}
    assert pairs(t.read()) == sorted(want.items(), key=str)
    assert pairs(t.read(0)) == sorted(((i, "old") for i in range(200)), key=str)
    before, after = files(t, 0), files(t, 1)
    assert {c for c in after if before.get(c) != after[c]} == {("rows", b) for b in touched}
    assert upsert_stored(t, batch.replace("null key", "again")) == 2  # a null key is one key
    assert pairs(t.read()) == sorted({**want, None: "again"}.items(), key=str)


def test_empty_and_unknown(spark, tmp_path):
    t = BucketedTable(spark, str(tmp_path / "t"), ["k"], buckets=4)
    with pytest.raises(ValueError):
        t.read()
    rows = spark.createDataFrame([(1, "a")], "k long, x string")
    t.commit(rows.limit(0), "WRITE")
    assert t.read().columns == ["k", "x"] and t.read().count() == 0
    upsert_stored(t, rows)
    upsert_stored(t, rows.limit(0))
    assert pairs(t.read()) == [(1, "a")] and files(t, 1) == files(t, 2)
    assert [tuple(r) for r in t.history().orderBy("version").collect()] == [
        (0, "WRITE", 0), (1, "UPSERT", 1), (2, "UPSERT", 1)]
    with pytest.raises(ValueError):
        t.read(7)


def test_history_keeps_closed_rows(spark, tmp_path):
    t = BucketedTable(spark, str(tmp_path / "h"), ["k"], buckets=8)
    first = spark.range(100).select(F.col("id").alias("k"), F.lit("a").alias("x"), F.lit(True).alias("is_current"),
                                    F.lit("2024-01-01").alias("valid_from"), F.lit("9999-12-31").alias("valid_to"))
    create_history(t, first)
    for day, value in (("2024-02-01", "b"), ("2024-03-01", "c"), ("2024-03-02", "c")):
        scd2_stored(t, spark.createDataFrame([(7, value), (700, "n")], "k long, x string"), "x", ["x"], day)
    got = sorted((r["k"], r["x"], r["is_current"], r["valid_from"], r["valid_to"]) for r in t.read().where("k in (7, 700)").collect())
    assert got == [(7, "a", False, "2024-01-01", "2024-02-01"), (7, "b", False, "2024-02-01", "2024-03-01"),
                   (7, "c", True, "2024-03-01", "9999-12-31"), (700, "n", True, "2024-02-01", "9999-12-31")]
    assert t.read().count() == 103
    bucket = min(t.touched(spark.createDataFrame([(7,)], "k long")))
    assert files(t, 1)[CLOSED, bucket] < files(t, 2)[CLOSED, bucket]  # added to, not rewritten
    changed = {c for c in files(t, 3) if files(t, 0).get(c) != files(t, 3)[c]}
    assert {b for p, b in changed if p == CURRENT} == t.touched(spark.createDataFrame([(7,), (700,)], "k long"))
    with pytest.raises(DuplicateSourceKey):
        scd2_stored(t, spark.createDataFrame([(7, "d"), (7, "e")], "k long, x string"), "x", ["x"], "2024-04-01")
