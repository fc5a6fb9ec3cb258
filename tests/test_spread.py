"""Costly narrow rows are dealt at any size."""

from millrace.sources import tables as tab


def test_large_inputs_of_narrow_rows_are_dealt(spark, tmp_path, monkeypatch):
    spark.range(100_000).coalesce(1).write.parquet(f"{tmp_path}/t.parquet")
    rows = tab.table(spark, str(tmp_path), "t")
    monkeypatch.setattr(tab, "SMALL_BYTES", 1000)
    assert tab.spread(rows).rdd.getNumPartitions() == rows.rdd.getNumPartitions()
    dealt = tab.spread(rows, 10_000)
    assert dealt.rdd.getNumPartitions() >= 20 and dealt.count() == 100_000
