"""The registered mixing query beside its SQL on a table with one document of a source, language and id of its own."""

from pathlib import Path

import duckdb
import pytest

from millrace.llm.queries import QUERIES
from millrace.llm.registry import ORACLES

FOLDER = "/root/testdata/sf0.001"


def test_a_tiny_cell_does_not_shrink_the_sample(spark, tmp_path):
    if not Path(FOLDER).exists():
        pytest.skip("no test tables")
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    lone = docs.limit(1).selectExpr("-1L AS doc_id", "'one of its kind' AS text", "'xx' AS lang", "'lone' AS source",
                                    "15L AS n_chars").selectExpr(*[f"CAST({c} AS {t}) AS {c}" for c, t in docs.dtypes])
    kept = {}
    for name, rows in (("given", docs), ("lone", docs.unionByName(lone))):
        rows.coalesce(1).write.parquet(f"{tmp_path}/{name}/documents.parquet")
        got = [tuple(r) for r in QUERIES["op1_mixing"](spark, f"{tmp_path}/{name}").collect()]
        con = duckdb.connect()
        con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/{name}/documents.parquet/*.parquet')")
        assert sorted(got) == sorted(con.execute(ORACLES["op1_mixing"]).fetchall())
        kept[name] = sum(r[4] for r in got if r[6]) / sum(r[4] for r in got)
    assert kept["given"] > 0.6 and abs(kept["lone"] - kept["given"]) < 0.05
