"""Every registered query against its SQL on the smallest tables."""

from pathlib import Path

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from oracle import compare, connect

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, con, name):
    got = queries()[name](spark, FOLDER).toPandas()
    if name in oracle_sql():
        assert compare(got, con.execute(oracle_sql()[name]).fetchdf()) is None
    else:
        assert len(got)


def test_entry(spark):
    assert entry(spark).count() > 0
