"""Every registered query against its DuckDB oracle (or rows-only) on sf0.001."""

import pytest

import __spark_entry__ as entry
from oracle.check import compare, duck

SF = "/root/testdata/sf0.001"
QUERIES = entry.queries()
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, con, key):
    if key not in SQL:
        pytest.skip("no SQL form: tested against brute force elsewhere")
    ok, msg = compare(spark, con, key, QUERIES[key], SQL[key], SF)
    assert ok, msg


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "used_count" in df.columns
