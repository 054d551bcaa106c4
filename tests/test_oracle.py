"""Every registered query with SQL equals its DuckDB result (sf0.01)."""

import pytest

from tests.oracle_compare import compare

from __spark_entry__ import oracle_sql, queries

NAMES = sorted(oracle_sql())


def test_every_query_is_registered_and_named_consistently():
    qs, sql = queries(), oracle_sql()
    assert set(sql) <= set(qs)
    assert len(qs) >= 60


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_duckdb(spark, name):
    res = compare(spark, "/root/testdata/sf0.01", [name], verbose=False)[name]
    assert res.startswith("OK"), res


def test_entry_smoke(spark):
    from __spark_entry__ import entry

    df = entry(spark)
    assert df.count() == 13 and "userId" in df.columns
