"""The registered queries against their DuckDB SQL on the given tables."""

import os

import duckdb
import pytest

from churnlens.llm.registry import ORACLE, QUERIES

SFS = ["sf0.001", "sf0.01"]


@pytest.mark.parametrize("sf", SFS)
@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name, sf):
    path = f"/root/testdata/{sf}"
    got = QUERIES[name](spark, path)
    con = duckdb.connect()
    for f in os.listdir(path):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{path}/{f}'")
    want = con.execute(ORACLE[name]).fetchall()
    columns = [d[0] for d in con.description]
    assert sorted(columns) == sorted(got.columns)
    assert sorted(map(repr, map(tuple, got.select(*columns).collect()))) == sorted(map(repr, want))


def test_every_query_is_there():
    numbers = sorted(int(n[2:].split("_")[0]) for n in QUERIES)
    assert numbers == list(range(1, 14))
