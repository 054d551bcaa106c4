import zlib
from collections import Counter, defaultdict

import duckdb
import pytest

from churnlens.llm.sharding import OP10_SQL, op10_sharding, shard_by_bytes

from .conftest import doc, prose


def _check(rows, got, shards=8, slack=None):
    assert len(got) == len(rows)
    want = Counter((r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in rows)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == want
    by = defaultdict(list)
    for r in got:
        by[r.shard].append(r)
    assert set(by) <= set(range(shards))
    for s in by.values():
        assert sorted(r.slot for r in s) == list(range(len(s)))
    total = sum(r.size for r in got)
    slack = slack or max(r.size for r in got) + 0.01 * total / shards
    for s in range(shards):
        assert abs(sum(r.size for r in by[s]) - total / shards) <= slack
    return by


def test_equal_bytes_and_groups(make):
    rows = [doc(i, prose(i % 150, 5 + i % 40)) for i in range(900)] + [doc(5000 + i, None) for i in range(3)] + [doc(None, "null id")]
    by = _check(rows, shard_by_bytes(make(rows)).collect())
    # small groups of equal texts stay whole, but for those larger than the share that may be split
    where = defaultdict(set)
    for s, rs in by.items():
        for r in rs:
            where[r.text_crc32].add(s)
    assert sum(len(w) > 1 for w in where.values()) <= 7


def test_hot_text_is_split(make):
    rows = [doc(i, "the same text again") for i in range(700)] + [doc(1000 + i, prose(i, 6)) for i in range(300)]
    _check(rows, shard_by_bytes(make(rows).repartition(5)).collect())


def test_repeated_and_few_rows(make):
    rows = [doc(1, "a")] * 5 + [doc(2, "b" * 100_000)]
    got = shard_by_bytes(make(rows)).collect()
    _check(rows, got, slack=10**6)
    assert shard_by_bytes(make([])).collect() == []


def test_equal_rows_fill_the_shards(make):
    """Rows equal in text and doc_id are divided like others: all shards within one row."""
    same = [doc(7, "equal in text and id " * 8)] * 1000
    for rows in (same, same + [doc(10_000 + i, prose(i, 28)) for i in range(1000)], [doc(None, "no id " * 20)] * 900):
        got = shard_by_bytes(make(rows).repartition(5)).collect()
        _check(rows, got, slack=max(r.size for r in got))
    kept = shard_by_bytes(make(same + [doc(i + 9, prose(i)) for i in range(500)]), split_share=10.0).collect()
    assert len({r.shard for r in kept if r.doc_id == 7}) == 1  # a share that lets every group stay whole


def test_extreme_ids(make):
    rows = [doc(i, "one text for all ids") for i in (-2**63, -1, 0, 2**63 - 1, None, 5, 6, 7, 8, 9, 10)]
    _check(rows, shard_by_bytes(make(rows)).collect(), slack=100)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_against_sql(spark, sf):
    path = f"/root/testdata/{sf}"
    got = op10_sharding(spark, path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}/documents.parquet'")
    want = con.execute(OP10_SQL).fetchall()
    columns = [d[0] for d in con.description]
    assert sorted(map(tuple, got.select(*columns).collect())) == sorted(want)


def test_no_python(spark):
    plan = op10_sharding(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
