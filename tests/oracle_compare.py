"""Run registered queries in Spark and their SQL in DuckDB and compare results.

Usage: python tests/oracle_compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


EXACT = os.environ.get("ORACLE_EXACT") == "1"


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (0, "")
        return (1, repr(v if EXACT else round(v, 9)))
    return (1, repr(v))


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "float": "FLOAT",
                 "string": "VARCHAR", "boolean": "BOOLEAN"}


def rows_of(records, cols):
    return sorted(tuple(_norm(r[c]) for c in cols) for r in records)


def compare(spark, sf_dir: str, names=None, verbose=True) -> dict[str, str]:
    from __spark_entry__ import oracle_sql, queries

    qs, sqls = queries(), oracle_sql()
    con = duck(sf_dir)
    out = {}
    for name in names or sorted(qs):
        if name not in sqls:
            out[name] = "rows-only"
            continue
        t0 = time.time()
        try:
            sdf = qs[name](spark, sf_dir)
            srows = [r.asDict() for r in sdf.collect()]
            scols = sorted(sdf.columns)
            rel = con.sql(sqls[name])
            dcols = sorted(rel.columns)
            drows = [dict(zip(rel.columns, r)) for r in rel.fetchall()]
            stypes = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
                      for f in sdf.schema.fields}
            dtypes = {c: str(t) for c, t in zip(rel.columns, rel.types)}
        except Exception as e:  # noqa: BLE001
            out[name] = f"ERROR {type(e).__name__}: {str(e)[:300]}"
            if verbose:
                print(name, out[name], flush=True)
            continue
        if scols != dcols:
            res = f"COLUMNS spark={scols} duck={dcols}"
        elif stypes != dtypes:
            res = f"TYPES spark={stypes} duck={dtypes}"
        elif len(srows) != len(drows):
            res = f"ROWS spark={len(srows)} duck={len(drows)}"
        else:
            a, b = rows_of(srows, scols), rows_of(drows, dcols)
            if a == b:
                res = "OK"
            else:
                diff = [(x, y) for x, y in zip(a, b) if x != y][:2]
                res = f"VALUES {diff}"
        out[name] = f"{res} ({len(srows)} rows, {time.time() - t0:.1f}s)"
        if verbose:
            print(name, out[name], flush=True)
    return out


if __name__ == "__main__":
    from churnlens.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session()
    res = compare(spark, sf, sys.argv[2:] or None)
    bad = {k: v for k, v in res.items() if not (v.startswith("OK") or v == "rows-only")}
    print(f"\n{len(res) - len(bad)}/{len(res)} ok; failing: {sorted(bad)}")
