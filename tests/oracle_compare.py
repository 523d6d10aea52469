"""Run Spark queries and their DuckDB oracles side by side and compare rows.

Usage: python tests/oracle_compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN"}


def _norm(v):
    """Exact comparison: floats by their repr (the driver hashes values)."""
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    return v


def normalise(cols: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def compare(spark, sf_dir: str, names: list[str] | None = None, verbose: bool = True) -> dict:
    import __spark_entry__ as E
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name in names or list(sqls):
        t0 = time.time()
        df = qs[name](spark, sf_dir)
        s_cols = df.columns
        s_rows = [tuple(r) for r in df.collect()]
        t1 = time.time()
        rel = con.sql(sqls[name])
        d_cols = rel.columns
        s_types = dict(df.dtypes)
        d_types = dict(zip(rel.columns, [str(t) for t in rel.types]))
        ok_types = all(SPARK_TO_DUCK.get(t, t) == d_types.get(c) for c, t in s_types.items())
        d_rows = rel.fetchall()
        ok_cols = sorted(s_cols) == sorted(d_cols)
        ok_n = len(s_rows) == len(d_rows)
        ok_v = ok_cols and ok_n and normalise(s_cols, s_rows) == normalise(d_cols, d_rows)
        results[name] = dict(cols=ok_cols, types=ok_types, rows=ok_n, values=ok_v, n=len(s_rows),
                             n_sql=len(d_rows), sec=round(t1 - t0, 2))
        if verbose:
            print(name, results[name], flush=True)
            if not ok_cols:
                print("   spark:", sorted(s_cols), "\n   sql:  ", sorted(d_cols))
            elif not ok_v:
                a, b = normalise(s_cols, s_rows), normalise(d_cols, d_rows)
                diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
                print("   first diffs:", diff)
    return results


if __name__ == "__main__":
    from churnlens import local_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    res = compare(spark, sf, sys.argv[2:] or None)
    bad = [k for k, v in res.items() if not v["values"]]
    print("FAILED:", bad if bad else "none")
