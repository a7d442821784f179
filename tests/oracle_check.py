"""Run registered Spark queries and their DuckDB oracle side by side.

Usage: python tests/oracle_check.py [sf_dir] [key ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

RAW = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in RAW:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return v
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, dt.datetime):
        return v.date() if v.time() == dt.time(0) else v
    return v


def _key(row):
    return tuple((0, "") if x is None else (1, str(x)) for x in row)


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return [cols[i] for i in order], sorted(out, key=_key)


def close(a, b, rel=1e-9):
    if a is None or b is None:
        return a is None and b is None
    if isinstance(a, float) or isinstance(b, float):
        return abs(float(a) - float(b)) <= rel * max(1.0, abs(float(a)), abs(float(b)))
    return a == b


def compare(spark, key: str, sf_dir: str, con=None) -> dict:
    from __spark_entry__ import oracle_sql, queries
    con = con or duck(sf_dir)
    t0 = time.time()
    sdf = queries()[key](spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    sql = oracle_sql().get(key)
    res = {"key": key, "spark_rows": len(s_rows), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        res["status"] = "no-oracle"
        return res
    cur = con.execute(sql)
    d_cols = [c[0] for c in cur.description]
    d_rows = cur.fetchall()
    res["oracle_rows"] = len(d_rows)
    sc, sr = rows_of(s_cols, s_rows)
    dc, dr = rows_of(d_cols, d_rows)
    if sc != dc:
        res["status"] = "schema"
        res["detail"] = f"spark={sc} oracle={dc}"
        return res
    if len(sr) != len(dr):
        res["status"] = "rowcount"
        return res
    exact = sr == dr
    if exact:
        res["status"] = "match"
        return res
    bad = [(a, b) for a, b in zip(sr, dr) if not all(close(x, y) for x, y in zip(a, b))]
    res["status"] = "approx" if not bad else "values"
    if bad:
        res["detail"] = f"{len(bad)} rows differ, e.g. spark={bad[0][0]} oracle={bad[0][1]}"
    else:
        diff = [(a, b) for a, b in zip(sr, dr) if a != b][:1]
        res["detail"] = f"last-bit float differences, e.g. {diff}"
    return res


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    from spendstar.session import build_session
    from __spark_entry__ import queries
    spark = build_session("local[8]", 8)
    keys = argv[2:] or list(queries())
    con = duck(sf_dir)
    bad = 0
    for k in keys:
        try:
            r = compare(spark, k, sf_dir, con)
        except Exception as e:  # report and continue
            r = {"key": k, "status": "error", "detail": f"{type(e).__name__}: {str(e)[:400]}"}
        if r["status"] not in ("match", "no-oracle"):
            bad += 1
        print(r, flush=True)
    print(f"{len(keys) - bad}/{len(keys)} ok")


if __name__ == "__main__":
    main(sys.argv)
