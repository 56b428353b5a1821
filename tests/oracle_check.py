"""Run registered queries on Spark and their oracle SQL on DuckDB, and compare.

Usage: python tests/oracle_check.py [sf_dir] [key ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time

import duckdb

from quarry.session import TABLES


def norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, (float, decimal.Decimal)):
        f = float(v)
        if math.isnan(f):
            return "nan"
        return round(f, 6) + 0.0
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr), [cols[i] for i in order]


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def check(spark, sf_dir, key, fn, sql, con):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    t_spark = time.time() - t0
    scols = sdf.columns
    if sql is None:
        return dict(key=key, ok=None, rows=len(srows), t=t_spark, note="no oracle")
    res = con.sql(sql)
    dcols = res.columns
    drows = res.fetchall()
    a, ac = rows_of(scols, srows)
    b, bc = rows_of(dcols, drows)
    ok = ac == bc and a == b
    note = ""
    if ac != bc:
        note = f"cols spark={ac} duck={bc}"
    elif len(a) != len(b):
        note = f"rows spark={len(a)} duck={len(b)}"
    elif a != b:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        note = f"values differ e.g. {diff}"
    return dict(key=key, ok=ok, rows=len(srows), t=t_spark, note=note)


def main(argv):
    import __spark_entry__ as E
    from quarry.session import get_spark

    sf = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    keys = argv[2:]
    spark = get_spark()
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf)
    bad = 0
    for k in keys or list(qs):
        try:
            r = check(spark, sf, k, qs[k], sqls.get(k), con)
        except Exception as exc:  # noqa: BLE001
            r = dict(key=k, ok=False, rows=-1, t=0, note=f"ERROR {type(exc).__name__}: {str(exc)[:300]}")
        bad += r["ok"] is False
        print(f"{r['key']:32s} {str(r['ok']):5s} rows={r['rows']:<7d} t={r['t']:.2f}s {r['note']}", flush=True)
    print("FAILED:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
