"""Run registered queries and their DuckDB twins side by side and compare.

usage: python tests/check_oracle.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


EXACT = os.environ.get("ORACLE_EXACT") == "1"


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v if EXACT else float(f"{v:.9g}")
    if hasattr(v, "isoformat"):
        return v.isoformat()[:19]
    if hasattr(v, "tolist"):
        return tuple(v.tolist())
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if hasattr(v, "as_tuple"):  # Decimal
        return float(f"{float(v):.9g}")
    return v


def rows_of(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(norm(r[i]) for i in order) for r in records]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def compare(spark, con, name, fn, sql, sf_dir):
    t = time.time()
    sdf = fn(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    scols = sdf.columns
    ts = time.time() - t
    if sql is None:
        print(f"{name}: rows={len(srows)} (no oracle) {ts:.1f}s")
        return True
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    ok = True
    msgs = []
    if sorted(scols) != sorted(dcols):
        ok = False
        msgs.append(f"cols differ: spark-only={set(scols)-set(dcols)} duck-only={set(dcols)-set(scols)}")
    if len(srows) != len(drows):
        ok = False
        msgs.append(f"rowcount spark={len(srows)} duck={len(drows)}")
    if ok:
        a, b = rows_of(scols, srows), rows_of(dcols, drows)
        if a != b:
            ok = False
            diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
            msgs.append(f"values differ ({sum(1 for x, y in zip(a, b) if x != y)} rows), cols={sorted(scols)}")
            for x, y in diff:
                msgs.append(f"  spark={x}\n  duck ={y}")
    print(f"{name}: {'OK' if ok else 'MISMATCH'} rows={len(srows)} {ts:.1f}s")
    for m in msgs:
        print("   ", m)
    return ok


def main():
    args = sys.argv[1:]
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    names = args[1:]
    import __spark_entry__ as E
    from marquee.session import build_session
    spark = build_session()
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = []
    for name, fn in qs.items():
        if names and name not in names:
            continue
        try:
            if not compare(spark, con, name, fn, sqls.get(name), sf_dir):
                bad.append(name)
        except Exception as e:  # noqa: BLE001
            print(f"{name}: ERROR {type(e).__name__}: {str(e)[:400]}")
            bad.append(name)
    print("FAILED:", bad)


if __name__ == "__main__":
    main()
