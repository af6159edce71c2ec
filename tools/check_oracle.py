"""Run registered Spark queries against their DuckDB oracles.

usage: python tools/check_oracle.py [--sf DIR] [name-prefix ...]

Compares column names (sorted), row counts and the multiset of rows
(exactly, and with a float tolerance to flag near misses).
"""

from __future__ import annotations

import argparse
import datetime as dt
import decimal
import math
import os
import sys
import time
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def norm(v, digits=None):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return round(v, digits) if digits is not None else v
    if isinstance(v, decimal.Decimal):
        return norm(float(v), digits)
    if isinstance(v, bool):
        return v
    if isinstance(v, int):
        return v
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x, digits) for x in v)
    return str(v)


def rows_of(cols, rows, digits=None):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(norm(r[i], digits) for i in order) for r in rows)


def main() -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args()

    from listinglab.plans.registry import ORACLE, QUERIES, load_all
    from listinglab.session import local_session

    load_all()
    spark = local_session()
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{args.sf}/{t}.parquet')")

    names = [n for n in QUERIES if not args.names or any(n.startswith(p) for p in args.names)]
    bad = 0
    for name in names:
        t0 = time.time()
        try:
            df = QUERIES[name](spark, args.sf)
            scols = df.columns
            srows = [tuple(r) for r in df.collect()]
        except Exception as e:  # noqa: BLE001
            print(f"FAIL  {name}: spark error {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        ts = time.time() - t0
        sql = ORACLE.get(name)
        if sql is None:
            print(f"ROWS  {name}: {len(srows)} rows (no oracle) {ts:.1f}s")
            continue
        try:
            cur = con.execute(sql)
            ocols = [d[0] for d in cur.description]
            orows = cur.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL  {name}: duckdb error {str(e)[:400]}")
            bad += 1
            continue
        if sorted(scols) != sorted(ocols):
            print(f"FAIL  {name}: columns spark={sorted(scols)} oracle={sorted(ocols)}")
            bad += 1
            continue
        a, b = rows_of(scols, srows), rows_of(ocols, orows)
        if a == b:
            print(f"OK    {name}: {len(srows)} rows {ts:.1f}s")
            continue
        a6, b6 = rows_of(scols, srows, 6), rows_of(ocols, orows, 6)
        tag = "NEAR " if a6 == b6 else "FAIL "
        bad += 1
        print(f"{tag} {name}: spark={len(srows)} oracle={len(orows)} rows")
        da, db = a - b, b - a
        for r in list(da)[:3]:
            print("      spark-only ", r)
        for r in list(db)[:3]:
            print("      oracle-only", r)
    print(f"{len(names) - bad}/{len(names)} ok")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main())
