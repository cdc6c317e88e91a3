"""Run registered queries on Spark and their SQL on DuckDB; compare results.

usage: python tools/oracle_check.py [--sf DIR] [name ...]
Compares column names, row counts and an order-insensitive hash of values
(floats rounded to 6 places), like the driver's correctness gate.
"""

from __future__ import annotations

import argparse
import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from ragloom.plans.registry import load_all  # noqa: E402
from ragloom.session import local_session  # noqa: E402
from ragloom.sources.tables import TABLES  # noqa: E402


def norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NULL"
        return f"{round(v, 6):.6f}"
    if hasattr(v, "item"):
        return norm(v.item())
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(norm(x) for x in v) + "]"
    if isinstance(v, bool):
        return str(v)
    return str(v)


def rows_of(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(norm(r[i]) for i in order) for r in records)


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("names", nargs="*")
    a = ap.parse_args()
    reg = load_all()
    names = a.names or list(reg)
    spark = local_session(8)
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{a.sf}/{t}.parquet')")
    bad = 0
    for n in names:
        r = reg[n]
        t0 = time.time()
        try:
            sdf = r.fn(spark, a.sf)
            s_cols = sdf.columns
            s_rows = [tuple(x) for x in sdf.collect()]
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {n}: spark error {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        ts = time.time() - t0
        if not r.sql:
            print(f"ROWS {n}: spark rows={len(s_rows)} ({ts:.1f}s) cols={s_cols}")
            continue
        try:
            rel = con.execute(r.sql)
            d_cols = [c[0] for c in rel.description]
            d_rows = [tuple(x) for x in rel.fetchall()]
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {n}: duckdb error {str(e)[:400]}")
            bad += 1
            continue
        problems = []
        if sorted(s_cols) != sorted(d_cols):
            problems.append(f"cols spark={s_cols} duck={d_cols}")
        if len(s_rows) != len(d_rows):
            problems.append(f"rows spark={len(s_rows)} duck={len(d_rows)}")
        if not problems:
            a_rows, b_rows = rows_of(s_cols, s_rows), rows_of(d_cols, d_rows)
            ha = hashlib.md5("\n".join(a_rows).encode()).hexdigest()
            hb = hashlib.md5("\n".join(b_rows).encode()).hexdigest()
            if ha != hb:
                diff = [(x, y) for x, y in zip(a_rows, b_rows) if x != y][:3]
                problems.append(f"values differ, e.g. {diff}")
        if problems:
            bad += 1
            print(f"FAIL {n}: " + "; ".join(problems))
        else:
            print(f"OK   {n}: rows={len(s_rows)} ({ts:.1f}s)")
    print(f"{len(names) - bad}/{len(names)} ok")
    spark.stop()


if __name__ == "__main__":
    main()
