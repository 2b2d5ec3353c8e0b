"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

    python tools/check_oracle.py [--sf /root/testdata/sf0.01] [key ...]

Compares column names, row count and the sorted multiset of row values
(exact for ints/strings/dates, doubles compared after repr) like the driver.
"""

from __future__ import annotations

import argparse
import datetime as dt
import decimal
import math
import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else float(v)
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, dt.datetime):
        return v.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, bool):
        return int(v)
    return v


def key_of(row):
    return tuple((x is None, str(type(x)), x if x is not None else 0) for x in row)


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("keys", nargs="*")
    a = ap.parse_args()
    from fundlens.plans import registry
    from fundlens.session import get_session

    specs = registry.load_all()
    keys = a.keys or list(specs)
    spark = get_session("local[8]", 8)
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = f"{a.sf}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    bad = 0
    for k in keys:
        s = specs[k]
        t0 = time.time()
        try:
            df = s.build(spark, a.sf)
            cols = df.columns
            srows = [tuple(norm(x) for x in r) for r in df.collect()]
        except Exception:
            print(f"FAIL {k}: spark error\n{traceback.format_exc()[-1500:]}")
            bad += 1
            continue
        ts = time.time() - t0
        if not s.sql:
            print(f"ROWS {k}: {len(srows)} rows, cols={cols} ({ts:.1f}s)")
            continue
        try:
            cur = con.execute(s.sql)
            dcols = [d[0] for d in cur.description]
            drows = [tuple(norm(x) for x in r) for r in cur.fetchall()]
        except Exception as e:
            print(f"FAIL {k}: duckdb error {e}")
            bad += 1
            continue
        if sorted(cols) != sorted(dcols):
            print(f"FAIL {k}: columns spark={cols} duckdb={dcols}")
            bad += 1
            continue
        order = [dcols.index(c) for c in cols]
        drows = [tuple(r[i] for i in order) for r in drows]
        ss, dd = sorted(srows, key=key_of), sorted(drows, key=key_of)
        if len(ss) != len(dd):
            print(f"FAIL {k}: rows spark={len(ss)} duckdb={len(dd)}")
            bad += 1
            continue
        diff = [(x, y) for x, y in zip(ss, dd) if x != y]
        if diff:
            print(f"FAIL {k}: {len(diff)} differing rows, e.g. {diff[:2]}")
            bad += 1
        else:
            print(f"OK   {k}: {len(ss)} rows ({ts:.1f}s)")
    print(f"{len(keys) - bad}/{len(keys)} ok")
    spark.stop()


if __name__ == "__main__":
    main()
