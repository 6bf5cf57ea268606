"""Run catalogue queries in Spark and their SQL in DuckDB; compare like the driver.

usage: python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def norm(v):
    if v is None:
        return "None"
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(round(v, 9))
    if isinstance(v, bool):
        return str(v)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return str(v)


def digest(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(norm(r[i]) for i in order) for r in rows)
    return hashlib.md5("\n".join(lines).encode()).hexdigest(), lines


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    from voxtide.session import build_session
    import __spark_entry__ as E
    spark = build_session("local[8]", shuffle_partitions=8)
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name in (names or list(qs)):
        t0 = time.time()
        try:
            df = qs[name](spark, sf)
            cols = df.columns
            rows = [tuple(r) for r in df.collect()]
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: spark error {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        dt = time.time() - t0
        if name not in sqls:
            print(f"rows {name}: {len(rows)} rows (no oracle) {dt:.1f}s")
            continue
        try:
            rel = con.sql(sqls[name])
            ocols = rel.columns
            orows = rel.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: duckdb error {str(e)[:400]}")
            bad += 1
            continue
        h1, l1 = digest(rows, cols)
        h2, l2 = digest(orows, ocols)
        ok = sorted(cols) == sorted(ocols) and len(rows) == len(orows) and h1 == h2
        if ok:
            print(f"ok   {name}: {len(rows)} rows {dt:.1f}s")
        else:
            bad += 1
            print(f"FAIL {name}: cols {sorted(cols)} vs {sorted(ocols)}; rows {len(rows)} vs {len(orows)}")
            s1, s2 = set(l1), set(l2)
            for x in list(s1 - s2)[:3]:
                print("   spark only:", x[:300])
            for x in list(s2 - s1)[:3]:
                print("   duck  only:", x[:300])
    print(f"{bad} failures")
    spark.stop()


if __name__ == "__main__":
    main()
