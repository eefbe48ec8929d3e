"""Run a registered Spark query and its DuckDB oracle side by side (local check tool).

Usage: python tests/compare.py SF_DIR [name ...]
Prints one line per query: name, spark rows, oracle rows, column match, value match.
"""

from __future__ import annotations

import datetime
import decimal
import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v if os.environ.get("EXACT_FLOATS") else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, (datetime.datetime, datetime.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return [norm(x) for x in v]
    if isinstance(v, dict):
        return {k: norm(x) for k, x in sorted(v.items())}
    if hasattr(v, "asDict"):
        return norm(v.asDict())
    return v


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted(repr([norm(r[i]) for i in order]) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest(), lines


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def main():
    sf_dir = sys.argv[1]
    names = sys.argv[2:]
    import __spark_entry__ as E
    from noticespark.session import get_session
    spark = get_session()
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name in names or sorted(qs):
        t = time.time()
        try:
            df = qs[name](spark, sf_dir)
            cols = df.columns
            rows = [tuple(r) for r in df.collect()]
        except Exception as e:  # noqa: BLE001
            print(f"{name:32s} SPARK-ERROR {str(e)[:300]}")
            bad += 1
            continue
        ts = time.time() - t
        if name not in sqls:
            print(f"{name:32s} rows={len(rows):7d} (no oracle) {ts:.1f}s")
            continue
        try:
            res = con.execute(sqls[name])
            ocols = [d[0] for d in res.description]
            orows = res.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"{name:32s} SQL-ERROR {str(e)[:300]}")
            bad += 1
            continue
        d1, l1 = digest(cols, rows)
        d2, l2 = digest(ocols, orows)
        ok = sorted(cols) == sorted(ocols) and d1 == d2
        bad += 0 if ok else 1
        print(f"{name:32s} rows={len(rows):7d}/{len(orows):7d} cols={'ok' if sorted(cols) == sorted(ocols) else 'DIFF'} "
              f"values={'ok' if d1 == d2 else 'DIFF'} {ts:.1f}s")
        if not ok:
            if sorted(cols) != sorted(ocols):
                print("   spark cols:", sorted(cols), "\n   sql cols:  ", sorted(ocols))
            s1, s2 = set(l1), set(l2)
            for x in sorted(s1 - s2)[:3]:
                print("   spark only:", x[:400])
            for x in sorted(s2 - s1)[:3]:
                print("   sql only:  ", x[:400])
    print("mismatches:", bad)


if __name__ == "__main__":
    main()
