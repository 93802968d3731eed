"""Run the named Spark queries and their DuckDB SQL side by side.

    python tests/oracle_compare.py [sf_dir] [name ...]

Prints one line per query: rows on both sides, column match and whether the
order-insensitive multiset of rows is equal.
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

ROUND = not os.environ.get("COMPARE_BITS")  # else doubles must be equal bit for bit

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return round(v, 6) if ROUND else v
    if isinstance(v, dt.datetime):
        return v.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def canon(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cols = [columns[i] for i in order]
    body = sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)
    return cols, body


def compare(spark, sf_dir: str, names=None):
    import __spark_entry__ as E

    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name in names or sorted(qs):
        t0 = time.time()
        sdf = qs[name](spark, sf_dir)
        srows = [tuple(r) for r in sdf.collect()]
        scols, sbody = canon(sdf.columns, srows)
        t1 = time.time()
        if name not in sqls:
            results[name] = dict(spark_rows=len(srows), oracle=None, spark_s=round(t1 - t0, 2))
            print(f"{name:34s} spark={len(srows):7d}  (no SQL)  {t1 - t0:.1f}s", flush=True)
            continue
        rel = con.sql(sqls[name])
        ocols, obody = canon(rel.columns, rel.fetchall())
        t2 = time.time()
        same_cols = scols == ocols
        same = same_cols and sbody == obody
        results[name] = dict(spark_rows=len(srows), oracle_rows=len(obody), cols=same_cols, equal=same)
        print(f"{name:34s} spark={len(srows):7d} duck={len(obody):7d} cols={same_cols} equal={same} "
              f"{t1 - t0:.1f}s/{t2 - t1:.1f}s", flush=True)
        if not same_cols:
            print("   spark cols", scols, "\n   duck  cols", ocols)
        elif not same:
            sset, oset = set(sbody), set(obody)
            print("   only spark:", sorted(sset - oset, key=repr)[:5])
            print("   only duck: ", sorted(oset - sset, key=repr)[:5])
    return results


if __name__ == "__main__":
    from salescp.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8, 8)
    compare(spark, sf, sys.argv[2:] or None)
