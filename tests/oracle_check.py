"""Compare every registered query with its DuckDB oracle.

Run as a script: ``python tests/oracle_check.py /root/testdata/sf0.01 [name...]``.
Also used by ``tests/test_oracle.py`` at the smallest scale.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(float(v))
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, int):
        return str(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    return str(v)


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("\x1f".join(str(_norm(r[i])) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest(), lines


def compare(spark, sf_dir: str, names=None, verbose=True):
    import __spark_entry__ as E

    qs, sql = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name in names or sorted(qs):
        t0 = time.time()
        df = qs[name](spark, sf_dir)
        s_cols = df.columns
        s_rows = [tuple(r) for r in df.collect()]
        t1 = time.time()
        if name not in sql:
            results[name] = {"ok": None, "rows": len(s_rows)}
            continue
        cur = con.execute(sql[name])
        d_cols = [d[0] for d in cur.description]
        d_rows = cur.fetchall()
        sd, sl = _digest(s_cols, s_rows)
        dd, dl = _digest(d_cols, d_rows)
        ok = sorted(s_cols) == sorted(d_cols) and len(s_rows) == len(d_rows) and sd == dd
        results[name] = {"ok": ok, "rows": len(s_rows), "oracle_rows": len(d_rows), "sec": round(t1 - t0, 2)}
        if verbose:
            print(f"{'OK ' if ok else 'BAD'} {name:28s} spark={len(s_rows):7d} duck={len(d_rows):7d} {t1 - t0:6.2f}s")
            if not ok:
                if sorted(s_cols) != sorted(d_cols):
                    print("   columns", sorted(s_cols), sorted(d_cols))
                else:
                    a, b = set(sl), set(dl)
                    print("   only spark:", sorted(a - b)[:3])
                    print("   only duck :", sorted(b - a)[:3])
    return results


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    res = compare(spark, sf, sys.argv[2:] or None)
    bad = [k for k, v in res.items() if v["ok"] is False]
    print("bad:", bad)
