"""Spark-vs-DuckDB comparison used by the tests and by hand.

Mirrors the driver's gate: same column names (compared sorted), same row
count, same multiset of rows.  Floats are compared after rounding to 6
places so the check is about values, not printing.

    python tests/oracle_compare.py [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return v if os.environ.get("EXACT_FLOATS") == "1" else round(v, 6)
    if hasattr(v, "item"):
        return _norm(v.item())
    if hasattr(v, "to_pydatetime"):
        return v.to_pydatetime().replace(tzinfo=None)
    return v


def rows_of(records, cols):
    out = []
    for r in records:
        out.append(tuple(_norm(r[c]) for c in cols))
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


def compare(spark, name, fn, sql, sf_dir, con=None) -> dict:
    con = con or duck(sf_dir)
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    srows = [r.asDict() for r in sdf.collect()]
    t1 = time.time()
    scols = sorted(sdf.columns)
    res = {"query": name, "spark_rows": len(srows), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        res["status"] = "rows-only"
        return res
    rel = con.sql(sql)
    dcols = sorted(rel.columns)
    drecs = [dict(zip(rel.columns, t)) for t in rel.fetchall()]
    res["oracle_rows"] = len(drecs)
    if scols != dcols:
        res["status"] = f"COLUMNS {scols} vs {dcols}"
        return res
    a, b = rows_of(srows, scols), rows_of(drecs, scols)
    if a == b:
        res["status"] = "OK"
    else:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        res["status"] = "MISMATCH"
        res["cols"] = scols
        res["first_diffs"] = diff
    return res


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    only = set(argv[2:])
    import __spark_entry__ as E
    from flowlens.session import build_session
    spark = build_session(shuffle_partitions=8)
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if only and name not in only:
            continue
        try:
            r = compare(spark, name, fn, sqls.get(name), sf_dir, con)
        except Exception as e:  # report and continue
            r = {"query": name, "status": f"ERROR {type(e).__name__}: {str(e)[:300]}"}
        if r["status"] not in ("OK", "rows-only"):
            bad += 1
        print(r, flush=True)
    print("failures:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
