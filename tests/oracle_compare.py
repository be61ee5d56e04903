"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

Usage: python tests/oracle_compare.py [sf_dir] [name ...]

The comparison mirrors the driver: columns sorted by name, rows sorted,
row count + column names + per-cell equality (exact; floats compared after
the rounding both sides already apply).
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (0, "")
        return (1, repr(v))
    if hasattr(v, "isoformat"):
        return (1, v.isoformat())
    if isinstance(v, (list, tuple)):
        return (1, repr([_norm(x) for x in v]))
    return (1, repr(v))


def rows_of(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cols = [columns[i] for i in order]
    rows = sorted(tuple(_norm(r[i]) for i in order) for r in records)
    return cols, rows


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    srecs = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    scols, srows = rows_of(sdf.columns, srecs)
    if sql is None:
        return {"name": name, "status": "rows-only", "rows": len(srows),
                "spark_s": round(t1 - t0, 2)}
    res = con.execute(sql)
    dcols_raw = [d[0] for d in res.description]
    drecs = res.fetchall()
    dcols, drows = rows_of(dcols_raw, drecs)
    out = {"name": name, "spark_rows": len(srows), "oracle_rows": len(drows),
           "spark_s": round(t1 - t0, 2)}
    if scols != dcols:
        out["status"] = "SCHEMA"
        out["detail"] = (sorted(set(scols) - set(dcols)), sorted(set(dcols) - set(scols)))
        return out
    if srows != drows:
        out["status"] = "VALUES"
        diffs = [(a, b) for a, b in zip(srows, drows) if a != b][:2]
        detail = []
        for a, b in diffs:
            detail.append([(scols[i], a[i], b[i]) for i in range(len(a)) if a[i] != b[i]][:6])
        out["detail"] = detail
        return out
    out["status"] = "OK"
    return out


def main():
    args = sys.argv[1:]
    sf_dir = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in args if not a.startswith("/")]
    import __spark_entry__ as E
    from fareflow.session import local_session
    spark = local_session(8, 8)
    qs, oracle = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name in names or sorted(qs):
        try:
            r = compare(spark, con, name, qs[name], oracle.get(name), sf_dir)
        except Exception as e:  # report and continue
            r = {"name": name, "status": "ERROR", "detail": str(e)[:600]}
        bad += r["status"] not in ("OK", "rows-only")
        print(r, flush=True)
    print(f"{len(names or qs) - bad} ok / {bad} failing")


if __name__ == "__main__":
    main()
