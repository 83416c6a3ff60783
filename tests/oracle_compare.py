"""Run queries() against oracle_sql() on DuckDB and report differences.

Usage: python tests/oracle_compare.py [sf_dir] [key ...]
"""

from __future__ import annotations

import math
import sys
import time
from decimal import Decimal
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


STRICT = bool(__import__("os").environ.get("ORACLE_STRICT"))


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return (v + 0.0) if STRICT else round(v, 9)
    if isinstance(v, Decimal):
        return float(v) if STRICT else round(float(v), 9)
    if hasattr(v, "isoformat"):
        text = v.isoformat()[:19]
        return text[:10] if text.endswith("T00:00:00") else text
    if isinstance(v, bool):
        return int(v)
    return v


def rows_of(records, cols):
    out = [tuple(_norm(r[c]) for c in cols) for r in records]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def compare(spark, con, sf_dir, key, fn, sql):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    srows = [r.asDict() for r in sdf.collect()]
    t1 = time.time()
    scols = sorted(sdf.columns)
    if sql is None:
        return dict(key=key, ok=None, rows=len(srows), spark_s=round(t1 - t0, 2))
    pdf = con.execute(sql).df()
    ocols = sorted(pdf.columns)
    t2 = time.time()
    res = dict(key=key, rows=len(srows), oracle_rows=len(pdf), spark_s=round(t1 - t0, 2),
               oracle_s=round(t2 - t1, 2))
    if scols != ocols:
        res.update(ok=False, why=f"columns differ: {set(scols) ^ set(ocols)}")
        return res
    import pandas as pd

    def _clean(v):
        try:
            return None if pd.isna(v) else v
        except (TypeError, ValueError):
            return v

    orecs = [{c: _clean(v) for c, v in zip(pdf.columns, rec)} for rec in pdf.itertuples(index=False)]
    a, b = rows_of(srows, scols), rows_of(orecs, ocols)
    if a != b:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        res.update(ok=False, why=f"values differ, e.g. {diff}")
    else:
        res.update(ok=True)
    return res


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    keys = sys.argv[2:]
    import __spark_entry__ as E
    from outletlab.session import get_spark

    spark = get_spark("local[8]", 8)
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for key in keys or list(qs):
        try:
            res = compare(spark, con, sf_dir, key, qs[key], sqls.get(key))
        except Exception as exc:  # report and continue
            res = dict(key=key, ok=False, why=f"{type(exc).__name__}: {str(exc)[:400]}")
        bad += res.get("ok") is False
        print(res, flush=True)
    print("FAILED" if bad else "ALL OK", bad)


if __name__ == "__main__":
    main()
