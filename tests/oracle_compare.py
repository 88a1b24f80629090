"""Run registered queries in Spark and their DuckDB oracle side by side.

Usage: python tests/oracle_compare.py [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None or v is pd.NA:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        if math.isinf(v):
            return v
        return round(v, 6)
    if hasattr(v, "isoformat"):
        return str(v)[:10] if len(str(v)) >= 10 and str(v)[10:].strip("0: ") == "" else str(v)
    try:
        import numpy as np

        if isinstance(v, np.generic):
            return _norm(v.item())
    except ImportError:
        pass
    return v


def rows(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    out = [tuple(_norm(x) for x in r) for r in df[cols].itertuples(index=False, name=None)]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


def compare(spark, con, name: str, query, sql: str | None, sf_dir: str) -> dict:
    t0 = time.time()
    sdf = query(spark, sf_dir)
    s = sdf.toPandas()
    t1 = time.time()
    res = {"query": name, "spark_rows": len(s), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        res["status"] = "rows-only"
        return res
    o = con.sql(sql).df()
    res["oracle_rows"] = len(o)
    res["oracle_sec"] = round(time.time() - t1, 2)
    if sorted(s.columns) != sorted(o.columns):
        res["status"] = f"COLUMNS {sorted(s.columns)} vs {sorted(o.columns)}"
        return res
    a, b = rows(s), rows(o)
    if a == b:
        res["status"] = "match"
    else:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        res["status"] = f"MISMATCH rows {len(a)} vs {len(b)}; first diffs {diff}"
    return res


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not a.startswith("/")]
    from servicelens.session import local_session
    import __spark_entry__ as E

    spark = local_session()
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    for name in names or list(qs):
        try:
            r = compare(spark, con, name, qs[name], sqls.get(name), sf_dir)
        except Exception as e:  # report and continue
            r = {"query": name, "status": f"ERROR {type(e).__name__}: {str(e)[:400]}"}
        print(r, flush=True)


if __name__ == "__main__":
    main(sys.argv)
