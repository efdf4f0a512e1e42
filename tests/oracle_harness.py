"""Run registered queries in Spark and their oracle SQL in DuckDB, compare as the driver does.

Usage: python tests/oracle_harness.py [sf_dir] [key ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.sources.tables import TABLES  # noqa: E402


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    con.execute("SET TimeZone='UTC'")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return v
    if hasattr(v, "item"):
        try:
            return _norm(v.item())
        except Exception:
            pass
    return v


def canon(df: pd.DataFrame) -> list[tuple]:
    df = df[sorted(df.columns)]
    rows = [tuple(_norm(v) for v in r) for r in df.itertuples(index=False, name=None)]
    return sorted(rows, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


def _kind(dtype) -> str:
    k = getattr(dtype, "kind", "O")
    return {"i": "int", "u": "int", "f": "float", "b": "bool", "M": "time"}.get(k, "obj")


def compare(spark_pdf: pd.DataFrame, duck_pdf: pd.DataFrame) -> tuple[bool, str]:
    if sorted(spark_pdf.columns) != sorted(duck_pdf.columns):
        return False, f"columns differ: {sorted(spark_pdf.columns)} vs {sorted(duck_pdf.columns)}"
    if len(spark_pdf) and len(duck_pdf):
        kinds = [(c, str(spark_pdf[c].dtype), str(duck_pdf[c].dtype)) for c in sorted(spark_pdf.columns)
                 if str(spark_pdf[c].dtype) != str(duck_pdf[c].dtype)
                 and not (_kind(spark_pdf[c].dtype) == "obj" and _kind(duck_pdf[c].dtype) == "obj")]
        if kinds:
            return False, f"dtypes differ: {kinds}"
    if len(spark_pdf) != len(duck_pdf):
        return False, f"rows differ: {len(spark_pdf)} vs {len(duck_pdf)}"
    a, b = canon(spark_pdf), canon(duck_pdf)
    if a != b:
        for x, y in zip(a, b):
            if x != y:
                return False, f"first diff: spark={x} duck={y} (cols {sorted(spark_pdf.columns)})"
    return True, f"{len(a)} rows"


def run(sf_dir: str, keys: list[str] | None = None) -> dict[str, tuple[bool, str]]:
    import __spark_entry__ as E
    from tidemark.session import local_session
    spark = local_session()
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    out = {}
    for k in keys or list(qs):
        t0 = time.time()
        try:
            sdf = qs[k](spark, sf_dir).toPandas()
            t1 = time.time()
            if k not in sqls:
                out[k] = (True, f"no oracle; {len(sdf)} rows")
            else:
                ddf = con.execute(sqls[k]).fetchdf()
                out[k] = compare(sdf, ddf)
            msg = f"{t1 - t0:.1f}s"
        except Exception as e:  # report and go on
            out[k] = (False, f"error: {type(e).__name__}: {str(e)[:400]}")
            msg = ""
        print(f"{'OK ' if out[k][0] else 'BAD'} {k:34s} {msg:7s} {out[k][1]}", flush=True)
    return out


if __name__ == "__main__":
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    res = run(sf, sys.argv[2:] or None)
    bad = [k for k, v in res.items() if not v[0]]
    print(f"{len(res) - len(bad)}/{len(res)} ok; bad: {bad}")
