"""Compare a registered Spark query with its DuckDB oracle.

Mirrors the driver's gate: same column names, same row count, same types
(by family), same multiset of rows after rounding doubles.

CLI: ``python -m tests.oracle_check [sf_dir] [name ...]``
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb
import numpy as np
import pandas as pd

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    con.execute("SET TimeZone='UTC'")
    return con


def _family(dtype, values=None) -> str:
    k = getattr(dtype, "kind", "O")
    if k == "O" and values is not None:
        first = next((v for v in values if v is not None), None)
        if first is not None and hasattr(first, "isoformat") and not hasattr(first, "hour"):
            return "datetime"  # datetime.date from Spark, datetime64 from DuckDB
    if k in "iu":
        return "int"
    if k == "f":
        return "float"
    if k == "b":
        return "bool"
    if k == "M":
        return "datetime"
    return "object"


def _norm_value(v, digits: int):
    if v is None or v is pd.NA or v is pd.NaT or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, (float, np.floating)):
        x = float(v)
        if x == 0:
            return 0.0
        mag = math.floor(math.log10(abs(x)))
        return round(x, max(digits - 1 - mag, 0))
    if isinstance(v, (np.integer,)):
        return int(v)
    if isinstance(v, (list, tuple, np.ndarray)):
        return tuple(_norm_value(x, digits) for x in v)
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().replace(tzinfo=None)
    if hasattr(v, "isoformat") and not hasattr(v, "hour"):  # datetime.date
        return pd.Timestamp(v).to_pydatetime()
    return v


def normalise(df: pd.DataFrame, digits: int = 9) -> list[tuple]:
    cols = sorted(df.columns)
    rows = [tuple(_norm_value(v, digits) for v in r) for r in df[cols].itertuples(index=False, name=None)]
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


def compare(spark_pdf: pd.DataFrame, duck_pdf: pd.DataFrame, digits: int = 9) -> list[str]:
    problems = []
    if sorted(spark_pdf.columns) != sorted(duck_pdf.columns):
        return [f"columns differ: spark={sorted(spark_pdf.columns)} duck={sorted(duck_pdf.columns)}"]
    if len(spark_pdf) != len(duck_pdf):
        problems.append(f"row count spark={len(spark_pdf)} duck={len(duck_pdf)}")
    for c in spark_pdf.columns:
        fs, fd = _family(spark_pdf[c].dtype, spark_pdf[c]), _family(duck_pdf[c].dtype, duck_pdf[c])
        nullable_int = {fs, fd} == {"int", "float"} and (spark_pdf[c].isna().any() or duck_pdf[c].isna().any())
        if fs != fd and not nullable_int and not (len(spark_pdf) == 0 or len(duck_pdf) == 0):
            problems.append(f"type of {c}: spark={spark_pdf[c].dtype} duck={duck_pdf[c].dtype}")
    if not problems:
        a, b = normalise(spark_pdf, digits), normalise(duck_pdf, digits)
        if a != b:
            bad = [(x, y) for x, y in zip(a, b) if x != y][:3]
            problems.append(f"values differ, first: {bad}")
    return problems


def check(spark, sf_dir: str, names=None, digits: int = 9, verbose: bool = True) -> dict[str, list[str]]:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as E
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    out = {}
    for name in names or sorted(sqls):
        t0 = time.time()
        try:
            s = qs[name](spark, sf_dir).toPandas()
            d = con.sql(sqls[name]).df()
            out[name] = compare(s, d, digits)
        except Exception as e:  # report and continue
            out[name] = [f"error: {type(e).__name__}: {str(e)[:400]}"]
        if verbose:
            status = "ok" if not out[name] else "FAIL " + "; ".join(out[name])
            print(f"{name:40s} {time.time() - t0:6.1f}s {status}", flush=True)
    return out


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from mercato.session import build_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or None
    spark = build_session("local[8]")
    spark.sparkContext.setLogLevel("ERROR")
    res = check(spark, sf, names)
    bad = [k for k, v in res.items() if v]
    print(f"{len(res) - len(bad)}/{len(res)} match; failing: {bad}")
