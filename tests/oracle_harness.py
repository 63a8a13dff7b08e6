"""Runs a registered Spark query and its DuckDB oracle and compares the results.

Order-insensitive: columns are sorted by name, every value is normalised to
text, rows are sorted. Usable from tests and as a script:

    python -m tests.oracle_harness /root/testdata/sf0.01 [key ...]
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None or v is pd.NaT:
        return None
    try:
        if pd.isna(v):
            return None
    except (TypeError, ValueError):
        pass
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return repr(v + 0.0) if os.environ.get("ORACLE_EXACT") else repr(round(v, 9) + 0.0)
    if isinstance(v, pd.Timestamp):
        if pd.isna(v):
            return None
        return v.to_pydatetime().replace(tzinfo=None).isoformat()
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return dt.datetime(v.year, v.month, v.day).isoformat()
    if v is pd.NaT:
        return None
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, bool):
        return str(int(v))
    return str(v)


def canon(pdf: pd.DataFrame) -> tuple[list[str], list[tuple]]:
    cols = sorted(pdf.columns)
    rows = []
    for rec in pdf[cols].astype(object).itertuples(index=False, name=None):
        rows.append(tuple(_norm(x) for x in rec))
    rows.sort(key=lambda r: tuple("" if x is None else x for x in r))
    return cols, rows


def compare(spark, key: str, sf_dir: str, queries: dict, oracle: dict) -> dict:
    t0 = time.time()
    sdf = queries[key](spark, sf_dir)
    s_pdf = sdf.toPandas()
    t1 = time.time()
    out = {"key": key, "rows": len(s_pdf), "spark_sec": round(t1 - t0, 2)}
    if key not in oracle:
        out["oracle"] = "none"
        return out
    con = duck(sf_dir)
    o_pdf = con.execute(oracle[key]).df()
    out["oracle_rows"] = len(o_pdf)
    s_cols, s_rows = canon(s_pdf)
    o_cols, o_rows = canon(o_pdf)
    out["cols_ok"] = s_cols == o_cols
    out["rows_ok"] = len(s_rows) == len(o_rows)
    out["values_ok"] = s_cols == o_cols and s_rows == o_rows
    if not out["values_ok"]:
        out["spark_cols"], out["oracle_cols"] = s_cols, o_cols
        spark_set, oracle_set = set(s_rows), set(o_rows)
        diff_s = [r for r in s_rows if r not in oracle_set][:3]
        diff_o = [r for r in o_rows if r not in spark_set][:3]
        out["only_spark"], out["only_oracle"] = diff_s, diff_o
    return out


def main(argv: list[str]) -> int:
    sys.path.insert(0, ".")
    import __spark_entry__ as E
    from shiftlake.session import local_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    keys = argv[2:] or list(E.queries())
    spark = local_session()
    bad = 0
    for k in keys:
        try:
            r = compare(spark, k, sf_dir, E.queries(), E.oracle_sql())
        except Exception as exc:  # report and go on
            r = {"key": k, "error": repr(exc)[:600]}
        ok = r.get("values_ok", r.get("oracle") == "none")
        bad += 0 if ok else 1
        print(("OK  " if ok else "BAD ") + str(r), flush=True)
    print(f"{len(keys) - bad}/{len(keys)} ok")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv))
