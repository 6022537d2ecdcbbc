"""Run registered queries in Spark and their SQL in DuckDB, compare results.

Usage: python tests/oracle_compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from attrition.sources.testdata import TABLES  # noqa: E402


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None or v is pd.NA:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else v
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime()
    if isinstance(v, list | tuple):
        return tuple(_norm(x) for x in v)
    return v


def frame_rows(pdf: pd.DataFrame) -> tuple[list[str], list[tuple]]:
    cols = sorted(pdf.columns)
    rows = [tuple(_norm(v) for v in r) for r in pdf[cols].itertuples(index=False, name=None)]
    rows.sort(key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))
    return cols, rows


def compare(spark, sf_dir: str, name: str, fn, sql: str, con) -> tuple[bool, str]:
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    spdf = sdf.toPandas()
    t1 = time.time()
    dpdf = con.execute(sql).fetchdf()
    scols, srows = frame_rows(spdf)
    dcols, drows = frame_rows(dpdf)
    msg = f"{name}: spark {len(srows)} rows {t1 - t0:.1f}s, duck {len(drows)} rows"
    if scols != dcols:
        return False, msg + f" COLUMNS differ {scols} vs {dcols}"
    if len(srows) != len(drows):
        return False, msg + " ROWCOUNT differs"
    bad = [(a, b) for a, b in zip(srows, drows, strict=True) if a != b]
    if bad:
        return False, msg + f" {len(bad)} rows differ, first: {bad[0][0]} vs {bad[0][1]}"
    return True, msg + " OK"


def main(argv: list[str]) -> int:
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    import __spark_entry__ as E

    from attrition.session import local_session

    spark = local_session(8)
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    fails = 0
    for name in names or list(qs):
        if name not in sqls:
            df = qs[name](spark, sf_dir)
            print(f"{name}: no oracle, {df.count()} rows")
            continue
        try:
            ok, msg = compare(spark, sf_dir, name, qs[name], sqls[name], con)
        except Exception as e:  # noqa: BLE001
            ok, msg = False, f"{name}: ERROR {type(e).__name__}: {str(e)[:400]}"
        fails += not ok
        print(msg, flush=True)
    print(f"failures: {fails}")
    return 1 if fails else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
