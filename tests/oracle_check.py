"""Run registered queries against their DuckDB oracles (row count, columns, values).

Usage: python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb
import pandas as pd

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().replace(tzinfo=None).isoformat()
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def canon(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    rows = [tuple(_norm(v) for v in r) for r in df[cols].astype(object).itertuples(index=False, name=None)]
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


def compare(spark, sf_dir: str, name: str, fn, sql: str | None, con) -> tuple[bool, str]:
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    got = sdf.toPandas()
    dt = time.time() - t0
    if sql is None:
        return True, f"{name}: {len(got)} rows (no oracle) {dt:.1f}s"
    exp = con.execute(sql).df()
    if sorted(got.columns) != sorted(exp.columns):
        return False, f"{name}: columns {sorted(got.columns)} != {sorted(exp.columns)}"
    if len(got) != len(exp):
        return False, f"{name}: rows {len(got)} != {len(exp)}"
    a, b = canon(got), canon(exp)
    if a != b:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        return False, f"{name}: values differ, e.g. {diff}"
    return True, f"{name}: ok {len(got)} rows {dt:.1f}s"


def main(argv: list[str]) -> int:
    from tideline.session import local_session
    import __spark_entry__ as entry

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:]
    spark = local_session(8)
    con = duck(sf_dir)
    qs, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        try:
            ok, msg = compare(spark, sf_dir, name, fn, sqls.get(name), con)
        except Exception as e:  # report and continue
            ok, msg = False, f"{name}: ERROR {type(e).__name__}: {str(e)[:400]}"
        bad += not ok
        print(("PASS " if ok else "FAIL ") + msg, flush=True)
    print(f"{len(qs) if not names else len(names)} checked, {bad} failed")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
