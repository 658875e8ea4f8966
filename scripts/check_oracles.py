"""Run every registered query on Spark and its SQL twin on DuckDB; compare
row counts, column names and order-insensitive values. Usage:
python scripts/check_oracles.py [sf_dir] [name ...]"""

from __future__ import annotations

import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, __file__.rsplit("/scripts/", 1)[0])

from sackcast.plans.registry import QUERIES, oracle_sql  # noqa: E402
from sackcast.session import local_session  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def _cell(v):
    if v is None or (not isinstance(v, (list, dict)) and pd.isna(v)):
        return None
    if isinstance(v, pd.Timestamp):
        v = v.to_pydatetime()
    if hasattr(v, "hour") and (v.hour, v.minute, v.second) == (0, 0, 0):
        v = v.date()
    return str(v)[:19]


def _norm(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        s = df[c]
        if pd.api.types.is_float_dtype(s):
            df[c] = s.round(9).map(lambda v: None if pd.isna(v) else repr(float(v) + 0.0))
        else:
            df[c] = s.map(_cell)
    return df.sort_values(list(df.columns)).reset_index(drop=True)


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = local_session()
    import os
    if os.environ.get("SPARK_TZ"):
        spark.conf.set("spark.sql.session.timeZone", os.environ["SPARK_TZ"])
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf}/{t}.parquet')")
    sql = oracle_sql()
    ok = 0
    for n in names:
        t0 = time.time()
        try:
            sp = QUERIES[n](spark, sf).toPandas()
        except Exception as e:  # noqa: BLE001
            print(f"{n:28s} SPARK ERROR {str(e)[:300]}")
            continue
        t1 = time.time()
        if n not in sql:
            print(f"{n:28s} rows={len(sp)} (no oracle) {t1 - t0:.1f}s")
            continue
        try:
            dk = con.execute(sql[n]).df()
        except Exception as e:  # noqa: BLE001
            print(f"{n:28s} DUCKDB ERROR {str(e)[:600]}")
            continue
        t2 = time.time()
        same_cols = sorted(sp.columns) == sorted(dk.columns)
        same_rows = len(sp) == len(dk)
        eq = False
        if same_cols and same_rows:
            a, b = _norm(sp), _norm(dk)
            eq = a.equals(b)
            if not eq:
                diff = (a != b) & ~(a.isna() & b.isna())
                bad = diff.any()
                print("   differing columns:", list(bad[bad].index)[:8])
                i = diff.any(axis=1).idxmax()
                print("   spark :", a.iloc[i].to_dict())
                print("   duckdb:", b.iloc[i].to_dict())
        ok += eq
        print(f"{n:28s} rows={len(sp)}/{len(dk)} cols={'ok' if same_cols else (sorted(sp.columns), sorted(dk.columns))} "
              f"values={'MATCH' if eq else 'DIFF'} spark={t1 - t0:.1f}s duck={t2 - t1:.1f}s")
    print(f"{ok}/{len(names)} match")


if __name__ == "__main__":
    main()
