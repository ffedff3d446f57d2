"""Run registered queries in Spark and their oracle SQL in DuckDB and compare.

Usage: python tests/oracle_compare.py [sf_dir] [name ...]
Prints one line per query: rows, column names and an order-insensitive
value hash for both engines.
"""

from __future__ import annotations

import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402
import pandas as pd  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None or v is pd.NA:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        if v.is_integer():
            return str(int(v))
        return repr(float(v))
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, (pd.Timestamp,)):
        return str(v.to_pydatetime())
    return str(v)


def frame_hash(df: pd.DataFrame) -> str:
    cols = sorted(df.columns)
    rows = sorted("|".join(str(_norm(v)) for v in r) for r in df[cols].itertuples(index=False))
    return hashlib.sha1("\n".join(rows).encode()).hexdigest()[:12]


def compare(spark, sf_dir: str, names=None, verbose=True):
    import __spark_entry__ as E
    qs, oracle = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name in (names or qs):
        t0 = time.time()
        try:
            sp = qs[name](spark, sf_dir).toPandas()
        except Exception as e:  # noqa: BLE001
            results[name] = ("SPARK-ERROR", str(e)[:300])
            print(name, "SPARK-ERROR", str(e)[:300], flush=True)
            continue
        ts = time.time() - t0
        if name not in oracle:
            results[name] = ("rows-only", len(sp))
            print(f"{name}: spark rows={len(sp)} (no oracle) {ts:.1f}s", flush=True)
            continue
        try:
            t1 = time.time()
            du = con.execute(oracle[name]).df()
            td = time.time() - t1
        except Exception as e:  # noqa: BLE001
            results[name] = ("DUCK-ERROR", str(e)[:300])
            print(name, "DUCK-ERROR", str(e)[:300], flush=True)
            continue
        same_cols = sorted(sp.columns) == sorted(du.columns)
        hs, hd = frame_hash(sp), (frame_hash(du) if same_cols else "-")
        ok = same_cols and len(sp) == len(du) and hs == hd
        results[name] = ("OK" if ok else "MISMATCH", len(sp), len(du))
        print(f"{name}: {'OK' if ok else 'MISMATCH'} rows {len(sp)}/{len(du)} "
              f"cols_match={same_cols} spark {ts:.1f}s duck {td:.1f}s", flush=True)
        if not ok and verbose:
            if not same_cols:
                print("  spark cols", sorted(sp.columns), "\n  duck cols", sorted(du.columns))
            else:
                print("  spark dtypes", dict(sp.dtypes.astype(str)), "\n  duck dtypes", dict(du.dtypes.astype(str)))
                cols = sorted(sp.columns)
                a = sp[cols].astype(str).sort_values(cols).reset_index(drop=True)
                b = du[cols].astype(str).sort_values(cols).reset_index(drop=True)
                m = a.merge(b, how="outer", indicator=True)
                print(m[m["_merge"] != "both"].head(10).to_string())
    return results


if __name__ == "__main__":
    from sparkrec.session import get_spark
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_spark()
    res = compare(spark, sf, sys.argv[2:] or None)
    bad = [k for k, v in res.items() if v[0] not in ("OK", "rows-only")]
    print("SUMMARY", len(res), "queries;", len(bad), "not ok:", bad)
