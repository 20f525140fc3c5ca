"""Spark result vs DuckDB oracle: row count, column names, order-insensitive values.

Usage: python tests/oracle_compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time
from collections import Counter

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return format(v.normalize(), "f")
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return norm(v.asDict())
    if hasattr(v, "item"):
        return norm(v.item())
    return v


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    names = [cols[i] for i in order]
    return names, Counter(tuple(norm(r[i]) for i in order) for r in rows)


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark, sf_dir, names=None, verbose=True):
    from __spark_entry__ import oracle_sql, queries
    qs, oracle = queries(), oracle_sql()
    con = duck(sf_dir)
    report = {}
    for name in names or sorted(qs):
        t0 = time.time()
        try:
            df = qs[name](spark, sf_dir)
            srows = [tuple(r) for r in df.collect()]
            scols = df.columns
        except Exception as e:  # noqa: BLE001
            report[name] = f"SPARK ERROR {type(e).__name__}: {str(e)[:300]}"
            if verbose:
                print(name, report[name], flush=True)
            continue
        ts = time.time() - t0
        if name not in oracle:
            report[name] = f"rows-only {len(srows)}"
            if verbose:
                print(f"{name:22s} {report[name]} ({ts:.1f}s)", flush=True)
            continue
        try:
            cur = con.execute(oracle[name])
            ocols = [d[0] for d in cur.description]
            orows = cur.fetchall()
        except Exception as e:  # noqa: BLE001
            report[name] = f"DUCKDB ERROR {str(e)[:300]}"
            if verbose:
                print(name, report[name], flush=True)
            continue
        sn, sc = canon(scols, srows)
        on, oc = canon(ocols, orows)
        if sn != on:
            report[name] = f"COLUMNS {sn} vs {on}"
        elif sc != oc:
            only_s = list((sc - oc).items())[:3]
            only_o = list((oc - sc).items())[:3]
            report[name] = (f"VALUES spark={len(srows)} oracle={len(orows)} "
                            f"spark-only={only_s} oracle-only={only_o}")
        else:
            report[name] = f"OK {len(srows)}"
        if verbose:
            print(f"{name:22s} {report[name]} ({ts:.1f}s)", flush=True)
    return report


if __name__ == "__main__":
    from ledgerlake.session import build_session
    args = sys.argv[1:]
    sf = "/root/testdata/sf0.01"
    if args and args[0].startswith("/"):
        sf, args = args[0], args[1:]
    spark = build_session()
    rep = compare(spark, sf, args or None)
    bad = {k: v for k, v in rep.items() if not (v.startswith("OK") or v.startswith("rows-only"))}
    print(f"\n{len(rep) - len(bad)}/{len(rep)} pass")
    for k, v in bad.items():
        print("FAIL", k, v)
