"""Run registered queries in Spark and their oracle SQL in DuckDB; compare like the driver.

usage: python tools/oracle_check.py [sf_dir] [name-prefix ...]
"""
from __future__ import annotations

import hashlib
import math
import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402
import pandas as pd  # noqa: E402

from tidemark.registry import load_all  # noqa: E402
from tidemark.session import get_session  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, int):
        return v
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        if math.isinf(v):
            return str(v)
        if v.is_integer():
            return int(v)
        return round(v, 6) + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if hasattr(v, "tolist"):
        return norm(v.tolist())
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().replace(tzinfo=None).isoformat()
    if hasattr(v, "isoformat"):
        return v.replace(tzinfo=None).isoformat() if hasattr(v, "tzinfo") else v.isoformat()
    return v


def rows_of(df: pd.DataFrame):
    cols = sorted(df.columns)
    out = []
    for rec in df[cols].itertuples(index=False):
        out.append(tuple(norm(None if (not isinstance(x, (list, tuple)) and not hasattr(x, "tolist") and pd.isna(x)) else x) for x in rec))
    return cols, sorted(out, key=repr)


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 and os.path.isdir(sys.argv[1]) else "/root/testdata/sf0.01"
    prefixes = [a for a in sys.argv[1:] if a != sf]
    spark = get_session("local[8]", 8)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    reg = load_all()
    ok = bad = 0
    for name, (fn, sql) in sorted(reg.items()):
        if prefixes and not any(name.startswith(p) for p in prefixes):
            continue
        t0 = time.time()
        try:
            sdf = fn(spark, sf)
            sp = sdf.toPandas()
            ts = time.time() - t0
            if sql is None:
                print(f"ROWS  {name}: {len(sp)} rows ({ts:.1f}s)")
                ok += 1
                continue
            dp = con.execute(sql).df()
            msgs = []
            if sorted(sp.columns) != sorted(dp.columns):
                msgs.append(f"cols spark-only={sorted(set(sp.columns)-set(dp.columns))} duck-only={sorted(set(dp.columns)-set(sp.columns))}")
            else:
                dtypes = con.execute(f"DESCRIBE ({sql})").fetchall()
                dmap = {r[0]: r[1] for r in dtypes}
                smap = {f.name: f.dataType.simpleString() for f in sdf.schema.fields}
                canon = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                         "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN", "date": "DATE", "array<double>": "DOUBLE[]",
                         "array<string>": "VARCHAR[]", "array<bigint>": "BIGINT[]", "smallint": "SMALLINT", "tinyint": "TINYINT"}
                tm = [f"{c}: spark={smap[c]} duck={dmap[c]}" for c in smap if canon.get(smap[c], smap[c]) != dmap[c]]
                if tm:
                    msgs.append("types " + "; ".join(tm[:6]))
                if len(sp) != len(dp):
                    msgs.append(f"rows spark={len(sp)} duck={len(dp)}")
                else:
                    c1, r1 = rows_of(sp)
                    c2, r2 = rows_of(dp)
                    if r1 != r2:
                        diff = [(a, b) for a, b in zip(r1, r2) if a != b][:2]
                        msgs.append(f"values differ, e.g. {diff}")
            if msgs:
                bad += 1
                print(f"FAIL  {name} ({ts:.1f}s): " + " | ".join(msgs)[:1500])
            else:
                ok += 1
                print(f"OK    {name}: {len(sp)} rows ({ts:.1f}s)")
        except Exception as e:  # noqa: BLE001
            bad += 1
            print(f"ERROR {name}: {type(e).__name__}: {str(e)[:800]}")
            if os.environ.get("TRACE"):
                traceback.print_exc()
    print(f"== ok {ok}  bad {bad}")


if __name__ == "__main__":
    main()
