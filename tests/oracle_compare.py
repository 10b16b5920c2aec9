"""Local stand-in for the driver's correctness gate: run each registered Spark query
and its DuckDB oracle on the same parquet tables and compare row count, column
names and an order-insensitive value hash.

    python tests/oracle_compare.py [sf_dir] [key ...]
"""

from __future__ import annotations

import hashlib
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402,F401
from yardstick.sources.derived import TABLES  # noqa: E402


def _norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return bool(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if isinstance(v, int):
        return int(v)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, (bytes, bytearray)):
        return bytes(v).hex()
    return str(v)


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16]


SPARK_TO_DUCK = {"LongType": "BIGINT", "IntegerType": "INTEGER", "DoubleType": "DOUBLE", "StringType": "VARCHAR",
                 "BooleanType": "BOOLEAN", "BinaryType": "BLOB", "FloatType": "FLOAT", "ShortType": "SMALLINT"}


def _types(sdf):
    return {f.name: SPARK_TO_DUCK.get(type(f.dataType).__name__, type(f.dataType).__name__) for f in sdf.schema.fields}


def compare(spark, con, sf_dir, key, fn, sql):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    scols = sdf.columns
    dt = time.time() - t0
    if sql is None:
        return dict(key=key, rows=len(srows), oracle=None, sec=round(dt, 2))
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    ok_cols = sorted(scols) == sorted(dcols)
    ok_n = len(srows) == len(drows)
    ok_h = ok_cols and _digest(scols, srows) == _digest(dcols, drows)
    dtypes = {d[0]: str(d[1]) for d in res.description}
    ok_t = all(t == dtypes.get(c) for c, t in _types(sdf).items())
    return dict(key=key, rows=len(srows), oracle_rows=len(drows), cols=ok_cols, count=ok_n, hash=ok_h, types=ok_t,
                sec=round(dt, 2), scols=None if ok_cols else scols, dcols=None if ok_cols else dcols)


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and os.path.isdir(argv[1]) else "/root/testdata/sf0.01"
    keys = [a for a in argv[1:] if not os.path.isdir(a)]
    from yardstick.session import local_session

    spark = local_session()
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    qs, oracle = entry.queries(), entry.oracle_sql()
    bad = 0
    for key, fn in qs.items():
        if keys and key not in keys:
            continue
        try:
            r = compare(spark, con, sf_dir, key, fn, oracle.get(key))
        except Exception as e:  # report and continue
            r = dict(key=key, error=f"{type(e).__name__}: {str(e)[:400]}")
        good = "error" not in r and (r.get("oracle") is None and "hash" not in r or r.get("hash"))
        bad += 0 if good else 1
        print(("OK  " if good else "BAD ") + str(r), flush=True)
    print(f"{len(qs)} queries, {bad} failing")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
