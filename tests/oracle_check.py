"""Parity harness: run each registered query in Spark and its SQL in DuckDB
over the same testdata and compare row count, column names and the
order-insensitive multiset of rows.

Usage: python tests/oracle_check.py [sf_dir] [name-substring ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 9)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 9)
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
    return v


def key(row):
    return tuple((x is None, str(type(x)), str(x)) for x in row)


def compare(spark_rows, spark_cols, duck_rows, duck_cols):
    if sorted(spark_cols) != sorted(duck_cols):
        return f"columns differ: spark={spark_cols} duck={duck_cols}"
    order = sorted(spark_cols)
    si = [spark_cols.index(c) for c in order]
    di = [duck_cols.index(c) for c in order]
    a = sorted((tuple(norm(r[i]) for i in si) for r in spark_rows), key=key)
    b = sorted((tuple(norm(r[i]) for i in di) for r in duck_rows), key=key)
    if len(a) != len(b):
        return f"row count differs: spark={len(a)} duck={len(b)}"
    for x, y in zip(a, b):
        if x != y:
            return f"first differing row:\n  spark={x}\n  duck ={y}\n  cols={order}"
    return None


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = sys.argv[2:]
    from tarn.session import get_session
    import __spark_entry__ as E
    spark = get_session("local[8]", shuffle_partitions=8)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    qs, sqls = E.queries(), E.oracle_sql()
    failed = 0
    for name, fn in qs.items():
        if only and not any(o in name for o in only):
            continue
        t0 = time.time()
        df = fn(spark, sf_dir)
        rows = [tuple(r) for r in df.collect()]
        t1 = time.time()
        sql = sqls.get(name)
        if sql is None:
            print(f"{name:34s} rows-only  spark={len(rows):8d} ({t1 - t0:.1f}s)")
            continue
        res = con.execute(sql)
        dcols = [d[0] for d in res.description]
        drows = res.fetchall()
        err = compare(rows, df.columns, drows, dcols)
        status = "OK  " if err is None else "FAIL"
        failed += err is not None
        print(f"{name:34s} {status} spark={len(rows):8d} duck={len(drows):8d} ({t1 - t0:.1f}s)")
        if err:
            print("   ", err)
    print("failed:", failed)
    sys.exit(1 if failed else 0)


if __name__ == "__main__":
    main()
