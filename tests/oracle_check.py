"""Run every registered query in Spark and its oracle in DuckDB; compare row
count, column names and an order-insensitive hash of the values.

    python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import hashlib
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as E  # noqa: E402
from tidewatch.session import get_session  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(round(v, 9))
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ")
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    return repr(v)


def digest(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16], lines


def duck(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    spark = get_session("local[8]", shuffle_partitions=8)
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        t0 = time.time()
        df = fn(spark, sf_dir)
        rows = [tuple(r) for r in df.collect()]
        t1 = time.time()
        if name not in sqls:
            print(f"{name:34s} spark rows={len(rows)} (no oracle) {t1 - t0:.2f}s")
            continue
        rel = con.sql(sqls[name])
        o_cols = rel.columns
        o_rows = rel.fetchall()
        t2 = time.time()
        h1, l1 = digest(df.columns, rows)
        h2, l2 = digest(o_cols, o_rows)
        ok = len(rows) == len(o_rows) and sorted(df.columns) == sorted(o_cols) and h1 == h2
        bad += not ok
        print(f"{name:34s} {'OK ' if ok else 'BAD'} rows={len(rows)}/{len(o_rows)} "
              f"spark={t1 - t0:.2f}s duck={t2 - t1:.2f}s")
        if not ok:
            if sorted(df.columns) != sorted(o_cols):
                print("   columns", df.columns, o_cols)
            s1, s2 = set(l1), set(l2)
            for x in list(s1 - s2)[:3]:
                print("   spark-only", x[:300])
            for x in list(s2 - s1)[:3]:
                print("   oracle-only", x[:300])
    print("mismatches:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
