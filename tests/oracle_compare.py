"""Run catalog queries in Spark and their oracle SQL in DuckDB, compare results.

Usage: python tests/oracle_compare.py [--tz ZONE] [sf_dir] [name ...]
Comparison: column names (sorted), row count, and the multiset of rows with
exact values (floats compared exactly; dates/timestamps as ISO strings).
"""

from __future__ import annotations

import datetime as dt
import decimal
import os
import sys
import time
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def norm(v):
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, float) and v == 0.0:
        return 0.0
    return v


def duck(sf_dir):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    srows = sdf.collect()
    st = time.time() - t0
    scols = sdf.columns
    if sql is None:
        return dict(name=name, ok=None, rows=len(srows), spark_s=round(st, 2), note="rows-only")
    cur = con.execute(sql)
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    res = dict(name=name, rows=len(srows), oracle_rows=len(drows), spark_s=round(st, 2))
    if sorted(scols) != sorted(dcols):
        res.update(ok=False, note=f"columns differ: {sorted(scols)} vs {sorted(dcols)}")
        return res
    order = sorted(scols)
    si = [scols.index(c) for c in order]
    di = [dcols.index(c) for c in order]
    sc = Counter(tuple(norm(r[i]) for i in si) for r in srows)
    dc = Counter(tuple(norm(r[i]) for i in di) for r in drows)
    if sc != dc:
        only_s = list((sc - dc).elements())[:3]
        only_d = list((dc - sc).elements())[:3]
        res.update(ok=False, note=f"values differ; spark-only {only_s}; oracle-only {only_d}; cols {order}")
        return res
    res.update(ok=True)
    return res


def main(argv):
    tz = None
    if "--tz" in argv:  # e.g. --tz America/Los_Angeles: results must not depend on the session zone
        i = argv.index("--tz")
        tz = argv[i + 1]
        argv = argv[:i] + argv[i + 2:]
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    import __spark_entry__ as E
    from tessera.session import local_session

    spark = local_session()
    if tz:
        spark.conf.set("spark.sql.session.timeZone", tz)
    con = duck(sf_dir)
    qs = E.queries()
    oracle = E.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        try:
            r = compare(spark, con, name, fn, oracle.get(name), sf_dir)
        except Exception as exc:  # report and continue
            r = dict(name=name, ok=False, note=f"{type(exc).__name__}: {str(exc)[:400]}")
        bad += r.get("ok") is False
        print(r, flush=True)
    print(f"FAILED {bad}" if bad else "ALL OK")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
