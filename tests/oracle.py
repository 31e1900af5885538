"""Run registered queries beside their SQL and compare row sets exactly.

    python tests/oracle.py [--sf DIR] [names...]
"""

from __future__ import annotations

import argparse
import datetime
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return ("null", "")
    if isinstance(v, bool):
        return ("bool", str(v))
    if isinstance(v, int):
        return ("int", str(v))
    if isinstance(v, float):
        return ("float", repr(v + 0.0))
    if isinstance(v, (list, tuple)):
        return ("list", str([norm(x) for x in v]))
    if isinstance(v, (datetime.date, datetime.datetime)):
        return ("date", v.isoformat())
    return (type(v).__name__, str(v))


def table(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], sorted(tuple(norm(r[i]) for i in order) for r in rows)


def compare(spark, con, name, fn, sql, sf_dir):
    """None if equal, else a short text."""
    df = fn(spark, sf_dir)
    cols, rows = table(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return None if rows else "no rows"
    cur = con.execute(sql)
    want_cols = [d[0] for d in cur.description]
    want_cols, want = table(want_cols, cur.fetchall())
    if cols != want_cols:
        return f"columns {cols} != {want_cols}"
    if len(rows) != len(want):
        return f"{len(rows)} rows != {len(want)}; {rows[:2]} / {want[:2]}"
    if not rows:
        return "no rows"
    bad = [(a, b) for a, b in zip(rows, want) if a != b]
    if bad:
        return f"{len(bad)} of {len(rows)} rows differ: {bad[:2]}"
    return None


def main():
    import __spark_entry__ as entry

    from tablewright.session import get_session

    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args()
    spark = get_session("oracle", "local[8]", **{"spark.sql.shuffle.partitions": 8, "spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(args.sf)
    sqls = entry.oracle_sql()
    failed = 0
    for name, fn in entry.queries().items():
        if args.names and name not in args.names:
            continue
        t0 = time.time()
        try:
            out = compare(spark, con, name, fn, sqls.get(name), args.sf)
        except Exception as e:
            out = f"{type(e).__name__}: {str(e)[:1500]}"
        kind = "S" if name in sqls else "P"
        print(f"{'ok  ' if out is None else 'FAIL'} {kind} {name} {time.time() - t0:.1f}s {out or ''}", flush=True)
        failed += out is not None
    print("failed:", failed)
    spark.stop()
    sys.exit(failed > 0)


if __name__ == "__main__":
    main()
