"""Run the registered queries next to their SQL and compare whole results."""

from __future__ import annotations

import datetime
import decimal
import glob
import os
import time

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[:-8]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _plain(v):
    if isinstance(v, decimal.Decimal):
        return ("n", round(float(v), 6))
    if isinstance(v, bool):
        return ("b", v)
    if isinstance(v, (int, float)):
        return ("n", round(float(v), 6))
    if isinstance(v, datetime.datetime):
        return ("t", v.isoformat())
    if isinstance(v, datetime.date):
        return ("d", v.isoformat())
    return ("s", "" if v is None else str(v), v is None)


def rows(names, data):
    order = sorted(range(len(names)), key=lambda n: names[n])
    return sorted(tuple(_plain(r[n]) for n in order) for r in data)


def compare(spark, con, name, fn, sql, sf_dir):
    started = time.time()
    df = fn(spark, sf_dir)
    got = df.collect()
    took = time.time() - started
    if sql is None:
        return None, len(got), took, "no sql"
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = cur.fetchall()
    if sorted(names) != sorted(df.columns):
        return False, len(got), took, f"columns {sorted(set(names) ^ set(df.columns))}"
    a, b = rows(df.columns, got), rows(names, want)
    if a == b:
        return True, len(got), took, ""
    left = [x for x in a if x not in set(b)][:2]
    right = [x for x in b if x not in set(a)][:2]
    return False, len(got), took, f"{len(a)} vs {len(b)}\n  spark {left}\n  sql   {right}\n  {sorted(names)}"


if __name__ == "__main__":
    import sys

    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as e
    from ledgerline.session import build_session

    sf = sys.argv[1]
    wanted = sys.argv[2:]
    spark = build_session(master="local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="12g")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    sqls = e.oracle_sql()
    for name, fn in e.queries().items():
        if wanted and name not in wanted:
            continue
        try:
            ok, n, took, note = compare(spark, con, name, fn, sqls.get(name), sf)
        except Exception as err:  # noqa: BLE001
            ok, n, took, note = False, -1, 0, f"{type(err).__name__}: {str(err)[:600]}"
        print(f"{'OK ' if ok else 'ROWS' if ok is None else 'BAD'} {name:26s} rows={n:<7d} {took:6.2f}s {note}", flush=True)
