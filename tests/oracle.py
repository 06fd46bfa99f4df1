"""Runs a query and its SQL over one folder of tables and compares the rows."""

import math
import os
from concurrent.futures import ThreadPoolExecutor

import duckdb

DATA = "/root/testdata"


def connect(sf):
    con = duckdb.connect()
    for f in sorted(os.listdir(f"{DATA}/{sf}")):
        if f.endswith(".parquet"):
            con.execute(f"create view {f[:-8]} as select * from read_parquet('{DATA}/{sf}/{f}')")
    return con


def norm(v):
    if isinstance(v, bool) or v is None:
        return str(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v + 0.0:.6g}"
    if isinstance(v, int):
        return f"{float(v):.6g}" if abs(v) < 1e6 else str(v)
    return str(v)


def rows(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], sorted(tuple(norm(r[i]) for i in order) for r in data)


def compare(spark, con, query, sql, sf):
    df = query(spark, f"{DATA}/{sf}")
    a = rows(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    b = rows([c[0] for c in cur.description], cur.fetchall())
    return a, b


def ahead(names, work, threads=6):
    """Start ``work`` on every name in threads, since planning tiny queries keeps one core busy; ``name -> future``."""
    pool = ThreadPoolExecutor(threads)
    return {n: pool.submit(work, n) for n in names}


def compared(spark, queries, oracles, sf):
    """Futures of the comparison of every query with its SQL."""
    con = connect(sf)
    return ahead(sorted(oracles), lambda n: compare(spark, con.cursor(), queries[n], oracles[n], sf))
