"""Compare registered queries with their SQL in DuckDB: python -m tests.crosscheck [sf] [names…]."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import tempfile
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, decimal.Decimal):
        return f"{v.normalize():f}"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{decimal.Decimal(repr(v)).normalize():f}"
    if isinstance(v, dt.datetime) and v.tzinfo:
        return str(v.replace(tzinfo=None))
    return str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in rows)


def compare(df, con, sql):
    """Return None on equality, else a text that names the first differences."""
    got = rows_of(df.columns, df.collect())
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = rows_of(names, cur.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if got != want:
        extra, lost = sorted(set(got) - set(want))[:3], sorted(set(want) - set(got))[:3]
        return f"{len(got)} vs {len(want)} rows in {sorted(names)}\n   spark {extra}\n   duck  {lost}"
    if not got:
        return "no rows"
    return None


def types_differ(df, con, sql):
    simple = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
              "boolean": "BOOLEAN"}
    got = {n: simple.get(t, t.upper()) for n, t in df.dtypes}
    want = {r[0]: r[1] for r in con.execute(f"describe {sql}").fetchall()}
    return {n: (got[n], want.get(n)) for n in got if got[n] != want.get(n)}


if __name__ == "__main__":
    from wharfline import suite
    from wharfline.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "sf0.01"
    names = sys.argv[2:] or list(suite.QUERIES)
    path = f"/root/testdata/{sf}"
    spark = local_session("crosscheck", os.environ.get("CROSSCHECK_CPUS", "8"), scratch=tempfile.mkdtemp(prefix="crosscheck-"))
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(path)
    bad = 0
    for name in names:
        start = time.time()
        try:
            df = suite.QUERIES[name](spark, path)
            if name in suite.ORACLE:
                problem = compare(df, con, suite.ORACLE[name])
                typed = types_differ(df, con, suite.ORACLE[name]) if not problem else None
            else:
                problem, typed = (None if df.count() else "no rows"), None
        except Exception as e:  # noqa: BLE001 - report and go on
            problem, typed = f"{type(e).__name__}: {str(e)[:1500]}", None
        bad += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - start:.2f}s {problem or ''} {typed or ''}", flush=True)
    print("failed:", bad)
