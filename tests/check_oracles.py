"""Compare every query with its DuckDB oracle: ``python tests/check_oracles.py [sf_dir] [name ...]``."""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb

import __spark_entry__ as entry_points

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def normal(value):
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.9g}")
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted([tuple(normal(r[i]) for i in order) for r in rows], key=repr)


def compare(spark, con, sf_dir: str, name: str) -> str | None:
    """NULL when equal, else what differs."""
    df = entry_points.queries()[name](spark, sf_dir)
    got_columns, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(entry_points.oracle_sql()[name])
    want_columns, want = rows_of([d[0] for d in cur.description], cur.fetchall())
    if got_columns != want_columns:
        return f"columns {got_columns} != {want_columns}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    for g, w in zip(got, want):
        if g != w or [type(x) for x in g] != [type(x) for x in w]:
            return f"first difference\n  spark  {g!r:.600}\n  oracle {w!r:.600}"
    return None


def main() -> int:
    from hiremill.session import build_session

    args = sys.argv[1:]
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    spark = build_session("oracles", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name in args[1:] or entry_points.queries():
        start = time.time()
        try:
            if name in entry_points.oracle_sql():
                verdict = compare(spark, con, sf_dir, name)
            else:
                n = entry_points.queries()[name](spark, sf_dir).count()
                verdict = None if n else "no rows"
        except Exception as exc:
            verdict = f"{type(exc).__name__}: {str(exc)[:900]}"
        bad += verdict is not None
        print(f"{'ok  ' if verdict is None else 'BAD '} {name} {time.time() - start:.2f}s {verdict or ''}", flush=True)
    print("bad:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
