"""Run catalogue queries next to their SQL twins: ``python -m tests.check [sf] [name ...]``."""

from __future__ import annotations

import sys
import time
from collections import Counter

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    return con


def rows_of(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(row[i] for i in order) for row in rows)


def compare(spark, con, run, sql: str, sf_dir: str) -> str | None:
    """None if both sides give the same rows, else what differs."""
    df = run(spark, sf_dir)
    ours = rows_of(df.columns, df.collect())
    twin = con.execute(sql)
    names = [d[0] for d in twin.description]
    theirs = rows_of(names, twin.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} / {sorted(names)}"
    if ours != theirs:
        only, missing = ours - theirs, theirs - ours
        return (f"{sum(ours.values())} / {sum(theirs.values())} rows, only ours "
                f"{list(only)[:2]}, only theirs {list(missing)[:2]}")
    return None if ours else "no rows on either side"


def main(args: list[str]) -> int:
    from tests.conftest import build_session
    from __spark_entry__ import oracle_sql, queries
    sf_dir = f"/root/testdata/sf{args[0] if args else '0.001'}"
    spark, con, sql, failed = build_session(), connect(sf_dir), oracle_sql(), 0
    for name, run in queries().items():
        if args[1:] and name not in args[1:]:
            continue
        began = time.time()
        try:
            problem = compare(spark, con, run, sql[name], sf_dir) if name in sql else "no SQL"
        except Exception as error:  # noqa: BLE001  report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{name:28s} {time.time() - began:6.2f}s  {problem or 'ok'}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
