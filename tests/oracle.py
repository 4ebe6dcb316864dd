"""Compares every named query with its SQL: `python tests/oracle.py [sf_dir] [name ...]`."""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import duckdb
import pandas as pd

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def connect(folder: str):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')")
    return con


def canonical(columns: list[str], rows) -> list[tuple]:
    """Rows with columns in name order, as sortable text."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = lambda v: None if v is pd.NaT else v
    return sorted(tuple(f"{type(plain(r[i])).__name__}:{plain(r[i])}" for i in order) for r in rows)


def compare(spark, con, folder: str, build, sql: str) -> str | None:
    df = build(spark, folder)
    got = canonical(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    want = canonical(names, cursor.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if len(got) != len(want):
        return f"{len(got)} rows, expected {len(want)}"
    wrong = [(g, w) for g, w in zip(got, want) if g != w]
    return f"{len(wrong)} rows differ, first {wrong[0]}" if wrong else None if want else "no rows to compare"


if __name__ == "__main__":
    from conftest import SESSION
    import __spark_entry__ as entry
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(entry.queries())
    con, failed = connect(folder), 0
    for name in names:
        begin = time.time()
        sql = entry.oracle_sql().get(name)
        try:
            if sql:
                problem = compare(SESSION, con, folder, entry.queries()[name], sql)
            else:
                problem = None if entry.queries()[name](SESSION, folder).collect() else "no rows"
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += bool(problem)
        print(f"{'FAIL' if problem else 'ok':4} {name} {time.time() - begin:.1f}s {problem or ''}", flush=True)
    print(f"{failed} failed of {len(names)}")
