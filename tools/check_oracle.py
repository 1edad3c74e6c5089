"""Runs queries against their SQL on the same tables: python tools/check_oracle.py [sf_dir] [key ...]"""

from __future__ import annotations

import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def normalized(columns: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    shaped = [tuple(repr(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(shaped)


def difference(df, con, sql: str) -> str | None:
    columns, rows = normalized(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    want_columns, want_rows = normalized([d[0] for d in result.description], result.fetchall())
    if columns != want_columns:
        return f"columns {columns} != {want_columns}"
    if len(rows) != len(want_rows):
        return f"{len(rows)} rows != {len(want_rows)}"
    wrong = [(a, b) for a, b in zip(rows, want_rows) if a != b]
    if wrong:
        return f"{len(wrong)} of {len(rows)} rows differ, first:\n  spark {wrong[0][0]}\n  sql   {wrong[0][1]}"
    return None


def main(sf_dir: str, keys: list[str]) -> int:
    from tidemark.registry import ORACLE, QUERIES
    from tidemark.session import build_session

    spark = build_session(
        master="local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false", spark__driver__memory="8g"
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(sf_dir), 0
    print("without SQL:", sorted(set(QUERIES) - set(ORACLE)), "SQL only:", sorted(set(ORACLE) - set(QUERIES)))
    for key in keys or QUERIES:
        start = time.time()
        try:
            df = QUERIES[key](spark, sf_dir)
            problem = difference(df, con, ORACLE[key]) if key in ORACLE else None
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:400]}"
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {key} {time.time() - start:.2f}s {problem or ''}", flush=True)
    print(f"{bad} bad")
    return bad


if __name__ == "__main__":
    args = sys.argv[1:]
    folder = args.pop(0) if args and "/" in args[0] else "/root/testdata/sf0.01"
    sys.exit(1 if main(folder, args) else 0)
