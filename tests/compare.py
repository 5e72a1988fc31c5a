"""Run registered queries against their SQL in DuckDB and compare whole results.

    python tests/compare.py [sf] [name ...]
"""

from __future__ import annotations

import os
import sys
import time
from decimal import Decimal

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(folder: str):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return f"{value:.6g}" if value == value else "nan"
    if isinstance(value, (list, tuple)):
        return str([plain(v) for v in value])
    return str(value)


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(plain(r[i]) for i in order) for r in rows)


def spark_result(df):
    return canonical(df.columns, [tuple(r) for r in df.collect()])


def duck_result(connection, sql):
    result = connection.execute(sql)
    columns = [d[0] for d in result.description]
    return canonical(columns, result.fetchall())


def difference(left, right):
    if left[0] != right[0]:
        return f"columns {left[0]} / {right[0]}"
    if len(left[1]) != len(right[1]):
        return f"rows {len(left[1])} / {len(right[1])}"
    wrong = [(a, b) for a, b in zip(left[1], right[1]) if a != b]
    return f"{len(wrong)} rows differ, first {str(wrong[0])[:600]}" if wrong else None


def main(sf="0.01", *names):
    from __spark_entry__ import oracle_sql, queries
    from kanaat.session import local_session

    folder = f"/root/testdata/sf{sf}"
    spark, connection = local_session(), connect(folder)
    failed = 0
    for name, run in queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            got = spark_result(run(spark, folder))
            seconds = time.time() - start
            sql = oracle_sql().get(name)
            problem = difference(got, duck_result(connection, sql)) if sql else None
            state = "ok" if sql else "rows only"
        except Exception as e:  # report and go on with the other queries
            got, problem, seconds = (None, []), f"{type(e).__name__} {str(e)[:800]}", time.time() - start
        failed += problem is not None
        print(f"{'FAIL ' + problem if problem else state:10} {name} rows={len(got[1])} {seconds:.2f}s", flush=True)
    print("failed", failed)
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(*sys.argv[1:]) else 0)
