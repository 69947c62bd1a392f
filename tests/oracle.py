"""Runs queries in Spark and their SQL in DuckDB, and compares the rows.

`python tests/oracle.py <data folder> [name ...]` prints one line per query.
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(data: str):
    db = duckdb.connect()
    for name in TABLES:
        db.sql(f"create view {name} as select * from '{data}/{name}.parquet'")
    return db


def _plain(value):
    if isinstance(value, float) and not math.isnan(value):
        return round(value, 9)
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(plain, key=lambda r: tuple((v is None, str(v)) for v in r))


def compare(spark, db, data: str, fn, sql: str) -> tuple[str | None, int]:
    """A description of the difference (None if there is none), and the row count."""
    got = fn(spark, data)
    want = db.sql(sql)
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} and {sorted(want.columns)}", 0
    left = _rows(got.columns, [tuple(r) for r in got.collect()])
    right = _rows(want.columns, want.fetchall())
    if left == right:
        return None, len(left)
    extra = [r for r in left if r not in set(right)][:3]
    lacking = [r for r in right if r not in set(left)][:3]
    return f"{len(left)} and {len(right)} rows; only Spark {extra}; only SQL {lacking}", len(left)


def main(data: str, names: list[str]) -> int:
    from palimpsest.session import session
    from palimpsest.suite import ORACLE, QUERIES

    spark = session(
        master="local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false", spark__driver__memory="8g"
    )
    spark.sparkContext.setLogLevel("ERROR")
    db, failed = connect(data), 0
    for name in names or QUERIES:
        start = time.time()
        try:
            if name in ORACLE:
                problem, rows = compare(spark, db, data, QUERIES[name], ORACLE[name])
            else:
                problem, rows = None, QUERIES[name](spark, data).count()
        except Exception as error:  # noqa: BLE001  (report and go on)
            problem, rows = f"{type(error).__name__}: {str(error)[:700]}", 0
        failed += problem is not None
        print(f"{'ok' if problem is None else 'FAIL':4} {name:36} {rows:8} rows {time.time() - start:6.2f}s {problem or ''}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
