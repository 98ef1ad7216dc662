"""Runs a query and its SQL side by side.

    python -m tests.oracle [folder] [name ...]
"""

from __future__ import annotations

import sys
import time
from decimal import Decimal

import duckdb

import __spark_entry__ as entry

GIVEN = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in GIVEN:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, float):
        return round(value, 6)
    return value


def in_order(names: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(plain(row[i]) for i in order) for row in rows]
    return [names[i] for i in order], sorted(out, key=repr)


def spark_rows(spark, name: str, folder: str):
    df = entry.queries()[name](spark, folder)
    return in_order(df.columns, df.collect())


def sql_rows(con, name: str):
    result = con.execute(entry.oracle_sql()[name])
    names = [d[0] for d in result.description]
    return in_order(names, result.fetchall())


def compare(spark, con, name: str, folder: str) -> str | None:
    """None when both sides agree, else a short account of the difference."""
    mine, rows = spark_rows(spark, name, folder)
    if name not in entry.oracle_sql():
        return None if rows else "no rows"
    theirs, expected = sql_rows(con, name)
    if mine != theirs:
        return f"columns {mine} and {theirs}"
    if rows != expected:
        extra = [r for r in rows if r not in set(expected)][:3]
        absent = [r for r in expected if r not in set(rows)][:3]
        return f"{len(rows)} and {len(expected)} rows; only Spark {extra}; only SQL {absent}"
    return None if rows else "no rows"


def main() -> None:
    from registrum.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(entry.queries())
    spark, con, bad = local_session(8), connect(folder), 0
    for name in names:
        start = time.time()
        try:
            problem = compare(spark, con, name, folder)
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:700]}"
        bad += problem is not None
        print(f"{time.time() - start:6.2f}s {'ok  ' if problem is None else 'FAIL'} {name}"
              + (f"\n        {problem}" if problem else ""), flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")


if __name__ == "__main__":
    main()
