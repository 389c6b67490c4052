"""Run registered queries beside their SQL and compare whole results.

    python tests/check.py [sf_dir] [query ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def canonical(value: object) -> object:
    if isinstance(value, bool):
        return int(value)
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    return value


def rows_of(columns: list[str], rows: list) -> list:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    found = [tuple(canonical(row[i]) for i in order) for row in rows]
    return sorted(found, key=lambda r: tuple((v is None, str(v)) for v in r))


def duck(sf_dir: str):
    import duckdb

    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def compare(spark, connection, sf_dir: str, query, sql: str) -> str | None:
    """None when equal, else what differs."""
    df = query(spark, sf_dir)
    got = rows_of(df.columns, df.collect())
    cursor = connection.execute(sql)
    names = [d[0] for d in cursor.description]
    want = rows_of(names, cursor.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns differ: {sorted(set(df.columns) ^ set(names))}"
    if len(got) != len(want):
        return f"{len(got)} rows, expected {len(want)}"
    different = [(a, b) for a, b in zip(got, want) if a != b]
    if different:
        a, b = different[0]
        cells = [(n, x, y) for n, x, y in zip(sorted(names), a, b) if x != y]
        return f"{len(different)} rows differ, first: {cells[:4]}"
    return None


def main() -> int:
    import __spark_entry__ as entry
    from tests.conftest import new_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(entry.queries())
    spark, connection = new_session(), duck(sf_dir)
    queries, sql, failures = entry.queries(), entry.oracle_sql(), 0
    for name in names:
        start = time.time()
        try:
            problem = compare(spark, connection, sf_dir, queries[name], sql[name]) if name in sql else "no SQL"
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failures += problem is not None
        print(f"{name:32s} {time.time() - start:6.2f}s  {problem or 'equal'}", flush=True)
    print(f"{failures} of {len(names)} differ")
    return 1 if failures else 0


if __name__ == "__main__":
    sys.exit(main())
