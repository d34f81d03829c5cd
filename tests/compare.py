"""Side-by-side check of the registered queries against their SQL.

``python tests/compare.py [sf] [name ...]`` prints one line per query.
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN", "date": "DATE",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return connection


def _sortable(row: tuple) -> tuple:
    return tuple((value is None, str(value)) for value in row)


def difference(result, connection: duckdb.DuckDBPyConnection, sql: str) -> str:
    """Empty if rows, names and types agree, else what differs first."""
    expected = connection.sql(sql)
    ours = sorted((name, KINDS.get(kind, kind)) for name, kind in result.dtypes)
    theirs = sorted((name, str(kind)) for name, kind in zip(expected.columns, expected.types))
    if ours != theirs:
        return f"schema {sorted(set(ours) ^ set(theirs))}"
    names = sorted(result.columns)
    left = sorted((tuple(row) for row in result.select(*names).collect()), key=_sortable)
    right = sorted(expected.select(*[f'"{n}"' for n in names]).fetchall(), key=_sortable)
    if len(left) != len(right):
        return f"rows {len(left)} != {len(right)}"
    wrong = [(a, b) for a, b in zip(left, right) if a != b]
    if wrong:
        a, b = wrong[0]
        if all(
            x == y or (isinstance(x, float) and isinstance(y, float) and math.isclose(x, y, rel_tol=1e-9))
            for x, y in zip(a, b)
        ):
            return f"last digits differ in {len(wrong)} of {len(left)}: {a} {b}"
        return f"{len(wrong)} of {len(left)} rows differ: {dict(zip(names, a))} {dict(zip(names, b))}"
    return ""


def main(argv: list[str]) -> int:
    import __spark_entry__ as entry
    from tests.session import local_session

    folder = f"/root/testdata/sf{argv[0] if argv else '0.01'}"
    spark = local_session()
    connection = connect(folder)
    queries, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in argv[1:] or queries:
        started = time.monotonic()
        try:
            result = queries[name](spark, folder)
            if name in sqls:
                problem = difference(result, connection, sqls[name])
                note = f"{result.count()} rows" if not problem else problem
            else:
                problem, note = "", f"{result.count()} rows, no SQL"
        except Exception as error:  # noqa: BLE001 - reported per query
            problem = note = f"{type(error).__name__}: {str(error)[:600]}"
        bad += bool(problem)
        print(f"{'BAD ' if problem else 'ok  '} {name} {time.monotonic() - started:.1f}s {note}", flush=True)
    print(f"{bad} bad of {len(argv[1:] or queries)}")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
