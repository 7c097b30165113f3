"""Run registered queries beside their checking SQL.

Usage: python tests/compare.py FOLDER [NAME ...]
"""

from __future__ import annotations

import datetime as dt
import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')"
        )
    return connection


def _cell(value):
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(value, bool) or value is None:
        return str(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, int):
        return str(value)
    return repr(value) if not isinstance(value, str) else value


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def difference(frame, connection, sql: str) -> str | None:
    """What differs between a Spark frame and the result of the SQL, or None."""
    rows = frame.collect()
    cursor = connection.execute(sql)
    names = [c[0] for c in cursor.description]
    expected = cursor.fetchall()
    if sorted(frame.columns) != sorted(names):
        return f"columns {sorted(frame.columns)} against {sorted(names)}"
    mine, theirs = _sorted_rows(frame.columns, rows), _sorted_rows(names, expected)
    if len(mine) != len(theirs):
        return f"{len(mine)} rows against {len(theirs)}"
    for a, b in zip(mine, theirs):
        if a != b:
            return f"first difference: {a} against {b}"
    return None


def main() -> int:
    from tidegauge.plans import ORACLES, QUERIES
    from tidegauge.session import local_session

    folder, names = sys.argv[1], sys.argv[2:] or list(QUERIES)
    spark, connection = local_session("8"), connect(folder)
    failures = 0
    for name in names:
        begun = time.perf_counter()
        try:
            frame = QUERIES[name](spark, folder)
            if name in ORACLES:
                problem = difference(frame, connection, ORACLES[name])
                size = f"{connection.execute(f'SELECT count(*) FROM ({ORACLES[name]})').fetchall()[0][0]} rows"
            else:
                problem, size = None, f"{frame.count()} rows, no SQL"
        except Exception as error:  # noqa: BLE001
            problem, size = f"{type(error).__name__}: {str(error)[:600]}", ""
        failures += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.perf_counter() - begun:.2f}s {size}"
              f"{' ' + problem if problem else ''}", flush=True)
    print(f"{len(names) - failures} of {len(names)} agree")
    return failures


if __name__ == "__main__":
    raise SystemExit(main())
