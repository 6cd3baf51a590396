"""Run registered queries next to their DuckDB oracles and compare values.

usage: python tools/check_oracles.py [sf folder] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import pathlib
import sys
import time

import duckdb

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def normal(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return ("null",)
    if isinstance(value, bool):
        return ("bool", value)
    if isinstance(value, int):
        return ("int", value)
    if isinstance(value, float):
        return ("float", 0.0 if value == 0 else value)
    if isinstance(value, decimal.Decimal):
        return ("decimal", str(value))
    if isinstance(value, dt.datetime):
        return ("timestamp", value.isoformat())
    if isinstance(value, dt.date):
        return ("date", value.isoformat())
    if isinstance(value, (list, tuple)):
        return ("list", tuple(normal(v) for v in value))
    return ("text", str(value))


def compare(spark_df, con, sql: str) -> tuple[str | None, int]:
    """(difference or None, rows)."""
    cols = sorted(spark_df.columns)
    mine = sorted((tuple(normal(v) for v in row) for row in spark_df.select(*[f"`{c}`" for c in cols]).collect()), key=repr)
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    if sorted(names) != cols:
        return f"columns {cols} against {sorted(names)}", len(mine)
    at = [names.index(c) for c in cols]
    theirs = sorted((tuple(normal(row[i]) for i in at) for row in cursor.fetchall()), key=repr)
    if len(mine) != len(theirs):
        return f"{len(mine)} rows against {len(theirs)}", len(mine)
    wrong = [(a, b) for a, b in zip(mine, theirs) if a != b]
    if wrong:
        return f"{len(wrong)} of {len(mine)} rows differ, columns {cols}, first {wrong[0]}", len(mine)
    return None, len(mine)


def main(argv: list[str]) -> int:
    from larkspur.catalog import ENTRIES
    from larkspur.session import local_session

    folder = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(ENTRIES)
    spark, con, failed = local_session(8), connect(folder), 0
    for name in names:
        entry, started = ENTRIES[name], time.time()
        try:
            if entry.sql is None:
                problem, n = None, entry.run(spark, folder).count()
            else:
                problem, n = compare(entry.run(spark, folder), con, entry.sql)
        except Exception as error:  # report and go on with the next query
            problem, n = f"{type(error).__name__}: {str(error)[:600]}", -1
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name:28s} {'E' if entry.sql else 'R'} {n:8d} rows {time.time() - started:6.2f} s  {problem or ''}", flush=True)
    print(f"{len(names)} queries, {failed} failed")
    return failed


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]) > 0)
