"""Registered queries: name -> (function, operators covered, oracle SQL or None)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    run: Query
    covers: tuple[str, ...]
    sql: str | None


ENTRIES: dict[str, Entry] = {}


def query(covers: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its own name; ``covers`` lists operator ids of the survey."""

    def add(run: Query) -> Query:
        if run.__name__ in ENTRIES:
            raise ValueError(f"{run.__name__} is registered twice")
        ENTRIES[run.__name__] = Entry(run, tuple(covers.split()), sql)
        return run

    return add


def r6(col: Column | str) -> Column:
    """Round to 6 decimals, the precision all results are compared at."""
    return F.round(F.col(col) if isinstance(col, str) else col, 6)


def rounded(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: r6(c) for c in cols})
