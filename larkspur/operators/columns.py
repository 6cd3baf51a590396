"""Projection, naming and presentation of columns."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import NumericType, StringType


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]


def columns_of_type(df: DataFrame, *types: str) -> list[str]:
    """Names of the columns whose simple type string is one of ``types``."""
    return [name for name, dtype in df.dtypes if dtype in types]


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(mapping))


def rename_positional(df: DataFrame, names: Sequence[str]) -> DataFrame:
    if len(names) != len(df.columns):
        raise ValueError(f"{len(df.columns)} columns but {len(names)} names")
    return df.toDF(*names)


def sanitised_names(names: Iterable[str]) -> list[str]:
    """Lower-case snake names: ``blank`` when empty, ``col_`` before a digit, ``_n`` on repeats."""
    taken: set[str] = set()
    result = []
    for raw in names:
        slug = re.sub("_{2,}", "_", re.sub("[^0-9a-z_]", "_", raw.strip().lower())).strip("_") or "blank"
        slug = f"col_{slug}" if slug[0].isdigit() else slug
        name, n = slug, 0
        while name in taken:  # a suffixed name may itself be one of the names
            n += 1
            name = f"{slug}_{n}"
        taken.add(name)
        result.append(name)
    return result


def sanitise_names(df: DataFrame) -> DataFrame:
    return df.toDF(*sanitised_names(df.columns))


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip().lower() for c in df.columns])


def resolve_column(df: DataFrame, candidates: Sequence[str]) -> str:
    """First candidate that is a column of ``df``."""
    found = next((c for c in candidates if c in df.columns), None)
    if found is None:
        raise ValueError(f"none of {list(candidates)} among {df.columns}")
    return found


def resolve_columns(df: DataFrame, candidates: Sequence[Sequence[str]]) -> tuple[str, ...]:
    """First candidate tuple whose columns are all present."""
    present = set(df.columns)
    found = next((tuple(group) for group in candidates if present.issuperset(group)), None)
    if found is None:
        raise ValueError(f"none of {[list(c) for c in candidates]} complete among {df.columns}")
    return found


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast columns; a value that does not parse becomes null instead of failing the job."""
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items()})


def epoch_to_timestamp(seconds: Column | str) -> Column:
    """Seconds since the epoch (fractions dropped) to a timestamp in the session time zone."""
    return F.timestamp_seconds((F.col(seconds) if isinstance(seconds, str) else seconds).cast("long"))


def edge_columns(df: DataFrame, k: int = 5) -> DataFrame:
    """First and last ``k`` columns of a wide table; every column once if there are at most ``2k``."""
    names = df.columns
    return df if len(names) <= 2 * k else df.select(*names[:k], *names[-k:])


def first_columns(df: DataFrame, k: int) -> DataFrame:
    return df.select(*df.columns[:k])


def with_constants(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    return df.withColumns({name: F.lit(v) for name, v in values.items()})


def round_columns(df: DataFrame, decimals: int = 2, cols: Sequence[str] | None = None) -> DataFrame:
    """Round numeric columns (all, or those of ``cols`` that are numeric); the rest pass through."""
    if decimals < 0:
        raise ValueError("decimals must not be negative")
    unknown = [c for c in cols or [] if c not in df.columns]
    if unknown:
        raise ValueError(f"no such columns: {unknown}")
    chosen = set(numeric_columns(df)) & set(df.columns if cols is None else cols)
    return df.select(*[F.round(c, decimals).alias(c) if c in chosen else F.col(c) for c in df.columns])


def round_vectors(df: DataFrame, cols: Sequence[str] | str, decimals: int = 2, keep: Sequence[str] = ()) -> DataFrame:
    """Vector columns as rounded arrays named ``<column>_rounded``, next to the columns of ``keep``."""
    names = [cols] if isinstance(cols, str) else list(cols)
    unknown = [c for c in names if c not in df.columns]
    if unknown:
        raise ValueError(f"no such columns: {unknown}")
    return df.select(
        *keep, *[F.transform(vector_to_array(c), lambda x: F.round(x, decimals)).alias(f"{c}_rounded") for c in names]
    )


def vector_element(col: Column | str, i: int) -> Column:
    """Element ``i`` of a vector, such as the probability of one class."""
    return F.get(vector_to_array(col), F.lit(i))


def schema_report(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type, nullable."""
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "position int, name string, type string, nullable boolean")


def month_start(year: Column | str, month: Column | str) -> Column:
    """First day of the month given year and month columns."""
    as_col = lambda c: F.col(c) if isinstance(c, str) else c
    return F.make_date(as_col(year).cast("int"), as_col(month).cast("int"), F.lit(1))


def map_values(col: Column | str, mapping: Mapping[object, object], default: Column | None = None) -> Column:
    """Look a value up in a small literal mapping; ``default`` (null) where it is missing."""
    table = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    found = F.try_element_at(table, F.col(col) if isinstance(col, str) else col)
    return found if default is None else F.coalesce(found, default)


def preview(
    df: DataFrame, *cols: str, n: int = 5, distinct: bool = False, max_cols: int | None = None, order_by: Sequence[str] = ()
) -> DataFrame:
    """At most ``n`` rows of chosen columns, ordered when ``order_by`` is given."""
    out = df.select(*cols) if cols else df if max_cols is None else first_columns(df, max_cols)
    out = out.distinct() if distinct else out
    return (out.orderBy(*order_by) if order_by else out).limit(n)


def last_rows(df: DataFrame, n: int, order_by: Sequence[str]) -> DataFrame:
    """The ``n`` greatest rows by ``order_by``, returned in ascending order."""
    return df.orderBy(*[F.desc(c) for c in order_by]).limit(n).orderBy(*order_by)


def first_row(df: DataFrame, order_by: Sequence[str]) -> DataFrame:
    return df.orderBy(*order_by).limit(1)
