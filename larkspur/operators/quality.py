"""Filters, missing-data profiles and cleaning rules; each profile is one pass."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.ml.feature import Imputer, ImputerModel
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, FloatType, NumericType

from larkspur.operators.columns import numeric_columns, string_columns


def _floats(df: DataFrame) -> set[str]:
    return {f.name for f in df.schema.fields if isinstance(f.dataType, (FloatType, DoubleType))}


def is_missing(df: DataFrame, name: str) -> Column:
    """Null, or NaN where the column can hold one."""
    c = F.col(name)
    return c.isNull() | F.isnan(c) if name in _floats(df) else c.isNull()


def any_missing(df: DataFrame, cols: Sequence[str] | None = None) -> Column:
    return reduce(or_, [is_missing(df, c) for c in cols or df.columns], F.lit(False))


def rows_with_missing(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    return df.filter(any_missing(df, cols))


def non_blank(col: str) -> Column:
    return F.length(F.trim(F.col(col))) > 0


def per_column(df: DataFrame, measures: Mapping[str, Mapping[str, Column]], group: str = "column") -> DataFrame:
    """Aggregate once, then turn the single wide row into one row per column.

    ``measures`` is ``{output name: {source column: aggregate}}``.
    """
    names = list(dict.fromkeys(c for by_col in measures.values() for c in by_col))
    flat = df.agg(*[agg.alias(f"{m}|{c}") for m, by_col in measures.items() for c, agg in by_col.items()])
    rows = F.array(
        *[
            F.struct(F.lit(c).alias(group), *[F.col(f"`{m}|{c}`").alias(m) for m in measures])
            for c in names
        ]
    )
    return flat.select(F.inline(rows))


def null_counts(df: DataFrame) -> DataFrame:
    return per_column(df, {"missing": {c: F.count_if(F.col(c).isNull()) for c in df.columns}})


def missing_counts(df: DataFrame) -> DataFrame:
    return per_column(df, {"missing": {c: F.count_if(is_missing(df, c)) for c in df.columns}})


def zero_counts(df: DataFrame) -> DataFrame:
    return per_column(df, {"zeros": {c: F.count_if(F.col(c) == 0) for c in numeric_columns(df)}})


def approx_distinct_counts(df: DataFrame, rsd: float = 0.05) -> DataFrame:
    return per_column(df, {"approx_distinct": {c: F.approx_count_distinct(c, rsd) for c in df.columns}})


def column_values(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Every distinct value of the string columns with its count, in one job."""
    names = list(cols or string_columns(df))
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in names])
    return df.select(F.inline(pairs)).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def zeros_to_missing(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Treat 0 as a missing reading; the columns become double and hold NaN."""
    return df.withColumns({c: F.when(F.col(c) != 0, F.col(c).cast("double")).otherwise(F.lit(float("nan"))) for c in cols})


def infinities_to_null(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    names = _floats(df) & set(cols or df.columns)
    inf = float("inf")
    return df.withColumns({c: F.when(F.abs(F.col(c)) != inf, F.col(c)) for c in sorted(names)}) if names else df


def impute_mean(df: DataFrame, cols: Sequence[str], suffix: str = "") -> DataFrame:
    """Replace null and NaN by the column mean (as double, so whole numbers are not truncated)."""
    return mean_imputer(df, cols, suffix).transform(_as_double(df, cols))


def mean_imputer(df: DataFrame, cols: Sequence[str], suffix: str = "") -> ImputerModel:
    imputer = Imputer(strategy="mean", inputCols=list(cols), outputCols=[c + suffix for c in cols])
    return imputer.fit(_as_double(df, cols))


def _as_double(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in cols})


def fill_by_type(df: DataFrame, number: float = 0, text: str = "Unknown") -> DataFrame:
    """Null in numeric columns becomes ``number``, in string columns ``text``."""
    fills = {f.name: number for f in df.schema.fields if isinstance(f.dataType, NumericType)}
    return df.fillna({**fills, **{c: text for c in string_columns(df)}})


def fill_when(df: DataFrame, col: str, rules: Sequence[tuple[Column, object]]) -> DataFrame:
    """Fill nulls of ``col`` by the first rule that holds; ``rules`` are (condition, value) in order."""
    filled = reduce(lambda acc, rule: acc.when(F.col(col).isNull() & rule[0], F.lit(rule[1])), rules, F)
    return df.withColumn(col, filled.otherwise(F.col(col)))


def numbers_or_zero(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Cast to double; what is null or does not parse becomes 0."""
    return df.withColumns({c: F.coalesce(F.col(c).try_cast("double"), F.lit(0.0)) for c in cols})


def reconcile(df: DataFrame, total: Column | str, parts: Sequence[Column | str], name: str = "difference") -> DataFrame:
    """Add ``total`` minus the sum of ``parts`` for each row."""
    as_col = lambda c: F.col(c) if isinstance(c, str) else c
    return df.withColumn(name, as_col(total) - reduce(lambda a, b: a + b, map(as_col, parts)))


def matching_share(df: DataFrame, **conditions: Column) -> DataFrame:
    """Rows matching each condition and their share of all rows, one pass."""
    everything = F.count(F.lit(1))
    return df.agg(
        everything.alias("n_rows"),
        *[F.count_if(c).alias(f"n_{name}") for name, c in conditions.items()],
        *[F.try_divide(F.count_if(c).cast("double"), everything).alias(f"share_{name}") for name, c in conditions.items()],
    )
