"""Grouped rates, shares, extremes, distributions and correlations."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce
from itertools import combinations_with_replacement
from typing import NamedTuple

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Correlation
from pyspark.sql import Column, DataFrame, Window, functions as F

from larkspur.operators.heavy import heavy_hitters
from larkspur.operators.lookups import lookup_join
from larkspur.operators.ordered import running_total
from larkspur.operators.quality import per_column
from larkspur.session import written


def table_size(df: DataFrame) -> DataFrame:
    """Rows, columns and the number of partitions that hold rows, from one aggregate."""
    return (
        df.groupBy(F.spark_partition_id().alias("p"))
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
            F.lit(len(df.columns)).cast("long").alias("n_columns"),
            F.count("p").alias("n_partitions"),
        )
    )


def group_count(df: DataFrame, *keys: str, name: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def group_mean(df: DataFrame, keys: Sequence[str], means: Mapping[str, str]) -> DataFrame:
    """``means`` is {source column: output name}."""
    return df.groupBy(*keys).agg(*[F.avg(c).alias(a) for c, a in means.items()])


def group_sum(df: DataFrame, keys: Sequence[str], sums: Mapping[str, str]) -> DataFrame:
    """Several named sums per group; ``sums`` is {source column: output name}."""
    return df.groupBy(*keys).agg(*[F.sum(c).alias(a) for c, a in sums.items()])


def ratio_of_sums(df: DataFrame, keys: Sequence[str], part: Column | str, whole: Column | str, name: str = "rate") -> DataFrame:
    """Sum of ``part`` over sum of ``whole`` per group; null where the whole sums to 0."""
    return df.groupBy(*keys).agg(F.try_divide(F.sum(part), F.sum(whole)).cast("double").alias(name))


def guarded_ratio(
    df: DataFrame, keys: Sequence[str], part: Column | str, whole: Column, name: str = "rate"
) -> DataFrame:
    """Like :func:`ratio_of_sums`, with ``whole`` clamped at 0 per row and null unless its total is positive.

    A null ``whole`` counts as 0, as ``greatest`` ignores nulls.
    """
    total = F.sum(F.greatest(whole, F.lit(0)))
    return df.groupBy(*keys).agg(F.when(total > 0, F.try_divide(F.sum(part), total)).alias(name))


def shares(df: DataFrame, keys: Sequence[str], measures: Mapping[str, Column | str], prefix: str = "share_") -> DataFrame:
    """Sums of the measures per group, their total, and each one's share of it."""
    sums = df.groupBy(*keys).agg(*[F.sum(c).alias(n) for n, c in measures.items()])
    total = reduce(lambda a, b: a + b, [F.col(n) for n in measures])
    return sums.withColumn("total", total).withColumns(
        {f"{prefix}{n}": F.try_divide(F.col(n), total) for n in measures}
    )


def dominant_column(df: DataFrame, cols: Sequence[str], name: str = "dominant", value: str = "dominant_value") -> DataFrame:
    """Name and value of the largest column per row; the first named column wins a tie."""
    peak = F.greatest(*cols)
    which = reduce(lambda acc, c: acc.when(F.col(c) == peak, F.lit(c)), cols, F)
    return df.withColumns({name: which, value: peak})


def extreme_rows(df: DataFrame, by: str, label: str, keys: Sequence[str] = ()) -> DataFrame:
    """Label of the smallest and of the largest ``by``; the smaller label wins a tie."""
    present = F.col(by).isNotNull()
    low = F.min(F.when(present, F.struct(F.col(by).alias("v"), F.col(label).alias("l"))))
    high = F.max(F.col(by))
    best = df.groupBy(*keys).agg(low.alias("low"), high.alias("high"), F.min_by(F.col(label), F.when(present, F.struct(-F.col(by), F.col(label)))).alias("max_label"))
    return best.select(
        *keys,
        F.col("low.l").alias(f"min_{label}"), F.col("low.v").alias(f"min_{by}"),
        F.col("max_label").alias(f"max_{label}"), F.col("high").alias(f"max_{by}"),
    )


def top_groups(df: DataFrame, by: str, k: int, tie: Sequence[str]) -> DataFrame:
    """The ``k`` rows with the largest ``by``; ``tie`` makes the choice unique."""
    return df.orderBy(F.desc(by), *tie).limit(k)


def value_counts(df: DataFrame, col: str, k: int | None = None) -> DataFrame:
    """Rows per value; with ``k`` the most frequent values alone, of which only candidates are shuffled."""
    return group_count(df, col) if k is None else heavy_hitters(df, col, k).drop("rank").orderBy(F.desc("n"), col)


def describe(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Count, mean, sample deviation, minimum and maximum, one row per column."""
    d = lambda c: F.col(c).cast("double")
    return per_column(
        df,
        {
            "count": {c: F.count(c) for c in cols},
            "mean": {c: F.avg(d(c)) for c in cols},
            "stddev": {c: F.stddev(d(c)) for c in cols},
            "min": {c: F.min(d(c)) for c in cols},
            "max": {c: F.max(d(c)) for c in cols},
        },
    )


def summary(df: DataFrame, cols: Sequence[str], accuracy: int = 10_000) -> DataFrame:
    """:func:`describe` plus approximate quartiles, still one pass with bounded state."""
    d = lambda c: F.col(c).cast("double")
    quart = lambda c, p: F.percentile_approx(d(c), F.lit(p), F.lit(accuracy))
    return per_column(
        df,
        {
            "count": {c: F.count(c) for c in cols},
            "mean": {c: F.avg(d(c)) for c in cols},
            "stddev": {c: F.stddev(d(c)) for c in cols},
            "min": {c: F.min(d(c)) for c in cols},
            "q25": {c: quart(c, 0.25) for c in cols},
            "q50": {c: quart(c, 0.5) for c in cols},
            "q75": {c: quart(c, 0.75) for c in cols},
            "max": {c: F.max(d(c)) for c in cols},
        },
    )


def sigma_limits(df: DataFrame, col: str, k: float = 3.0) -> DataFrame:
    """Mean, sample deviation and the limits ``k`` deviations either side."""
    mean, sd = F.avg(col), F.stddev(col)
    return df.agg(
        mean.alias("mean"), sd.alias("stddev"),
        (mean - k * sd).alias("lower_limit"), (mean + k * sd).alias("upper_limit"),
    )


def histogram(df: DataFrame, col: str, bins: int, keys: Sequence[str] = (), density: bool = False, others: bool = False) -> DataFrame:
    """Equal-width bins between the overall minimum and maximum of the finite values; the maximum is in the last bin.

    Nulls are left out.  NaN and infinite values have no bin either; ``others``
    adds a row with a null bin that counts them (per key).
    """
    given = df.filter(F.col(col).isNotNull()).select(*keys, F.col(col).cast("double").alias("__v"))
    finite = ~F.isnan("__v") & (F.abs("__v") < F.lit(math.inf))
    present = given.filter(finite)
    limits = present.agg(F.min("__v").alias("lo"), F.max("__v").alias("hi"))
    edges = present.withColumns({"__lo": limits.select("lo").scalar(), "__hi": limits.select("hi").scalar()})
    width = (F.col("__hi") - F.col("__lo")) / F.lit(float(bins))
    spot = F.coalesce(F.floor(F.try_divide(F.col("__v") - F.col("__lo"), width)), F.lit(0))
    counted = (
        edges.select(*keys, "__lo", width.alias("__w"), F.least(spot, F.lit(bins - 1)).cast("int").alias("bin"))
        .groupBy(*keys, "bin")
        .agg(F.count(F.lit(1)).alias("n"), F.min("__lo").alias("__lo"), F.min("__w").alias("__w"))
    )
    out = counted.select(
        *keys, "bin",
        (F.col("__lo") + F.col("bin") * F.col("__w")).alias("bin_start"),
        (F.col("__lo") + (F.col("bin") + 1) * F.col("__w")).alias("bin_end"),
        "n", "__w",
    )
    if density:
        n_all = F.sum("n").over(Window.partitionBy(*keys)) if keys else F.sum("n").over(Window.partitionBy(F.lit(1)))
        out = out.withColumn("density", F.try_divide(F.col("n").cast("double"), n_all * F.col("__w")))
    out = out.drop("__w")
    if others:
        out = out.unionByName(given.filter(~finite).groupBy(*keys).agg(F.count(F.lit(1)).alias("n")), allowMissingColumns=True)
    return out


def _long_values(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in cols])
    return df.select(F.inline(pairs)).filter(F.col("value").isNotNull())


class _Span(NamedTuple):
    """An open interval of one column's values: ``inside`` rows, with ``below`` rows at or under ``low``."""

    column: str
    low: float | None
    high: float | None
    below: int
    inside: int

    def holds(self) -> Column:
        c = F.col(self.column)
        above = c.isNotNull() if self.low is None else c > F.lit(self.low)
        return above if self.high is None else above & (c < F.lit(self.high))


def _shrink(values: DataFrame, wide: dict[tuple[str, int], _Span], accuracy: int) -> dict[tuple[str, int], _Span | float]:
    """For each wanted rank, its value or a span of about ``4 / accuracy`` of the rows; two passes over the columns.

    A sketch proposes two values around the rank; exact counts then say on which
    side of them, on which of them, or between them the rank lies.
    """
    targets, sketches, margin = list(wide), [], 2 / accuracy
    for i, t in enumerate(targets):
        span = wide[t]
        p = (t[1] - span.below) / max(span.inside - 1, 1)
        ends = F.array(F.lit(max(0.0, p - margin)), F.lit(min(1.0, p + margin)))
        sketches.append(F.percentile_approx(F.when(span.holds(), F.col(span.column)), ends, F.lit(accuracy)).alias(f"g{i}"))
    guess = values.agg(*sketches).first()
    counts = []
    for i, t in enumerate(targets):
        inside, c, (lo, hi) = wide[t].holds(), F.col(t[0]), guess[f"g{i}"]
        parts = (inside & (c < F.lit(lo)), c == F.lit(lo), (c > F.lit(lo)) & (c < F.lit(hi)), (c == F.lit(hi)) & F.lit(hi != lo))
        counts.append(F.array(*[F.count_if(part) for part in parts]).alias(f"n{i}"))
    sizes = values.agg(*counts).first()
    out: dict[tuple[str, int], _Span | float] = {}
    for i, t in enumerate(targets):
        span, (lo, hi), (under, on_lo, between, on_hi) = wide[t], guess[f"g{i}"], sizes[f"n{i}"]
        rank = t[1] - span.below
        upto_hi = under + on_lo + between + on_hi
        if rank < under:
            out[t] = span._replace(high=lo, inside=under)
        elif rank < under + on_lo:
            out[t] = lo
        elif rank < under + on_lo + between:
            out[t] = span._replace(low=lo, high=hi, below=span.below + under + on_lo, inside=between)
        elif rank < upto_hi:
            out[t] = hi
        else:
            out[t] = span._replace(low=hi, below=span.below + upto_hi, inside=span.inside - upto_hi)
    return out


def _read_ranks(values: DataFrame, narrow: dict[tuple[str, int], _Span]) -> dict[tuple[str, int], float]:
    """Values at ranks inside small spans; only the rows of those spans are shuffled."""
    spans = list(dict.fromkeys(narrow.values()))
    wanted = [sorted({t[1] - s.below for t in narrow if narrow[t] == s}) for s in spans]
    tagged = F.array(*[F.when(s.holds(), F.struct(F.lit(i).alias("span"), F.col(s.column).alias("value"))) for i, s in enumerate(spans)])
    counted = values.select(F.inline(F.array_compact(tagged))).groupBy("span", "value").agg(F.count(F.lit(1)).alias("n"))
    upto = F.sum("n").over(Window.partitionBy("span").orderBy("value").rowsBetween(Window.unboundedPreceding, 0))
    ranks = F.array(*[F.array(*[F.lit(r).cast("long") for r in w]) for w in wanted])[F.col("span")]
    hits = counted.withColumn("upto", upto).select(
        "span", "value", F.explode(F.filter(ranks, lambda r: (F.col("upto") - F.col("n") <= r) & (r < F.col("upto")))).alias("rank")
    )
    found = {(r["span"], r["rank"]): r["value"] for r in hits.collect()}  # one row per wanted rank
    return {t: found[spans.index(s), t[1] - s.below] for t, s in narrow.items()}


def exact_quantiles(
    df: DataFrame, cols: Sequence[str], probs: Sequence[float] = (0.25, 0.5, 0.75), accuracy: int = 10_000, keep: int = 1_000_000
) -> DataFrame:
    """Linear-interpolated exact quantiles in long form ``(column, prob, quantile)``.

    ``percentile`` would hold a whole column in one task.  Here bounded sketches
    and exact counts close in on each rank until at most ``keep`` rows remain
    around it, and only those rows are shuffled and ranked.
    """
    values = df.select(*[F.col(c).cast("double").alias(c) for c in cols])
    sizes = values.agg(*[F.count(c).alias(c) for c in cols]).first()
    places = {(c, float(p)): float(p) * (sizes[c] - 1) for c in cols for p in probs if sizes[c]}
    pending: dict[tuple[str, int], _Span | float] = {
        (c, r): _Span(c, None, None, 0, sizes[c]) for (c, _), at in places.items() for r in (math.floor(at), math.ceil(at))
    }
    while wide := {t: s for t, s in pending.items() if isinstance(s, _Span) and s.inside > keep}:
        pending |= _shrink(values, wide, accuracy)
    if narrow := {t: s for t, s in pending.items() if isinstance(s, _Span)}:
        pending |= _read_ranks(values, narrow)
    rows = [(c, float(p), None) for c in cols for p in probs if not sizes[c]]  # a column without values has null quantiles
    for (c, p), at in places.items():
        low, high = pending[c, math.floor(at)], pending[c, math.ceil(at)]
        rows.append((c, p, low + (high - low) * (at - math.floor(at))))
    return df.sparkSession.createDataFrame(rows, "column string, prob double, quantile double")


def box_stats(df: DataFrame, cols: Sequence[str], whisker: float = 1.5) -> DataFrame:
    """Exact quartiles, fences, and the number of rows outside the fences, per column."""
    quart = exact_quantiles(df, cols)
    fences = quart.groupBy("column").agg(
        *[F.max(F.when(F.col("prob") == p, F.col("quantile"))).alias(n) for p, n in ((0.25, "q1"), (0.5, "median"), (0.75, "q3"))]
    )
    iqr = F.col("q3") - F.col("q1")
    fences = fences.withColumns({"lower_fence": F.col("q1") - whisker * iqr, "upper_fence": F.col("q3") + whisker * iqr})
    rows = _long_values(df, cols).join(F.broadcast(fences), "column", "right")  # one row per column
    outside = ~F.col("value").between(F.col("lower_fence"), F.col("upper_fence"))
    return rows.groupBy("column", "q1", "median", "q3", "lower_fence", "upper_fence").agg(
        F.min("value").alias("min"), F.max("value").alias("max"), F.count_if(outside).alias("outliers")
    )


def pearson_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pairwise Pearson correlation in long form, all pairs in one aggregate."""
    pairs = list(combinations_with_replacement(cols, 2))
    flat = df.agg(*[F.corr(a, b).alias(f"{a}|{b}") for a, b in pairs])
    cells = [F.struct(F.lit(x).alias("a"), F.lit(y).alias("b"), F.col(f"`{a}|{b}`").alias("corr"))
             for a, b in pairs for x, y in {(a, b), (b, a)}]
    return flat.select(F.inline(F.array(*cells)))


def pearson_matrix_ml(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """The same through MLlib, for tables too wide for one aggregate per pair."""
    vectors = VectorAssembler(inputCols=list(cols), outputCol="v", handleInvalid="skip").transform(df).select("v")
    return _matrix_to_long(Correlation.corr(vectors, "v", "pearson"), cols)


def _matrix_to_long(row: DataFrame, cols: Sequence[str]) -> DataFrame:
    matrix = row.head()[0].toArray()  # columns x columns
    cells = [(a, b, float(matrix[i][j])) for i, a in enumerate(cols) for j, b in enumerate(cols)]
    return row.sparkSession.createDataFrame(cells, "a string, b string, corr double")


def average_ranks(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(column, value, n, rank)``: distinct values, their row count and average 1-based rank."""
    counted = group_count(_long_values(df, cols), "column", "value")
    ranked = running_total(written(counted, "values"), {"upto": F.col("n")}, ["value", "n"], ["column"])
    return ranked.select("column", "value", "n", (F.col("upto") - (F.col("n") - 1) / F.lit(2.0)).alias("rank"))


def _ranks_beside(rows: DataFrame, cols: Sequence[str], gappy: Sequence[str]) -> DataFrame:
    """``(column, value, rank, beside)``: average rank of a value among the column's rows, and among those where each gappy column is present too."""
    present = [F.col(c).isNotNull().cast("long").alias(f"p{i}") for i, c in enumerate(gappy)]
    long = rows.select(*present, F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in cols])).alias("e"))
    counts = long.filter("e.value is not null").groupBy("e.column", "e.value").agg(F.count(F.lit(1)).alias("n"), *[F.sum(f"p{i}").alias(f"n{i}") for i in range(len(gappy))])
    names = ["n", *[f"n{i}" for i in range(len(gappy))]]
    upto = running_total(written(counts, "values"), {f"upto_{n}": F.col(n) for n in names}, ["value"], ["column"])
    rank = lambda n: F.col(f"upto_{n}") - (F.col(n) - 1) / F.lit(2.0)
    return upto.select("column", "value", rank("n").alias("rank"), F.array(*[rank(n) for n in names[1:]]).cast("array<double>").alias("beside"))


def spearman_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Spearman correlation in long form, each pair over the rows in which both columns are present.

    Dropping a row shifts the ranks, so beside a column with gaps a column has
    other ranks.  All of them come from one table of distinct values with a
    count per gappy column and one running total; then every pair is one term
    of one aggregate.  The number of jobs does not depend on the gaps.
    """
    clean = lambda c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")).alias(c)
    rows = df.select(*[clean(c) for c in cols])
    gaps = rows.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols]).first()
    gappy = [c for c in cols if gaps[c]]
    ranks = written(_ranks_beside(rows, cols, gappy), "ranks")
    ranked = rows
    for i, c in enumerate(cols):
        of_c = ranks.filter(F.col("column") == c).select(F.col("value").alias(c), F.col("rank").alias(f"__r{i}"), F.col("beside").alias(f"__b{i}"))
        ranked = lookup_join(ranked, of_c, c, "left")

    def rank(a: str, b: str) -> Column:
        i = list(cols).index(a)
        return F.get(f"__b{i}", F.lit(gappy.index(b))) if b in gappy and a != b else F.col(f"__r{i}")

    pairs = list(combinations_with_replacement(cols, 2))
    both = lambda a, b, x: F.when(F.col(a).isNotNull() & F.col(b).isNotNull(), x)
    found = ranked.agg(F.array(*[F.corr(both(a, b, rank(a, b)), both(a, b, rank(b, a))) for a, b in pairs]).alias("r")).first()["r"]
    cells = [(x, y, r) for (a, b), r in zip(pairs, found) for x, y in {(a, b), (b, a)}]
    return df.sparkSession.createDataFrame(cells, "a string, b string, corr double")


def contingency(df: DataFrame, rows: str, cols: str, values: Sequence[object], other: str = "other") -> DataFrame:
    """Counts of ``rows`` by the listed ``values`` of ``cols``, absent pairs as 0.

    All remaining rows, null values included, are counted in the column ``other``.
    """
    listed = F.coalesce(F.col(cols).isin(list(values)), F.lit(False))
    counts = [F.count_if(F.col(cols) == F.lit(v)).alias(str(v)) for v in values]
    return df.groupBy(rows).agg(*counts, F.count_if(~listed).alias(other))


def sample_per_group(df: DataFrame, key: str, row_id: str, k: int) -> DataFrame:
    """``k`` rows per group in md5 order of their id: a repeatable sample for scatter charts."""
    order = Window.partitionBy(key).orderBy(F.md5(F.col(row_id).cast("string")), row_id)
    return df.withColumn("__rn", F.row_number().over(order)).filter(F.col("__rn") <= k).drop("__rn")


def array_profile(df: DataFrame, key: str, array: str) -> DataFrame:
    """Minimum, mean and maximum of each array position per group."""
    return (
        df.select(key, F.posexplode(array).alias("position", "x"))
        .groupBy(key, "position")
        .agg(F.min("x").alias("min"), F.avg("x").alias("mean"), F.max("x").alias("max"))
    )


def latest_kpis(df: DataFrame, averages: Mapping[str, str], latest: Mapping[str, str], order_by: Sequence[str]) -> DataFrame:
    """One row: row count, chosen averages, and the newest value of chosen columns."""
    when = F.struct(*order_by)
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.avg(c).alias(a) for c, a in averages.items()],
        *[F.max_by(c, when).alias(a) for c, a in latest.items()],
    )


