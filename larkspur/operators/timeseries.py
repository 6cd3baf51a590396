"""Resampling, lags, rolling statistics, targets, splits and anomalies of time series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from larkspur.operators.lookups import lookup_join
from larkspur.operators.ordered import fits_a_task, long_frames, range_buckets, shifted_rows, window_columns


def resample_ohlcv(
    df: DataFrame,
    ts: str,
    tie: str,
    *,
    open_: str,
    high: str,
    low: str,
    close: str,
    volume: str,
    keys: Sequence[str] = (),
    period: str = "day",
) -> DataFrame:
    """Open, high, low, close and volume per period; ``tie`` orders rows of equal time.

    The period starts in ``date``, or in ``ts`` for periods shorter than a day.
    """
    when = F.struct(ts, tie)
    if period in ("hour", "minute", "second"):
        start = F.date_trunc(period, F.col(ts)).alias("ts")
    else:
        day = F.to_date(ts)
        start = (day if period == "day" else F.trunc(day, period)).alias("date")
    return df.groupBy(*keys, start).agg(
        F.min_by(open_, when).alias("open"),
        F.max(high).alias("high"),
        F.min(low).alias("low"),
        F.max_by(close, when).alias("close"),
        F.sum(volume).alias("volume"),
    )


def growth(now: Column, before: Column, guarded: bool = False) -> Column:
    """(now - before) / before; null where undefined, or 0.0 in the guarded form."""
    change = F.try_divide(now - before, before)
    return F.when(before != 0, change).otherwise(F.lit(0.0)) if guarded else change


def with_lags(df: DataFrame, col: str, steps: Sequence[int], order_by: Sequence[str], partition_by: Sequence[str] = (), **kw) -> DataFrame:
    """The values ``steps`` rows back; steps too far for a task to reach are joined by row number."""
    if not fits_a_task(max(steps)):
        return shifted_rows(df, {f"{col}_lag_{k}": (col, k) for k in steps}, order_by, partition_by)
    build = lambda w: {f"{col}_lag_{k}": F.lag(col, k).over(w) for k in steps}
    return window_columns(df, build, order_by, partition_by, before=max(steps), **kw)


def with_lead(df: DataFrame, col: str, steps: int, order_by: Sequence[str], partition_by: Sequence[str] = (), **kw) -> DataFrame:
    """The value ``steps`` rows ahead; joined by row number if that is too far for a task to reach."""
    if not fits_a_task(steps):
        return shifted_rows(df, {f"{col}_next_{steps}": (col, -steps)}, order_by, partition_by)
    build = lambda w: {f"{col}_next_{steps}": F.lead(col, steps).over(w)}
    return window_columns(df, build, order_by, partition_by, after=steps, **kw)


def with_returns(
    df: DataFrame, col: str, order_by: Sequence[str], partition_by: Sequence[str] = (), guarded: bool = False,
    percent: bool = False, name: str = "period_return", **kw,
) -> DataFrame:
    """Change against the previous row, as a fraction or in per cent."""
    scale = 100.0 if percent else 1.0
    build = lambda w: {name: growth(F.col(col), F.lag(col, 1).over(w), guarded) * scale}
    return window_columns(df, build, order_by, partition_by, before=1, **kw)


def rolling(w: WindowSpec, func, col: str, n: int, full_frames: bool = False) -> Column:
    """``func`` over the last ``n`` rows; null until ``n`` rows exist when ``full_frames``."""
    frame = w.rowsBetween(-(n - 1), 0)
    value = func(col).over(frame)
    return F.when(F.count(col).over(frame) == n, value) if full_frames else value


def with_rolling(
    df: DataFrame, col: str, means: Sequence[int] = (), deviations: Sequence[int] = (), *, order_by: Sequence[str],
    partition_by: Sequence[str] = (), full_frames: bool = False, **kw,
) -> DataFrame:
    """Trailing means and sample deviations over the given numbers of rows; frames too long for a task are differences of running totals."""
    lengths = [*means, *deviations]
    if not fits_a_task(max(lengths) - 1):
        out = long_frames(df, col, lengths, order_by, partition_by)
        whole = lambda n, c: F.when(F.col(f"__count_{n}") == n, F.col(c)) if full_frames else F.col(c)
        out = out.withColumns({**{f"{col}_mean_{n}": whole(n, f"__mean_{n}") for n in means}, **{f"{col}_std_{n}": whole(n, f"__std_{n}") for n in deviations}})
        return out.drop(*[f"__{what}_{n}" for what in ("count", "mean", "std") for n in lengths])

    def build(w: WindowSpec) -> dict[str, Column]:
        return {
            **{f"{col}_mean_{n}": rolling(w, F.avg, col, n, full_frames) for n in means},
            **{f"{col}_std_{n}": rolling(w, F.stddev, col, n, full_frames) for n in deviations},
        }

    return window_columns(df, build, order_by, partition_by, before=max([*means, *deviations]) - 1, **kw)


def calendar_columns(ts: str) -> dict[str, Column]:
    """Month and day of the week (1 = Sunday)."""
    return {"month": F.month(ts), "day_of_week": F.dayofweek(ts)}


def range_columns(open_: str = "open", high: str = "high", low: str = "low") -> dict[str, Column]:
    """High minus low, and its share of the opening price (0.0 for a zero or missing open)."""
    width = F.col(high) - F.col(low)
    share = F.when(F.col(open_) != 0, F.try_divide(width, F.col(open_))).otherwise(F.lit(0.0))
    return {"price_range": width, "price_range_pct": share}


def bar_features(
    bars: DataFrame, ts: str, order_by: Sequence[str], partition_by: Sequence[str] = (), horizon: int = 1, trim: bool = True, **kw
) -> DataFrame:
    """The forecasting feature set over OHLCV bars, with next-close and next-return targets.

    ``trim`` drops the warm-up rows whose lags or target are incomplete.
    """

    def prices(w: WindowSpec) -> dict[str, Column]:
        return {
            **{f"close_lag_{k}": F.lag("close", k).over(w) for k in (1, 2, 5, 10)},
            **{f"close_mean_{n}": rolling(w, F.avg, "close", n) for n in (5, 20, 60)},
            "close_std_20": rolling(w, F.stddev, "close", 20),
            "volume_mean_20": rolling(w, F.avg, "volume", 20),
            "target_close": F.lead("close", horizon).over(w),
            "daily_return": growth(F.col("close"), F.lag("close", 1).over(w), guarded=True),
        }

    def returns(w: WindowSpec) -> dict[str, Column]:
        return {f"return_lag_{k}": F.lag("daily_return", k).over(w) for k in (1, 2)}

    out = window_columns(bars, [prices, returns], order_by, partition_by, before=60, after=horizon, **kw)
    out = out.withColumns(
        {**range_columns(), **calendar_columns(ts), "target_return": growth(F.col("target_close"), F.col("close"), guarded=True)}
    )
    return out.dropna() if trim else out


def return_features(
    df: DataFrame, col: str, ts: str, order_by: Sequence[str], partition_by: Sequence[str] = (), trim: bool = True, **kw
) -> DataFrame:
    """Returns, lagged returns, 5- and 20-row volatility and the next return as target."""
    first = lambda w: {"period_return": growth(F.col(col), F.lag(col, 1).over(w))}

    def second(w: WindowSpec) -> dict[str, Column]:
        return {
            **{f"return_lag_{k}": F.lag("period_return", k).over(w) for k in (1, 2)},
            **{f"return_std_{n}": rolling(w, F.stddev, "period_return", n) for n in (5, 20)},
            "target_return": F.lead("period_return", 1).over(w),
        }

    out = window_columns(df, [first, second], order_by, partition_by, before=20, after=1, **kw)
    out = out.withColumns(calendar_columns(ts))
    return out.dropna() if trim else out


def chronological_split(df: DataFrame, order_by: Sequence[str], fraction: float = 0.8, name: str = "split") -> DataFrame:
    """Label the first ``floor(n * fraction)`` rows in time ``train`` and the rest ``test``.

    Only the row at the cut is looked up: bucket counts find its bucket, and
    just that bucket is numbered.  The table itself is neither sorted nor shuffled.
    """
    keys = df.select(*order_by)
    placed = range_buckets(keys, order_by)
    counts = placed.groupBy("__bucket").agg(F.count(F.lit(1)).alias("n"))
    upto = Window.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, 0)
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    spans = counts.select("__bucket", "n", F.sum("n").over(upto).alias("upto"), F.floor(F.sum("n").over(everything) * fraction).alias("cut"))
    spot = F.broadcast(
        spans.filter((F.col("upto") >= F.col("cut")) & (F.col("upto") - F.col("n") < F.col("cut"))).select(
            "__bucket", (F.col("cut") - F.col("upto") + F.col("n")).alias("__nth")
        )
    )
    rank = F.row_number().over(Window.partitionBy("__bucket").orderBy(*order_by))
    last = placed.join(spot, "__bucket").withColumn("__rn", rank).filter(F.col("__rn") == F.col("__nth"))
    cut = last.select(F.struct(*order_by)).scalar()
    return df.withColumn(name, F.when(F.coalesce(F.struct(*order_by) <= cut, F.lit(False)), "train").otherwise("test"))


def zscores(df: DataFrame, col: str, keys: Sequence[str] = (), name: str = "zscore") -> DataFrame:
    """Distance from the mean in sample deviations, over the table or per key."""
    if not keys:
        stats = df.agg(F.struct(F.avg(col).alias("m"), F.stddev(col).alias("s"))).scalar()
        return df.withColumn(name, F.try_divide(F.col(col) - stats["m"], stats["s"]))
    stats = df.groupBy(*keys).agg(F.avg(col).alias("__m"), F.stddev(col).alias("__s"))
    joined = lookup_join(df, stats, list(keys))
    return joined.select(*df.columns, F.try_divide(F.col(col) - F.col("__m"), F.col("__s")).alias(name))


def anomalies(df: DataFrame, col: str, threshold: float = 3.0, keys: Sequence[str] = ()) -> DataFrame:
    return zscores(df, col, keys).filter(F.abs("zscore") > threshold)
