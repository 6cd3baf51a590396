"""Time series and sampling."""

from __future__ import annotations

from pyspark.sql import functions as F

from larkspur.catalog.registry import query, r6, rounded
from larkspur.operators import sampling as X, timeseries as W
from larkspur.operators.ordered import row_numbers, window_columns
from larkspur.plans.models import held
from larkspur.session import written
from larkspur.sources.readers import table

_ORDER = ["ts", "event_id"]


def _events(spark, sf):
    return table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type", "value")


def _bars(events, keys=(), period="day"):
    prices = dict.fromkeys(["open_", "high", "low", "close", "volume"], "value")
    return W.resample_ohlcv(events, "ts", "event_id", keys=keys, period=period, **prices)


_BARS = """SELECT {keys} date_trunc('{period}', ts)::date AS date, arg_min(value, (ts, event_id)) AS "open", max(value) AS high, min(value) AS low,
    arg_max(value, (ts, event_id)) AS "close", {volume} AS volume FROM events GROUP BY ALL"""


@query("A15 A16 S11 C8", _BARS.format(keys="", period="day", volume="round(sum(value), 6)"))
def ohlcv_daily(spark, sf):
    return rounded(_bars(_events(spark, sf)), "volume")


@query("A16", _BARS.format(keys="event_type,", period="month", volume="round(sum(value), 6)"))
def ohlcv_monthly_by_type(spark, sf):
    return rounded(_bars(_events(spark, sf), ["event_type"], "month"), "volume")


_W = "OVER (ORDER BY ts, event_id{frame})"
_WK = "OVER (PARTITION BY user_id ORDER BY ts, event_id{frame})"


def _over(spec: str, rows: int | None = None) -> str:
    return spec.format(frame=f" ROWS BETWEEN {rows - 1} PRECEDING AND CURRENT ROW" if rows else "")


_LAGS = ", ".join(f"lag(value, {k}) {{w}} AS value_lag_{k}" for k in (1, 2, 5, 10))


@query("W1", f"SELECT event_id, value, {_LAGS.format(w=_over(_W))} FROM events")
def lags(spark, sf):
    return W.with_lags(_events(spark, sf), "value", [1, 2, 5, 10], _ORDER).drop("ts", "user_id", "event_type")


@query("W1", f"SELECT event_id, value, {_LAGS.format(w=_over(_WK))} FROM events")
def lags_by_user(spark, sf):
    return W.with_lags(_events(spark, sf), "value", [1, 2, 5, 10], _ORDER, ["user_id"]).drop("ts", "user_id", "event_type")


@query("W2", f"SELECT event_id, lead(value, 1) {_over(_W)} AS value_next_1 FROM events")
def next_value(spark, sf):
    return W.with_lead(_events(spark, sf), "value", 1, _ORDER).select("event_id", "value_next_1")


_PREV = f"lag(value, 1) {_over(_W)}"


@query(
    "W3 W4",
    f"""SELECT event_id, round((value - p) / nullif(p, 0), 6) AS plain, CASE WHEN p <> 0 THEN round((value - p) / p, 6) ELSE 0.0 END AS guarded,
        round((value - p) / nullif(p, 0) * 100, 4) AS pct FROM (SELECT event_id, value, {_PREV} AS p FROM events)""",
)
def returns(spark, sf):
    def build(w):
        now, before = F.col("value"), F.lag("value", 1).over(w)
        change = W.growth(now, before)
        return {"plain": r6(change), "guarded": r6(W.growth(now, before, guarded=True)), "pct": F.round(change * 100, 4)}

    return window_columns(_events(spark, sf), build, _ORDER, before=1).select("event_id", "plain", "guarded", "pct")


@query("W3 W4", f"SELECT event_id, round((value - p) / nullif(p, 0) * 100, 4) AS pct FROM (SELECT event_id, value, {_PREV.replace('ORDER', 'PARTITION BY event_type ORDER')} AS p FROM events)")
def pct_change_by_type(spark, sf):
    out = W.with_returns(_events(spark, sf), "value", _ORDER, ["event_type"], percent=True, name="pct")
    return out.select("event_id", F.round("pct", 4).alias("pct"))


_ROLL = ", ".join(
    [f"round(avg(value) {{w{n}}}, 8) AS value_mean_{n}" for n in (5, 20, 60)] + [f"round(stddev(value) {{w{n}}}, 8) AS value_std_{n}" for n in (5, 20)]
)


def _roll_sql(spec: str) -> str:
    return "SELECT event_id, " + _ROLL.format(**{f"w{n}": _over(spec, n) for n in (5, 20, 60)}) + " FROM events"


_ROLLED = ["value_mean_5", "value_mean_20", "value_mean_60", "value_std_5", "value_std_20"]


@query("W5 W6", _roll_sql(_W))
def rolling_stats(spark, sf):
    out = W.with_rolling(_events(spark, sf), "value", [5, 20, 60], [5, 20], order_by=_ORDER)
    return out.select("event_id", *[F.round(c, 8).alias(c) for c in _ROLLED])


@query("W5 W6", _roll_sql(_WK))
def rolling_stats_by_user(spark, sf):
    out = W.with_rolling(_events(spark, sf), "value", [5, 20, 60], [5, 20], order_by=_ORDER, partition_by=["user_id"])
    return out.select("event_id", *[F.round(c, 8).alias(c) for c in _ROLLED])


@query(
    "W7",
    "SELECT event_id, " + ", ".join(f"CASE WHEN count(value) {_over(_WK, n)} = {n} THEN round(avg(value) {_over(_WK, n)}, 6) END AS value_mean_{n}" for n in (10, 30)) + " FROM events",
)
def rolling_full_frames(spark, sf):
    out = W.with_rolling(_events(spark, sf), "value", [10, 30], order_by=_ORDER, partition_by=["user_id"], full_frames=True)
    return rounded(out, "value_mean_10", "value_mean_30").select("event_id", "value_mean_10", "value_mean_30")


@query("W8 F10", "SELECT event_id, row_number() OVER (ORDER BY ts, event_id) AS row_num FROM events")
def global_row_numbers(spark, sf):
    return row_numbers(table(spark, sf, "events").select("event_id", "ts"), _ORDER).select("event_id", "row_num")


@query(
    "W8 F10",
    """SELECT event_id, CASE WHEN row_number() OVER (ORDER BY ts, event_id) <= floor((SELECT count(*) FROM events) * 0.8::double) THEN 'train' ELSE 'test' END AS split FROM events""",
)
def chrono_split(spark, sf):
    return W.chronological_split(_events(spark, sf), _ORDER, 0.8).select("event_id", "split")


@query(
    "W10 W11 C10",
    f"""SELECT date, round(high - low, 6) AS price_range, CASE WHEN "open" <> 0 THEN round((high - low) / "open", 6) ELSE 0.0 END AS price_range_pct,
               month(date)::int AS month, (dayofweek(date) + 1)::int AS day_of_week FROM ({_BARS.format(keys='', period='day', volume='sum(value)')})""",
)
def bar_ranges(spark, sf):
    bars = _bars(_events(spark, sf)).withColumns({**W.range_columns(), **W.calendar_columns("date")})
    return rounded(bars, "price_range", "price_range_pct").select("date", "price_range", "price_range_pct", "month", "day_of_week")


# Each event read as a bar: open and close from neighbouring digits of the value keep every feature defined.
def _tick_bars(spark, sf):
    v = F.col("value")
    return table(spark, sf, "events").select(
        "event_id", "ts", (v + 1).alias("open"), (v + 2).alias("high"), v.alias("low"), (v + 1.5).alias("close"), (v * 10).alias("volume")
    )


_TICKS = "SELECT event_id, ts, value + 1 AS \"open\", value + 2 AS high, value AS low, value + 1.5 AS \"close\", value * 10 AS volume FROM events"
_BAR_FEATURES = f"""
WITH b AS ({_TICKS}),
f AS (SELECT *, {', '.join(f'lag("close", {k}) {_over(_W)} AS close_lag_{k}' for k in (1, 2, 5, 10))},
  {', '.join(f'avg("close") {_over(_W, n)} AS close_mean_{n}' for n in (5, 20, 60))},
  stddev("close") {_over(_W, 20)} AS close_std_20, avg(volume) {_over(_W, 20)} AS volume_mean_20,
  lead("close", 1) {_over(_W)} AS target_close FROM b),
g AS (SELECT *, CASE WHEN close_lag_1 <> 0 THEN ("close" - close_lag_1) / close_lag_1 ELSE 0.0 END AS daily_return FROM f),
h AS (SELECT *, lag(daily_return, 1) {_over(_W)} AS return_lag_1, lag(daily_return, 2) {_over(_W)} AS return_lag_2,
  CASE WHEN "close" <> 0 THEN (target_close - "close") / "close" ELSE 0.0 END AS target_return FROM g)
SELECT event_id, {', '.join(f'round({c}, 6) AS {c}' for c in 'close_lag_1 close_lag_10 close_mean_5 close_mean_20 close_mean_60 close_std_20 volume_mean_20 daily_return return_lag_1 return_lag_2 target_close target_return'.split())},
  month(ts)::int AS month, (dayofweek(ts) + 1)::int AS day_of_week
FROM h WHERE close_lag_10 IS NOT NULL AND close_std_20 IS NOT NULL AND target_close IS NOT NULL AND return_lag_2 IS NOT NULL"""


@query("W1 W2 W3 W5 W6 W9 W10 W11 W14", _BAR_FEATURES)
def bar_features(spark, sf):
    cols = (
        "close_lag_1 close_lag_10 close_mean_5 close_mean_20 close_mean_60 close_std_20 volume_mean_20 daily_return return_lag_1 "
        "return_lag_2 target_close target_return"
    ).split()
    out = W.bar_features(_tick_bars(spark, sf), "ts", _ORDER)
    return rounded(out, *cols).select("event_id", *cols, "month", "day_of_week")


_RETURN_FEATURES = f"""
WITH f AS (SELECT event_id, ts, (value + 1 - lag(value + 1, 1) {_over(_W)}) / lag(value + 1, 1) {_over(_W)} AS r FROM events),
g AS (SELECT *, lag(r, 1) {_over(_W)} AS return_lag_1, lag(r, 2) {_over(_W)} AS return_lag_2, stddev(r) {_over(_W, 5)} AS return_std_5,
  stddev(r) {_over(_W, 20)} AS return_std_20, lead(r, 1) {_over(_W)} AS target_return FROM f)
SELECT event_id, round(r, 6) AS period_return, round(return_lag_1, 6) AS return_lag_1, round(return_lag_2, 6) AS return_lag_2,
  round(return_std_5, 6) AS return_std_5, round(return_std_20, 6) AS return_std_20, round(target_return, 6) AS target_return
FROM g WHERE return_lag_2 IS NOT NULL AND return_std_5 IS NOT NULL AND target_return IS NOT NULL"""


@query("W3 W6 W9 W14", _RETURN_FEATURES)
def return_features(spark, sf):
    cols = ["period_return", "return_lag_1", "return_lag_2", "return_std_5", "return_std_20", "target_return"]
    ticks = table(spark, sf, "events").select("event_id", "ts", (F.col("value") + 1).alias("price"))
    out = W.return_features(ticks, "price", "ts", _ORDER)
    return rounded(out, *cols).select("event_id", *cols)


@query(
    "W12",
    """WITH s AS (SELECT avg(value) AS m, stddev(value) AS d FROM events)
       SELECT event_id, round((value - m) / d, 6) AS zscore FROM events, s WHERE abs((value - m) / d) > 2""",
)
def zscore_anomalies(spark, sf):
    return rounded(W.anomalies(_events(spark, sf), "value", 2.0), "zscore").select("event_id", "zscore")


@query(
    "W12",
    """WITH s AS (SELECT user_id, avg(value) AS m, stddev(value) AS d FROM events GROUP BY 1)
       SELECT event_id, round((value - m) / d, 6) AS zscore FROM events JOIN s USING (user_id) WHERE abs((value - m) / d) > 2""",
)
def zscore_anomalies_by_user(spark, sf):
    return rounded(W.anomalies(_events(spark, sf), "value", 2.0, ["user_id"]), "zscore").select("event_id", "zscore")


@query("W13 O4", "SELECT * FROM (SELECT event_id, ts FROM events ORDER BY ts DESC, event_id DESC LIMIT 365) ORDER BY ts, event_id")
def latest_slice(spark, sf):
    newest = _events(spark, sf).orderBy(F.desc("ts"), F.desc("event_id")).limit(365)
    return newest.orderBy(*_ORDER).select("event_id", "ts")


_DAILY = """WITH d AS (SELECT event_type, ts::date AS date, arg_max(value, (ts, event_id)) AS "close" FROM events GROUP BY 1, 2),
r AS (SELECT *, ("close" - lag("close") OVER (PARTITION BY event_type ORDER BY date)) / nullif(lag("close") OVER (PARTITION BY event_type ORDER BY date), 0) AS ret FROM d),
z AS (SELECT r.*, (ret - m) / s AS z FROM r JOIN (SELECT event_type, avg(ret) AS m, stddev(ret) AS s FROM r GROUP BY 1) USING (event_type))
SELECT event_type, date, "close", round(ret, 6) AS daily_return, round(z, 6) AS zscore FROM z WHERE abs(z) > 2"""


@query("A16 W3 W12", _DAILY)
def daily_return_anomalies(spark, sf):
    """Events to daily bars per type, their returns, and the days more than two deviations out."""
    bars = written(_bars(_events(spark, sf), ["event_type"]), "bars")
    out = W.with_returns(bars, "close", ["date"], ["event_type"], name="daily_return")
    found = W.anomalies(out, "daily_return", 2.0, ["event_type"])
    return rounded(found, "daily_return", "zscore").select("event_type", "date", "close", "daily_return", "zscore")


# Sampling, splits and unions

_HASH = "('0x' || substr(md5({key}::varchar), 1, 8))::bigint % 100"


@query("X4", f"SELECT doc_id, CASE WHEN {_HASH.format(key='doc_id')} < 80 THEN 'train' ELSE 'test' END AS split FROM documents")
def hash_split(spark, sf):
    return X.with_split(table(spark, sf, "documents").select("doc_id"), "doc_id", 80)


@query("X4", "SELECT count(*) AS n_rows, count(*) AS n_distinct FROM orders")
def random_split(spark, sf):
    """The parts of a random split cover every row once."""
    train, test = X.random_split(table(spark, sf, "orders").select("o_orderkey"), [0.7, 0.3], seed=42)
    return train.unionByName(test).agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("o_orderkey").alias("n_distinct"))


@query("X5", f"SELECT doc_id, lang FROM documents WHERE {_HASH.format(key='doc_id')} < CASE lang WHEN 'en' THEN 25 WHEN 'fr' THEN 50 WHEN 'de' THEN 10 ELSE 0 END")
def stratified_sample(spark, sf):
    rows = table(spark, sf, "documents").select("doc_id", "lang")
    return X.stratified_sample(rows, "lang", {"en": 25, "fr": 50, "de": 10}, "doc_id")


@query("X1", "SELECT c_name AS \"name\", c_acctbal AS bal FROM customer UNION ALL SELECT s_name, s_acctbal FROM supplier")
def union_by_name(spark, sf):
    customers = table(spark, sf, "customer").select(F.col("c_name").alias("name"), F.col("c_acctbal").alias("bal"))
    suppliers = table(spark, sf, "supplier").select(F.col("s_acctbal").alias("bal"), F.col("s_name").alias("name"))
    return X.union_named(customers, suppliers)


@query("X2", "SELECT c_custkey AS key, c_nationkey AS nation, c_acctbal AS bal FROM customer UNION ALL SELECT s_suppkey, s_nationkey, s_acctbal FROM supplier")
def union_by_position(spark, sf):
    customers = table(spark, sf, "customer").select(F.col("c_custkey").alias("key"), F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("bal"))
    return X.union_positional(customers, table(spark, sf, "supplier").select("s_suppkey", "s_nationkey", "s_acctbal"))


@query("X3", "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1")
def repartitioned_count(spark, sf):
    spread = X.spread(table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), 16, "o_orderkey")
    return spread.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@query("X7", "SELECT count(*) AS n_rows, round(avg(value), 6) AS mean_value FROM events")
def cached_reuse(spark, sf):
    """A frame held in memory and on disk feeds two jobs and is then released."""
    with held(_events(spark, sf).select("value")) as kept:
        n = kept.count()
        mean = kept.agg(r6(F.avg("value")).alias("mean_value")).first()[0]
    return spark.createDataFrame([(n, mean)], "n_rows bigint, mean_value double")


@query(
    "C11",
    f"""SELECT direction, count(*) AS n FROM (SELECT sign(value - {_PREV})::double AS direction FROM events) GROUP BY 1""",
)
def move_signs(spark, sf):
    moves = window_columns(
        _events(spark, sf), lambda w: {"direction": F.signum(F.col("value") - F.lag("value", 1).over(w))}, _ORDER, before=1
    )
    return moves.groupBy("direction").agg(F.count(F.lit(1)).alias("n"))
