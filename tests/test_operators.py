import datetime as dt
import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from larkspur.operators import aggregates as A, columns as C, lookups as L, quality as Q, sampling as X, timeseries as W


# Columns


def test_sanitised_names():
    assert C.sanitised_names(["Email No.", "the", "THE", "", "3d", "  a  b ", "%%", "the"]) == [
        "email_no", "the", "the_1", "blank", "col_3d", "a_b", "blank_1", "the_2",
    ]


def test_resolve_errors(spark):
    df = spark.createDataFrame([(1, 2)], ["a", "b"])
    assert C.resolve_column(df, ["x", "b"]) == "b"
    assert C.resolve_columns(df, [("a", "x"), ("b",)]) == ("b",)
    with pytest.raises(ValueError):
        C.resolve_column(df, ["x"])
    with pytest.raises(ValueError):
        C.resolve_columns(df, [("a", "x")])


def test_round_columns(spark):
    df = spark.createDataFrame([(1, 1.256, "x", float("nan"), None)], "i int, d double, s string, n double, z double")
    row = C.round_columns(df, 2).first()
    assert (row["i"], row["d"], row["s"], row["z"]) == (1, 1.26, "x", None) and math.isnan(row["n"])
    assert C.round_columns(df, 1, ["s"]).first()["d"] == 1.256
    with pytest.raises(ValueError):
        C.round_columns(df, -1)
    with pytest.raises(ValueError):
        C.round_columns(df, 1, ["nope"])


def test_round_vectors(spark):
    df = spark.createDataFrame([(Vectors.dense(1.234, 5.678),), (Vectors.sparse(2, [1], [0.555]),)], ["v"])
    assert [r[0] for r in C.round_vectors(df, "v", 1).collect()] == [[1.2, 5.7], [0.0, 0.6]]
    with pytest.raises(ValueError):
        C.round_vectors(df, "w")


def test_edge_columns_of_a_narrow_table(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["a", "b", "c"])
    assert C.edge_columns(df, 2).columns == ["a", "b", "c"]
    assert C.edge_columns(df, 1).columns == ["a", "c"]


def test_cast_of_dirty_text_gives_null(spark):
    df = spark.createDataFrame([("1.5",), ("x",), (None,)], "a string")
    assert [r[0] for r in C.cast_columns(df, {"a": "double"}).collect()] == [1.5, None, None]


def test_epoch_and_month_start(spark):
    df = spark.createDataFrame([(1325317920.0, 2012, 2)], "t double, y int, m int")
    row = df.select(C.epoch_to_timestamp("t").cast("string").alias("t"), C.month_start("y", "m").alias("d")).first()
    assert row["t"] == "2011-12-31 07:52:00" and row["d"] == dt.date(2012, 2, 1)


# Quality

MIXED = "i int, d double, s string, t timestamp"


def test_missing_profiles(spark):
    now = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(1, float("nan"), "a", now), (None, None, None, None), (0, float("inf"), "", now)], MIXED)
    nulls = {r["column"]: r["missing"] for r in Q.null_counts(df).collect()}
    missing = {r["column"]: r["missing"] for r in Q.missing_counts(df).collect()}
    assert nulls == {"i": 1, "d": 1, "s": 1, "t": 1}
    assert missing == {"i": 1, "d": 2, "s": 1, "t": 1}
    assert Q.rows_with_missing(df).count() == 2
    assert {r["column"]: r["zeros"] for r in Q.zero_counts(df).collect()} == {"i": 1, "d": 0}
    assert Q.infinities_to_null(df, ["d"]).filter("d is null").count() == 2


def test_profiles_of_an_empty_table(spark):
    df = spark.createDataFrame([], MIXED)
    assert {r["missing"] for r in Q.missing_counts(df).collect()} == {0}
    assert Q.matching_share(df, any=F.col("i") > 0).first().asDict() == {"n_rows": 0, "n_any": 0, "share_any": None}
    size = A.table_size(df).first()
    assert (size["n_rows"], size["n_columns"]) == (0, 4)


def test_impute_mean_does_not_truncate_whole_numbers(spark):
    df = spark.createDataFrame([(1,), (4,), (None,)], "a int")
    assert sorted(r[0] for r in Q.impute_mean(df, ["a"]).collect()) == [1.0, 2.5, 4.0]


def test_fill_rules_run_in_order(spark):
    df = spark.createDataFrame([(None, 0, 0), (None, 1, 0), (None, 1, 1), (5, 0, 0)], "a int, b int, c int")
    out = Q.fill_when(df, "a", [(F.col("b") == 0, 0), (F.col("c") == 0, -1)])
    assert [r["a"] for r in out.collect()] == [0, -1, None, 5]


def test_fill_by_type(spark):
    df = spark.createDataFrame([(None, None, None)], "a int, b string, c date")
    assert Q.fill_by_type(df).first().asDict() == {"a": 0, "b": "Unknown", "c": None}


def test_zeros_to_missing(spark):
    df = spark.createDataFrame([(0,), (3,)], "a int")
    values = [r[0] for r in Q.zeros_to_missing(df, ["a"]).collect()]
    assert math.isnan(values[0]) and values[1] == 3.0


# Aggregates


def test_ratios_with_zero_and_negative_denominators(spark):
    df = spark.createDataFrame([("a", 1, 0), ("b", 1, -2), ("c", 3, 4), ("c", 3, -1), ("d", None, None)], "k string, x int, y int")
    plain = {r["k"]: r["rate"] for r in A.ratio_of_sums(df, ["k"], "x", "y").collect()}
    guarded = {r["k"]: r["rate"] for r in A.guarded_ratio(df, ["k"], "x", F.col("y")).collect()}
    assert plain == {"a": None, "b": -0.5, "c": 2.0, "d": None}
    assert guarded == {"a": None, "b": None, "c": 1.5, "d": None}


def test_dominant_column_and_extremes_break_ties(spark):
    df = spark.createDataFrame([(1, 2, 2), (2, 5, 1), (3, 5, 2), (4, None, 1)], "m int, a int, b int")
    assert [r["dominant"] for r in A.dominant_column(df, ["a", "b"]).orderBy("m").collect()] == ["a", "a", "a", "b"]
    row = A.extreme_rows(df, "a", "m").first()
    assert (row["min_m"], row["min_a"], row["max_m"], row["max_a"]) == (1, 2, 2, 5)


def test_histogram_edges(spark):
    df = spark.createDataFrame([(float(i),) for i in range(11)] + [(None,)], "v double")
    got = {r["bin"]: r["n"] for r in A.histogram(df, "v", 5).collect()}
    assert got == {0: 2, 1: 2, 2: 2, 3: 2, 4: 3}
    constant = A.histogram(spark.createDataFrame([(2.0,), (2.0,)], "v double"), "v", 5).collect()
    assert [(r["bin"], r["n"]) for r in constant] == [(0, 2)]


@pytest.mark.parametrize("n", [1, 2, 9, 5000])
def test_exact_quantiles(spark, n):
    rnd = np.random.default_rng(n)
    # a third of the values are equal
    values = [7.0 if rnd.random() < 0.34 else float(rnd.normal()) for _ in range(n)]
    probs = [0.0, 0.25, 0.5, 0.9, 1.0]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = {r["prob"]: r["quantile"] for r in A.exact_quantiles(df, ["v"], probs).collect()}
    for p in probs:
        assert got[p] == pytest.approx(np.quantile(values, p))


@pytest.mark.parametrize("share", [0.0, 0.34, 0.9])
def test_exact_quantiles_narrow_their_brackets(spark, share):
    rnd = np.random.default_rng(1)
    values = [7.0 if rnd.random() < share else float(rnd.normal(7.0)) for _ in range(20_000)]
    probs = [0.0, 0.001, 0.25, 0.5, 0.77, 0.999, 1.0]
    df = spark.createDataFrame([(v,) for v in values], "v double").union(spark.createDataFrame([(None,)] * 5, "v double"))
    got = {r["prob"]: r["quantile"] for r in A.exact_quantiles(df, ["v"], probs, accuracy=200, keep=500).collect()}
    for p in probs:
        assert got[p] == pytest.approx(np.quantile(values, p))


def test_box_stats_counts_outliers(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 2, 3, 4, 5, 100]], "v double")
    row = A.box_stats(df, ["v"]).first()
    assert row["outliers"] == 1 and row["median"] == 3.5


@pytest.mark.parametrize("gaps", [False, True])
def test_spearman_with_ties(spark, gaps):
    rnd = random.Random(3)
    data = [(float(rnd.randrange(5)), rnd.random(), float(rnd.randrange(200)), 1.0 * i) for i in range(800)]
    frame = pd.DataFrame(data, columns=["a", "b", "c", "d"])
    if gaps:
        frame.loc[::3, "a"] = None
        frame.loc[::7, "b"] = None
    expected = frame.corr(method="spearman")
    got = A.spearman_matrix(spark.createDataFrame(frame), ["a", "b", "c", "d"]).collect()
    assert len(got) == 16
    for r in got:
        assert r["corr"] == pytest.approx(expected.loc[r["a"], r["b"]])


def test_pearson_forms_agree(spark):
    rnd = random.Random(4)
    df = spark.createDataFrame([(rnd.random(), rnd.random(), 1.0) for _ in range(200)], "a double, b double, c double")
    one = {(r["a"], r["b"]): r["corr"] for r in A.pearson_matrix(df, ["a", "b"]).collect()}
    two = {(r["a"], r["b"]): r["corr"] for r in A.pearson_matrix_ml(df, ["a", "b"]).collect()}
    assert one.keys() == two.keys() and all(one[k] == pytest.approx(two[k]) for k in one)


def test_describe_of_nulls(spark):
    row = A.describe(spark.createDataFrame([(None,), (None,)], "a double"), ["a"]).first()
    assert (row["count"], row["mean"], row["stddev"]) == (0, None, None)


# Lookups


@pytest.mark.parametrize("how", ["inner", "left"])
def test_lookup_join_equals_join(spark, rows, how):
    rnd = random.Random(5)
    data = [(i, "hot" if rnd.random() < 0.4 else f"k{rnd.randrange(30)}") for i in range(1500)]
    df = spark.createDataFrame(data, "id long, key string")
    table = df.groupBy("key").count().filter("key <> 'k7'").withColumn("x", F.length("key"))
    out = L.lookup_join(df, table, "key", how)
    assert rows(out, "id", "key", "count", "x") == rows(df.join(table, "key", how), "id", "key", "count", "x")


def test_lookup_join_cuts_a_key_of_equal_rows(spark):
    """Nine tenths of the rows are identical; no task of the join may hold them together."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
    }
    before = {k: spark.conf.get(k) if k != "spark.sql.adaptive.autoBroadcastJoinThreshold" else None for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        n = 200_000
        key = F.when(F.col("id") % 10 > 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 3000))
        rows = spark.range(0, n, 1, 64).select(key.alias("key"), F.lit("same").alias("payload"))
        table = spark.range(0, 3000).select(F.concat(F.lit("k"), F.col("id")).alias("key"), "id").union(spark.createDataFrame([("hot", -1)], "key string, id long"))
        joined = L.lookup_join(rows, table, "key").withColumn("task", F.spark_partition_id())
        sizes = [r["count"] for r in joined.groupBy("task").count().collect()]
        assert sum(sizes) == n and max(sizes) < n / 3  # 180,000 rows of the key
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_histogram_of_odd_values(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (float("nan"),), (float("inf"),), (float("-inf"),), (None,)], "v double")
    bins = {(r["bin"], r["bin_start"], r["bin_end"], r["n"]) for r in A.histogram(df, "v", 2, others=True).collect()}
    assert bins == {(0, 1.0, 2.0, 1), (1, 2.0, 3.0, 2), (None, None, None, 3)}


def test_nothing_is_left_out_silently(spark):
    df = spark.createDataFrame([("a", "x", None), ("a", "Z", None), ("a", None, None), ("b", "x", None)], "k string, v string, n double")
    assert {tuple(r) for r in A.contingency(df, "k", "v", ["x", "y"]).collect()} == {("a", 1, 0, 2), ("b", 1, 0, 0)}
    assert [tuple(r) for r in A.exact_quantiles(df, ["n"], [0.5]).collect()] == [("n", 0.5, None)]
    assert [tuple(r) for r in A.box_stats(df, ["n"]).select("column", "median", "min", "outliers").collect()] == [("n", None, None, 0)]


def test_sanitised_names_stay_unique():
    assert C.sanitised_names(["a", "a_1", "a", "A", "", " ", "1"]) == ["a", "a_1", "a_2", "a_3", "blank", "blank_1", "col_1"]


# Sampling


def test_hash_split_is_complete_and_stable(spark):
    df = spark.range(5000)
    train, test = X.hash_split(df, "id")
    assert train.intersect(test).count() == 0 and train.count() + test.count() == 5000
    assert 0.77 < train.count() / 5000 < 0.83
    again = X.hash_split(df.repartition(13), "id")[0]
    assert train.exceptAll(again).count() == 0


def test_stratified_sample_shares(spark):
    df = spark.range(9000).withColumn("label", F.col("id") % 3)
    got = {r["label"]: r["count"] for r in X.stratified_sample(df, "label", {0: 10, 1: 50}, "id").groupBy("label").count().collect()}
    assert set(got) == {0, 1} and 200 < got[0] < 400 and 1350 < got[1] < 1650


def test_positional_union_checks_types(spark):
    a, b = spark.createDataFrame([(1, "x")], "a int, b string"), spark.createDataFrame([("x", 1)], "a string, b int")
    assert X.union_positional(a, a).count() == 2
    with pytest.raises(ValueError):
        X.union_positional(a, b)
    with pytest.raises(ValueError):
        X.union_positional(a, a.select("a"))


# Time series


def daily(spark, n=200, seed=8):
    rnd = np.random.default_rng(seed)
    frame = pd.DataFrame({"date": pd.date_range("2020-01-01", periods=n).date, "close": 100 + rnd.normal(size=n).cumsum()})
    frame["open"], frame["high"], frame["low"], frame["volume"] = frame["close"] - 1, frame["close"] + 2, frame["close"] - 2, 10.0
    return frame, spark.createDataFrame(frame)


def test_bar_features_against_pandas(spark):
    frame, df = daily(spark)
    got = W.bar_features(df, "date", ["date"], buckets=2).toPandas().sort_values("date").reset_index(drop=True)
    close = frame["close"]
    expected = pd.DataFrame(
        {
            "date": frame["date"], "close_lag_10": close.shift(10), "close_mean_20": close.rolling(20, min_periods=1).mean(),
            "close_std_20": close.rolling(20, min_periods=2).std(), "daily_return": close.pct_change().fillna(0.0),
            "target_close": close.shift(-1), "target_return": close.shift(-1) / close - 1,
        }
    )
    expected["return_lag_2"] = expected["daily_return"].shift(2)
    expected = expected.dropna().reset_index(drop=True)
    assert len(got) == len(expected) == 200 - 10 - 1
    for c in expected.columns:
        if c != "date":
            np.testing.assert_allclose(got[c], expected[c], rtol=1e-9, atol=1e-12)


def test_resample_takes_first_and_last_by_time_then_tie(spark):
    t = dt.datetime(2024, 1, 1, 5)
    df = spark.createDataFrame([(2, t, 5.0), (1, t, 7.0), (3, dt.datetime(2024, 1, 1, 4), 1.0)], "id int, ts timestamp_ntz, v double")
    row = W.resample_ohlcv(df, "ts", "id", **dict.fromkeys(["open_", "high", "low", "close", "volume"], "v")).first()
    assert row.asDict() == {"date": dt.date(2024, 1, 1), "open": 1.0, "high": 7.0, "low": 1.0, "close": 5.0, "volume": 13.0}


def test_guarded_growth(spark):
    df = spark.createDataFrame([(2.0, 0.0), (2.0, None), (3.0, 2.0)], "a double, b double")
    out = df.select(W.growth(F.col("a"), F.col("b")).alias("p"), W.growth(F.col("a"), F.col("b"), True).alias("g")).collect()
    assert [tuple(r) for r in out] == [(None, 0.0), (None, 0.0), (0.5, 0.5)]


def test_full_frames_only(spark):
    _, df = daily(spark, 40)
    out = W.with_rolling(df, "close", [10], order_by=["date"], full_frames=True).orderBy("date").collect()
    assert [r["close_mean_10"] is None for r in out] == [True] * 9 + [False] * 31


def test_constant_series_has_no_anomaly(spark):
    df = spark.createDataFrame([(i, 5.0) for i in range(10)], "id int, v double")
    assert W.anomalies(df, "v", 2.0).count() == 0


def test_keyed_zscores(spark):
    df = spark.createDataFrame([(i, i % 2, float(i) if i < 99 else 1e6) for i in range(100)], "id int, k int, v double")
    found = W.anomalies(df, "v", 3.0, ["k"]).collect()
    assert [r["id"] for r in found] == [99]
