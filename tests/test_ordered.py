import random

import pytest
from pyspark.sql import Window, functions as F

from larkspur.operators import ordered
from larkspur.operators.ordered import range_buckets, row_numbers, running_total, window_columns
from larkspur.operators.timeseries import chronological_split, with_lags, with_lead, with_rolling


def skewed(spark, n=6000, seed=1):
    """A third of the rows share one key, a third one timestamp, and some values are null."""
    rnd = random.Random(seed)
    rows = [
        (
            i,
            "hot" if rnd.random() < 0.34 else f"k{rnd.randrange(200)}",
            500 if rnd.random() < 0.34 else rnd.randrange(1000),
            None if rnd.random() < 0.05 else round(rnd.random() * 100, 2),
        )
        for i in range(n)
    ]
    return spark.createDataFrame(rows, "id long, key string, ts int, v double")


def columns(w):
    return {
        "lag3": F.lag("v", 3).over(w),
        "next2": F.lead("v", 2).over(w),
        "mean": F.round(F.avg("v").over(w.rowsBetween(-9, 0)), 8),
        "n": F.count("v").over(w.rowsBetween(-9, 0)),
    }


@pytest.mark.parametrize("keys", [[], ["key"]])
@pytest.mark.parametrize("buckets,coarse", [(1, 256), (5, 256), (40, 256), (40, 4), (100, 1)])
def test_halo_windows_equal_plain_windows(spark, rows, monkeypatch, keys, buckets, coarse):
    monkeypatch.setattr(ordered, "_COARSE", coarse)
    df = skewed(spark)
    halo = window_columns(df, columns, ["ts", "id"], keys, before=9, after=2, buckets=buckets)
    plain = df.withColumns(columns(Window.partitionBy(*keys).orderBy("ts", "id")))
    assert rows(halo) == rows(plain)


def test_chained_builders_cover_their_summed_reach(spark, rows):
    df = skewed(spark).fillna(0.0)
    first = lambda w: {"d": F.round(F.col("v") - F.lag("v", 1).over(w), 6)}
    second = lambda w: {"d4": F.lag("d", 4).over(w)}
    halo = window_columns(df, [first, second], ["ts", "id"], before=5, buckets=20)
    w = Window.orderBy("ts", "id")
    plain = df.withColumns(first(w)).withColumns(second(w))
    assert rows(halo) == rows(plain)


def test_hot_key_and_hot_timestamp_are_split(spark):
    sizes = range_buckets(skewed(spark), ["key", "ts", "id"], buckets=20).groupBy("__bucket").count().collect()
    assert len(sizes) >= 15
    assert max(r["count"] for r in sizes) < 6000 / 20 * 3


def test_every_row_is_core_once(spark):
    spread = range_buckets(skewed(spark), ["ts", "id"], before=7, after=3, buckets=15)
    core = spread.filter(~F.col("__halo"))
    assert core.count() == core.select("id").distinct().count() == 6000


@pytest.mark.parametrize("keys", [[], ["key"]])
@pytest.mark.parametrize("buckets,coarse,kept", [(None, 256, 4096), (25, 256, 4096), (200, 8, 4096), (60, 8, 100)])
def test_row_numbers(spark, rows, monkeypatch, keys, buckets, coarse, kept):
    monkeypatch.setattr(ordered, "_COARSE", coarse)
    monkeypatch.setattr(ordered, "_KEPT", kept)
    df = skewed(spark)
    plain = df.withColumn("row_num", F.row_number().over(Window.partitionBy(*keys).orderBy("ts", "id")).cast("long"))
    assert rows(row_numbers(df, ["ts", "id"], keys, buckets=buckets)) == rows(plain)


def test_running_total_with_null_key_and_null_order(spark, rows):
    df = skewed(spark, 2000).withColumn("key", F.when(F.col("key") != "k1", F.col("key"))).withColumn(
        "ts", F.when(F.col("ts") != 7, F.col("ts"))
    )
    out = running_total(df, {"total": F.col("id")}, ["ts", "id"], ["key"], buckets=12)
    w = Window.partitionBy("key").orderBy("ts", "id").rowsBetween(Window.unboundedPreceding, 0)
    assert rows(out) == rows(df.withColumn("total", F.sum("id").over(w)))


@pytest.mark.parametrize("n", [0, 1, 2, 70])
def test_small_tables(spark, n):
    df = skewed(spark, 70).limit(n)
    assert row_numbers(df, ["ts", "id"]).count() == n
    assert window_columns(df, columns, ["ts", "id"], before=9, after=2).count() == n


@pytest.mark.parametrize("n,fraction", [(6000, 0.8), (6000, 0.0), (6000, 1.0), (10, 0.75), (0, 0.8)])
def test_chronological_split(spark, n, fraction):
    df = skewed(spark).limit(n) if n else skewed(spark, 1).limit(0)
    split = chronological_split(df, ["ts", "id"], fraction)
    got = {r["id"]: r["split"] for r in split.collect()}
    ordered = [r["id"] for r in df.orderBy("ts", "id").collect()]
    cut = int(len(ordered) * fraction)
    assert got == {i: "train" if k < cut else "test" for k, i in enumerate(ordered)}


def test_no_single_partition_window_over_the_rows(spark):
    plan = window_columns(skewed(spark), columns, ["ts", "id"], before=9, buckets=8)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_no_nested_loops(spark):
    for df in (skewed(spark), skewed(spark, 50)):
        plan = row_numbers(df, ["ts", "id"])._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_long_frames_still_give_several_buckets(spark):
    df = spark.range(0, 5_000_000, 1, 8).select(F.col("id").alias("ts"), F.col("id"))
    sizes = [r["count"] for r in range_buckets(df, ["ts", "id"], before=130_000).filter("not __halo").groupBy("__bucket").count().collect()]
    assert sum(sizes) == 5_000_000 and len(sizes) >= 5 and max(sizes) < 1_500_000


def test_a_frame_too_long_for_a_task_is_refused(spark):
    with pytest.raises(ValueError, match="must fit into a task"):
        range_buckets(spark.range(10), ["id"], before=20_000_000)


def test_bucket_number_follows_the_rows(spark, monkeypatch):
    monkeypatch.setattr(ordered, "_BUCKET_ROWS", 1000)
    counts = [range_buckets(spark.range(n), ["id"]).select("__bucket").distinct().count() for n in (20_000, 100_000)]
    assert 15 <= counts[0] <= 25 and 80 <= counts[1] <= 120


def test_the_plan_does_not_grow_with_the_buckets(spark):
    """20,000 buckets: the directory has at most 256 edges in the plan, the rest in a table."""
    sizes = []
    for buckets in (2_000, 20_000):
        spread = range_buckets(spark.range(0, 400_000, 1, 8).selectExpr("id * 7919 AS ts", "id"), ["ts", "id"], buckets=buckets)
        sizes.append(len(spread._jdf.queryExecution().logical().toString()))
        per_bucket = [r["count"] for r in spread.groupBy("__bucket").count().collect()]
        assert sum(per_bucket) == 400_000 and 0.5 * buckets < len(per_bucket) < 2.1 * buckets and max(per_bucket) < 12 * 400_000 / buckets
    assert sizes[1] < 1.2 * sizes[0]


def test_the_sample_stays_small_and_sizes_the_table(spark):
    df = spark.range(0, 2_000_000, 1, 4).selectExpr("id AS ts", "id")
    held = ordered._sample(df, ["ts", "id"], 1_000)
    found = held.selectExpr("count(*) AS n", "sum(pow(2, asked)) AS rows").first()
    assert found["n"] < 4 * 1_000 * 8 and abs(found["rows"] - 2_000_000) < 150_000


@pytest.mark.parametrize("keys", [[], ["key"]])
@pytest.mark.parametrize("full_frames", [False, True])
def test_frames_longer_than_a_task(spark, rows, monkeypatch, keys, full_frames):
    monkeypatch.setattr(ordered, "_LONGEST", 3)
    df = skewed(spark, 2_500).withColumn("key", F.when(F.col("key") != "k1", F.col("key"))).withColumn("v", F.col("v") + 1e6)
    found = with_rolling(df, "v", [40, 300], [300], order_by=["ts", "id"], partition_by=keys, full_frames=full_frames)
    w = Window.partitionBy(*keys).orderBy("ts", "id")
    frame = lambda f, n: f("v").over(w.rowsBetween(1 - n, 0))
    whole = lambda f, n: F.when(frame(F.count, n) == n, frame(f, n)) if full_frames else frame(f, n)
    plain = df.withColumns({"v_mean_40": whole(F.avg, 40), "v_mean_300": whole(F.avg, 300), "v_std_300": whole(F.stddev, 300)})
    pairs = list(zip(rows(found), rows(plain)))
    assert len(pairs) == 2_500
    for mine, other in pairs:
        assert mine[:4] == other[:4]
        assert all(a == b if a is None or b is None else abs(a - b) < 1e-6 for a, b in zip(mine[4:], other[4:]))


@pytest.mark.parametrize("keys", [[], ["key"]])
def test_far_lags_and_leads(spark, rows, monkeypatch, keys):
    monkeypatch.setattr(ordered, "_LONGEST", 3)
    df, w = skewed(spark, 2_000), Window.partitionBy(*keys).orderBy("ts", "id")
    assert rows(with_lags(df, "v", [1, 50], ["ts", "id"], keys)) == rows(df.withColumns({"v_lag_1": F.lag("v", 1).over(w), "v_lag_50": F.lag("v", 50).over(w)}))
    assert rows(with_lead(df, "v", 30, ["ts", "id"], keys)) == rows(df.withColumn("v_next_30", F.lead("v", 30).over(w)))
