"""Most frequent items against plain counts, with even and skewed items, ties, nulls and few buckets."""

from collections import Counter

import numpy as np
import pytest

from larkspur.operators.heavy import bucket_totals, heavy_hitters


def table(spark, skew):
    draw = np.random.default_rng(4)
    items = draw.zipf(1.3, 6_000) % 2_000 if skew else draw.integers(0, 900, 6_000)
    groups = np.where(draw.random(6_000) < 0.34, 0, draw.integers(0, 5, 6_000))
    rows = [(None if g == 4 else f"g{g}", None if i == 7 else f"i{i:04d}") for g, i in zip(groups.tolist(), items.tolist())]
    return spark.createDataFrame(rows + [("small", "a"), ("small", "b"), ("small", "b")], "grp string, item string"), rows


def plain(rows, k):
    order = sorted(Counter(rows).items(), key=lambda x: (-x[1], x[0] is not None, x[0] or ""))
    return [(item, n, r) for r, (item, n) in enumerate(order[:k], 1)]


@pytest.mark.parametrize("skew", [True, False])
@pytest.mark.parametrize("buckets,first", [(1 << 14, 4), (64, 1), (3, 1)])
def test_whole_table_and_groups(spark, skew, buckets, first):
    df, rows = table(spark, skew)
    rows = rows + [("small", "a"), ("small", "b"), ("small", "b")]
    found = sorted(((r["item"], r["n"], r["rank"]) for r in heavy_hitters(df, "item", 12, buckets=buckets, first=first).collect()), key=lambda x: x[2])
    assert found == plain([i for _, i in rows], 12)
    per = {}
    for r in heavy_hitters(df, "item", 5, ["grp"], buckets, first).collect():
        per.setdefault(r["grp"], []).append((r["item"], r["n"], r["rank"]))
    assert set(per) == {g for g, _ in rows}
    for g, got in per.items():
        assert sorted(got, key=lambda x: x[2]) == plain([i for h, i in rows if h == g], 5)


def test_totals_bound_the_counts(spark):
    df, rows = table(spark, True)
    totals = bucket_totals(df, "item", [], 50).collect()
    assert len(totals) <= 100 and sum(r["total"] for r in totals) == 2 * df.count()
    most = Counter(i for _, i in rows).most_common(1)[0][1]
    assert all(max(r["total"] for r in totals if r["which"] == w) >= most for w in (0, 1))


def test_empty_table(spark):
    df, _ = table(spark, True)
    assert heavy_hitters(df.limit(0), "item", 3).count() == 0 and heavy_hitters(df.limit(0), "item", 3, ["grp"]).count() == 0
