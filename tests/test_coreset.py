"""Coresets and sweeps over k against plain k-means and MLlib's silhouette."""

import numpy as np
import pytest
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from larkspur.plans.coreset import _squared, coreset, reduced, sweep_on_coreset, weighted_kmeans


def blobs(n=6_000, k=6, seed=3):
    draw = np.random.default_rng(seed)
    centres = draw.normal(0, 30, (k, 4))
    share = np.array([0.34, *[0.66 / (k - 1)] * (k - 1)])  # a third of the rows in one place
    return centres[draw.choice(k, n, p=share)] + draw.normal(0, 1, (n, 4))


def frame(spark, points, parts):
    return spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "id long, p array<double>").repartition(parts)


def test_reduction_keeps_costs():
    points = blobs()
    few, weights = reduced(points, np.ones(len(points)), 500)
    assert len(few) <= 500 and np.isclose(weights.sum(), len(points))
    draw = np.random.default_rng(1)
    for _ in range(20):
        centres = points[draw.choice(len(points), 5)]
        whole, small = _squared(points, centres).min(1).sum(), (weights * _squared(few, centres).min(1)).sum()
        assert abs(small / whole - 1) < 0.25
    same, times = reduced(np.repeat(points[:40], 30, axis=0), np.ones(1_200), 100)
    assert len(same) == 40 and (times == 30).all()


@pytest.mark.parametrize("parts,fan_in", [(1, 32), (40, 4)])
def test_coreset_of_partitions(spark, parts, fan_in):
    points = blobs()
    few, weights = coreset(frame(spark, points, parts).select(F.col("p").alias("point")), 400, fan_in=fan_in)
    assert len(few) <= 400 and np.isclose(weights.sum(), len(points))
    found = weighted_kmeans(few, weights, 6)
    whole = weighted_kmeans(points, np.ones(len(points)), 6)
    assert _squared(points, found).min(1).sum() < 1.1 * _squared(points, whole).min(1).sum()


def test_sweep_scores_equal_mllib(spark):
    points = blobs(1_500)
    df = frame(spark, points, 5)
    scores, centres = sweep_on_coreset(df, [2, 4, 6, 9], F.col("p"), size=600)
    found = {r["k"]: r for r in scores.collect()}
    assert max(found, key=lambda k: found[k]["silhouette"]) == 6
    for k, c in centres.items():
        nearest = _squared(points, c).argmin(1)
        assert found[k]["cost"] == pytest.approx(_squared(points, c).min(1).sum(), rel=1e-9)
        judged = spark.createDataFrame([(p.tolist(), int(n)) for p, n in zip(points, nearest)], "p array<double>, prediction int")
        theirs = ClusteringEvaluator(featuresCol="features").evaluate(judged.withColumn("features", array_to_vector("p")))
        assert found[k]["silhouette"] == pytest.approx(theirs, abs=1e-9)


def test_odd_points(spark):
    rows = [([1.0, 1.0],), ([1.0, 1.0],), ([9.0, 9.0],), (None,), ([None, 1.0],), ([float("nan"), 1.0],), ([float("inf"), 1.0],), ([],)]
    df = spark.createDataFrame(rows, "p array<double>")
    scores, centres = sweep_on_coreset(df, [1, 2, 5], F.col("p"))
    found = {r["k"]: (r["silhouette"], r["cost"]) for r in scores.collect()}
    assert found[2] == (pytest.approx(2 / 3), 0.0) and found[1][0] == 0.0 and len(centres[5]) == 2
    assert sweep_on_coreset(df.limit(0), [2], F.col("p"))[0].count() == 0
