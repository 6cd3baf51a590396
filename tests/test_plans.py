import random

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.linalg import Vectors
from pyspark.ml.stat import ChiSquareTest
from pyspark.sql import functions as F

from larkspur.plans import evaluate as E, features as G, models as M


def scored(spark, n=600, seed=1):
    rnd = random.Random(seed)
    data = []
    for i in range(n):
        label = float(rnd.randrange(3))
        data.append((i, label, label if rnd.random() < 0.6 else float(rnd.randrange(3)), round(rnd.random(), 2)))
    return spark.createDataFrame(data, "id int, label double, prediction double, score double")


# Evaluation


def test_overall_and_class_metrics_equal_mllib(spark):
    df = scored(spark)
    mine = E.overall_metrics(df).first()
    judge = MulticlassClassificationEvaluator()
    for name, theirs in (("accuracy", "accuracy"), ("weighted_precision", "weightedPrecision"), ("weighted_recall", "weightedRecall"), ("weighted_f1", "f1")):
        assert mine[name] == pytest.approx(judge.setMetricName(theirs).evaluate(df))
    rates = {r["class"]: r for r in E.class_rates(df).collect()}
    for r in E.class_metrics(df).collect():
        one = judge.setMetricLabel(r["class"])
        assert r["precision"] == pytest.approx(one.setMetricName("precisionByLabel").evaluate(df))
        assert r["recall"] == pytest.approx(one.setMetricName("recallByLabel").evaluate(df))
        assert r["f1"] == pytest.approx(one.setMetricName("fMeasureByLabel").evaluate(df))
        assert rates[r["class"]]["false_positive_rate"] == pytest.approx(one.setMetricName("falsePositiveRateByLabel").evaluate(df))


def test_metrics_when_one_class_is_never_predicted(spark):
    df = spark.createDataFrame([(0.0, 0.0), (1.0, 0.0), (1.0, 0.0)], "label double, prediction double")
    got = {r["class"]: (r["precision"], r["recall"], r["f1"]) for r in E.class_metrics(df).collect()}
    assert got[1.0] == (0.0, 0.0, 0.0) and got[0.0] == (pytest.approx(1 / 3), 1.0, pytest.approx(0.5))
    wide = {r["label"]: (r["0.0"], r["1.0"]) for r in E.confusion_wide(df, [0.0, 1.0]).collect()}
    assert wide == {0.0: (1, 0), 1.0: (2, 0)}


@pytest.mark.parametrize("decimals", [0, 1, 6])
def test_area_under_roc_equals_mllib_with_ties(spark, decimals):
    df = scored(spark).select(F.round("score", decimals).alias("score"), (F.col("label") > 1).cast("double").alias("label"))
    mine = E.area_under_roc(df, "score", "label").first()[0]
    theirs = BinaryClassificationEvaluator(rawPredictionCol="score", numBins=0).evaluate(df)
    assert mine == pytest.approx(theirs)


def test_area_without_negatives_is_null(spark):
    df = spark.createDataFrame([(0.5, 1), (0.7, 1)], "score double, label int")
    assert E.area_under_roc(df, "score", "label").first()[0] is None


def test_curve_by_hand(spark):
    df = spark.createDataFrame([(0.9, 1), (0.8, 0), (0.8, 1), (0.1, 0)], "score double, label int")
    got = [tuple(r) for r in E.curve_points(df, "score", "label").orderBy(F.desc("score")).collect()]
    assert got == [(0.9, 1, 0, 0.5, 0.0, 1.0), (0.8, 2, 1, 1.0, 0.5, pytest.approx(2 / 3)), (0.1, 2, 2, 1.0, 1.0, 0.5)]
    assert E.curve_points(scored(spark), "score", "label", 1.0, max_points=10).count() <= 11


def test_regression_metrics_equal_mllib(spark):
    rnd = random.Random(2)
    df = spark.createDataFrame([(rnd.random(), rnd.random()) for _ in range(300)], "y double, p double")
    row = E.regression_metrics(df, "y", "p").first()
    for name in ("mse", "rmse", "mae", "r2"):
        assert row[name] == pytest.approx(RegressionEvaluator(labelCol="y", predictionCol="p", metricName=name).evaluate(df))


def test_directional_accuracy(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0), (1.0, 0.0, 2.0), (1.0, 1.0, 1.0)], "now double, actual double, forecast double")
    assert E.directional_accuracy(df, "now", "actual", "forecast").first()["direction_pct"] == pytest.approx(200 / 3)
    assert E.directional_accuracy(df.limit(0), "now", "actual", "forecast").first()["direction_pct"] is None


def test_comparison_picks_the_best(spark):
    table = E.comparison([M.metric_row(spark, "a", acc=0.5), M.metric_row(spark, "b", acc=0.9, f1=1.0)])
    assert E.best_model(table, "acc").first()["model"] == "b"
    assert E.best_model(table, "acc", larger_is_better=False).first()["model"] == "a"


# Features


def test_category_index_follows_frequency_then_name(spark):
    df = spark.createDataFrame([(v,) for v in ["b", "b", "a", "c", "c", None]], "k string")
    got = {r["k"]: (r["n"], r["index"]) for r in G.category_index(df, "k").collect()}
    assert got == {"b": (2, 0), "c": (2, 1), "a": (1, 2)}
    labels = G.indexer("k", "i").fit(df.dropna()).labels
    assert labels == ["b", "c", "a"]


def test_standardise_constant_column(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.0, 3.0)], "a double, b double")
    assert [(r["a_z"], round(r["b_z"], 6)) for r in G.standardise(df, ["a", "b"]).collect()] == [(0.0, -0.707107), (0.0, 0.707107)]


def test_chi_square_equals_mllib(spark):
    rnd = random.Random(3)
    df = spark.createDataFrame([(float(rnd.randrange(4)), float(rnd.randrange(2)), float(rnd.randrange(3))) for _ in range(400)], "a double, b double, y double")
    vectors = VectorAssembler(inputCols=["a", "b"], outputCol="v").transform(df)
    theirs = ChiSquareTest.test(vectors, "v", "y").first()
    mine = {r["feature"]: (r["statistic"], r["degrees_of_freedom"]) for r in G.chi_square(df, ["a", "b"], "y").collect()}
    for i, name in enumerate(["a", "b"]):
        assert mine[name] == (pytest.approx(theirs["statistics"][i]), theirs["degreesOfFreedom"][i])


def test_class_weights_balance_the_classes(spark):
    df = spark.createDataFrame([(1,)] * 3 + [(0,)] * 9, "y int")
    sums = {r["y"]: r["w"] for r in G.with_class_weights(df, "y").groupBy("y").agg(F.sum("weight").alias("w")).collect()}
    assert sums[0] == pytest.approx(sums[1])


def test_sparse_entries_of_sparse_and_dense_vectors(spark, rows):
    df = spark.createDataFrame([(1, Vectors.sparse(4, [1, 3], [2.0, 0.0])), (2, Vectors.dense(0.0, 5.0))], ["id", "v"])
    assert rows(G.sparse_entries(df, "id", "v")) == [(1, 1, 2.0), (2, 1, 5.0)]


def test_assembler_rejects_null_unless_told(spark):
    df = spark.createDataFrame([(1.0,), (None,)], "a double")
    assert G.assembler(["a"], keep_invalid=True).transform(df).count() == 2
    with pytest.raises(Exception):
        G.assembler(["a"]).transform(df).collect()


# Models


def blobs(spark, k=3, n=120):
    rnd = np.random.default_rng(5)
    data = [(i, float(i % k), Vectors.dense(*(rnd.normal(10 * (i % k), 1.0, 2)))) for i in range(n)]
    return spark.createDataFrame(data, ["id", "label", "features"])


def test_sweep_finds_the_blobs(spark):
    table, best = M.sweep_k(blobs(spark), [2, 3, 6])
    assert table.orderBy(F.desc("silhouette")).first()["k"] == 3 and len(best.clusterCenters()) == 3


@pytest.mark.parametrize("stage", ["tree", "forest", "ovr", "logistic", "gaussian"])
def test_classifiers_separate_blobs(spark, stage):
    made = {
        "tree": M.decision_tree("label"), "forest": M.random_forest("label", trees=5), "ovr": M.one_vs_rest(M.logistic("label"), "label"),
        "logistic": M.logistic("label"), "gaussian": M.naive_bayes("label", kind="gaussian"),
    }[stage]
    df = blobs(spark)
    model, out, seconds = M.fit_and_score([made], df, df)
    assert E.overall_metrics(out).first()["accuracy"] > 0.95 and seconds > 0
    assert out.count() == 120 and out.select("prediction").distinct().count() == 3


@pytest.mark.parametrize("kind,tolerance", [("ordinary", 1e-6), ("lasso", 0.3), ("ridge", 0.3)])
def test_regressions_recover_a_line(spark, kind, tolerance):
    rnd = np.random.default_rng(6)
    x = rnd.normal(size=(200, 2))
    df = spark.createDataFrame([(Vectors.dense(*row), float(3 * row[0] - 2 * row[1] + 5)) for row in x], ["features", "y"])
    got = {r["name"]: r["value"] for r in M.coefficients(M.linear("y", kind=kind).fit(df), ["a", "b"], spark).collect()}
    assert got["a"] == pytest.approx(3, abs=tolerance) and got["b"] == pytest.approx(-2, abs=tolerance)


def test_tuning_table_is_sorted(spark):
    tree = M.decision_tree("label")
    judge = MulticlassClassificationEvaluator(metricName="accuracy")
    tuned = M.cross_validate(tree, M.param_grid([(tree.maxDepth, [1, 3])]), judge, blobs(spark).withColumn("id", F.monotonically_increasing_id()), "id", folds=3)
    table = M.tuning_table(tuned, spark).collect()
    assert [r["settings"]["maxDepth"] for r in table] == ["3", "1"] and table[0]["score"] >= table[1]["score"]


def test_weighted_fit_and_hard_area(spark):
    df = G.with_class_weights(blobs(spark, 2).withColumn("label", F.col("label")), "label", 1.0)
    out = Pipeline(stages=[M.logistic("label", weight="weight", rounds=10)]).fit(df).transform(df)
    assert E.area_under_roc_ml(out) > 0.99 and E.area_under_roc_ml(out, "prediction") > 0.95
