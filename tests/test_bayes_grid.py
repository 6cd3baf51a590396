"""The one-table naive Bayes grid against MLlib's fits, and odd rows."""

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import IDF, CountVectorizer
from pyspark.sql import functions as F

from larkspur.operators.sampling import hash_split
from larkspur.plans import models as M
from larkspur.plans.bayes_grid import bayes_predictions, bayes_weights, validate_bayes


def documents(spark, n=500):
    draw = np.random.default_rng(8)
    rows = []
    for i in range(n):
        label = i % 3
        # term t0 is the most frequent, t1 the next and so on, so that a vocabulary has no ties at its end
        words = [f"t{w}" for w in np.minimum(draw.geometric(0.06 + 0.02 * label, draw.integers(1, 30)), 60)]
        rows.append((i, float(label), words))
    return spark.createDataFrame(rows, "id long, label double, tokens array<string>")


def stages(vocabulary, smoothing):
    return [CountVectorizer(inputCol="tokens", outputCol="tf", vocabSize=vocabulary), IDF(inputCol="tf", outputCol="features"), NaiveBayes(smoothing=smoothing)]


def test_grid_equals_fits_per_setting(spark):
    df = documents(spark)
    uses = [r["n"] for r in hash_split(df, "id")[0].select(F.explode("tokens").alias("t")).groupBy("t").agg(F.count("*").alias("n")).orderBy(F.desc("n")).collect()]
    sizes = [k for k in (5, 15, 30, 10_000) if k >= len(uses) or uses[k - 1] != uses[k]]
    assert len(sizes) >= 3
    found = {(r["vocabulary"], r["smoothing"]): r for r in validate_bayes(df, "id", "label", "tokens", sizes, [0.5, 2.0]).collect()}
    assert len(found) == 2 * len(sizes)
    counter, weights, bayes = stages(10, 1.0)
    grid = M.param_grid([(counter.vocabSize, sizes), (bayes.smoothing, [0.5, 2.0])])
    for metric in ("f1", "accuracy"):
        judge = MulticlassClassificationEvaluator(metricName=metric)
        tuned = M.validate_once(Pipeline(stages=[counter, weights, bayes]), grid, judge, df, "id")
        for point, score in zip(tuned.grid, tuned.validationMetrics):
            assert found[point[counter.vocabSize], point[bayes.smoothing]][metric] == pytest.approx(score, abs=1e-9)


def test_model_equals_mllib(spark):
    df = documents(spark)
    model = Pipeline(stages=stages(10_000, 0.5)).fit(df)
    weights = bayes_weights(df, "id", "label", "tokens", 10_000, 0.5)
    theta, terms = model.stages[-1].theta.toArray(), model.stages[0].vocabulary
    mine = {(r["label"], r["term"]): r["weight"] for r in weights.collect()}
    assert len(mine) == theta.size + 3
    for c in range(3):
        assert mine[float(c), None] == pytest.approx(model.stages[-1].pi[c], abs=1e-12)
        assert all(mine[float(c), t] == pytest.approx(theta[c][j], abs=1e-9) for j, t in enumerate(terms))
    theirs = {r["id"]: r["prediction"] for r in model.transform(df).select("id", "prediction").collect()}
    assert {r["id"]: r["prediction"] for r in bayes_predictions(weights, df, "id", "tokens").collect()} == theirs


def test_odd_rows(spark):
    rows = [(i, "a" if i % 4 else "b", ["x", "y"] if i % 4 else ["z"]) for i in range(60)] + [(100, None, ["x"]), (101, "a", None), (102, "a", []), (103, "b", ["unseen"])]
    df = spark.createDataFrame(rows, "id long, label string, tokens array<string>")
    found = validate_bayes(df, "id", "label", "tokens", [1, 50], [1.0], min_df=1).collect()
    assert {r["vocabulary"] for r in found} == {1, 50} and all(0 <= r["accuracy"] <= 1 for r in found)
    assert next(r for r in found if r["vocabulary"] == 50)["accuracy"] >= 0.9
    told = {r["id"]: r["prediction"] for r in bayes_predictions(bayes_weights(df, "id", "label", "tokens", 50, 1.0), df, "id", "tokens").collect()}
    assert 101 not in told and told[102] == "a" and told[4] == "b" and told[1] == "a"
    with pytest.raises(ValueError, match="no document"):
        validate_bayes(df.limit(0), "id", "label", "tokens", [5], [1.0])
