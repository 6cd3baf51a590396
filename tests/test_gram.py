"""Linear models from sufficient statistics against MLlib and plain NumPy."""

import numpy as np
import pytest
from pyspark.ml.regression import LinearRegression

from larkspur.plans import features as G
from larkspur.plans.gram import Gram, fold_grams, gram_frame, read_gram, tune_linear

NAMES = ["a", "b", "c", "d"]


def table(spark, n=400, seed=4, far=100.0):
    draw = np.random.default_rng(seed)
    x = draw.normal(size=(n, 4)) * [1, 30, 0.01, 5] + [0, far, 3, -7]
    x[:, 3] += 2 * x[:, 0]
    y = far + 3 * x[:, 0] - 0.5 * (x[:, 1] - far) + draw.normal(size=n)
    return spark.createDataFrame([(i, *map(float, v), float(t)) for i, (v, t) in enumerate(zip(x, y))], "id long, a double, b double, c double, d double, y double")


@pytest.mark.parametrize("strength,mix", [(0.0, 0.0), (0.5, 0.0), (20.0, 0.0), (0.5, 1.0), (4.0, 1.0), (2.0, 0.4)])
def test_fits_equal_mllib(spark, strength, mix):
    df = table(spark)
    gram = fold_grams(df, NAMES, "y")[0]
    slopes, intercept = gram.fit(strength, mix)
    model = LinearRegression(labelCol="y", regParam=strength, elasticNetParam=mix, solver="normal", tol=1e-12, maxIter=1000).fit(G.assembler(NAMES).transform(df))
    assert np.allclose(slopes, model.coefficients.toArray(), rtol=1e-5, atol=1e-6)
    assert np.isclose(intercept, model.intercept, rtol=1e-6)
    rows = np.array(df.select(*NAMES, "y").collect())
    error = ((rows[:, -1] - rows[:, :-1] @ slopes - intercept) ** 2).sum()
    assert np.isclose(gram.squared_error(slopes, intercept), error, rtol=1e-6)


def test_values_far_from_zero_keep_their_digits(spark):
    df = table(spark, far=1e8)
    slopes, intercept = fold_grams(df, NAMES, "y")[0].fit()
    rows = np.array(df.select(*NAMES, "y").collect())
    centred = rows - rows.mean(axis=0)
    assert np.allclose(slopes, np.linalg.lstsq(centred[:, :-1], centred[:, -1], rcond=None)[0], rtol=1e-6, atol=1e-6)
    assert np.isclose(intercept, rows.mean(axis=0)[-1] - slopes @ rows.mean(axis=0)[:-1], rtol=1e-9)


def test_states_add_up_and_survive_writing(spark, tmp_path):
    df = table(spark)
    whole, early, late = (fold_grams(x, NAMES, "y")[0] for x in (df, df.filter("id < 150"), df.filter("id >= 150")))
    path = str(tmp_path / "state")
    gram_frame(spark, early).write.parquet(path)
    merged = read_gram(spark.read.parquet(path), NAMES, "y") + late
    assert merged.n == whole.n == 400
    for a, b in zip(merged.moments(), whole.moments()):
        assert np.allclose(a, b, rtol=1e-9, atol=1e-9)
    assert np.allclose((whole - late).moments()[1], early.moments()[1], rtol=1e-6, atol=1e-9)
    with pytest.raises(ValueError, match="do not add up"):
        whole + Gram(("x", "y"), (0.0, 0.0), np.eye(3))


def test_folds_and_choice(spark):
    df = table(spark, 900)
    grid = [("ordinary", 0.0), ("ridge", 5.0), ("lasso", 5.0), ("lasso", 1e6)]
    tuned = tune_linear(df, NAMES, "y", "id", grid, folds=4)
    folds = fold_grams(df, NAMES, "y", "id", 4)
    assert sum(g.n for g in folds.values()) == 900 and len(folds) == 4
    assert tuned.kind == "ordinary" and [s[:2] for s in tuned.scores] == [(k, float(s)) for k, s in grid]
    best = LinearRegression(labelCol="y", solver="normal").fit(G.assembler(NAMES).transform(df))
    assert np.allclose([tuned.slopes[n] for n in NAMES], best.coefficients.toArray(), rtol=1e-4, atol=1e-5)
    rows = tuned.predict(df).selectExpr("avg(abs(y - prediction)) AS miss").first()
    assert rows["miss"] < 1.0
    assert tuned.scores[3][2] > 10 * tuned.scores[0][2]  # so strong a lasso leaves the mean


def test_odd_rows(spark):
    rows = [(1, 1.0, 2.0, 5.0), (2, None, 2.0, 5.0), (3, float("nan"), 2.0, 5.0), (4, float("inf"), 2.0, 5.0), (5, 2.0, 2.0, 7.0), (6, 3.0, 2.0, None), (7, 3.0, 2.0, 9.0)]
    df = spark.createDataFrame(rows, "id long, a double, b double, y double")
    gram = fold_grams(df, ["a", "b"], "y")[0]
    assert gram.n == 3
    slopes, intercept = gram.fit()
    assert np.allclose(slopes, [2.0, 0.0]) and np.isclose(intercept, 3.0)  # a constant feature has no slope
    assert fold_grams(df.filter("id = 2"), ["a"], "y") == {}
    with pytest.raises(ValueError, match="no complete row"):
        tune_linear(df.limit(0), ["a"], "y", "id", [("ridge", 0.1)])
