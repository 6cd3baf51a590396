"""Certificates of linear classifiers against objectives computed with NumPy and better solutions."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors

from larkspur.plans import models as M
from larkspur.plans.certificates import logistic_certificate, svm_certificate


def table(spark, n=400, sparse=True):
    draw = np.random.default_rng(11)
    x = draw.normal(size=(n, 6)) * (draw.random((n, 6)) < 0.5) * [1, 5, 0.2, 1, 1, 0]
    y = (x[:, 0] - 0.3 * x[:, 1] + 0.4 * draw.normal(size=n) > 0.1).astype(float)
    vectors = [Vectors.sparse(6, [(j, v) for j, v in enumerate(r) if v]) if sparse else Vectors.dense(r) for r in x]
    return spark.createDataFrame(list(zip(vectors, y.tolist())), ["features", "label"]), x, y


def objective(kind, x, y, weights, intercept, penalty):
    margin = (2 * y - 1) * (x @ weights + intercept)
    loss = np.log1p(np.exp(-margin)) if kind == "logistic" else np.maximum(1 - margin, 0)
    return loss.mean() + penalty / 2 * ((weights * x.std(axis=0, ddof=1)) ** 2).sum()


@pytest.mark.parametrize("sparse", [True, False])
@pytest.mark.parametrize("rounds", [2, 100])
def test_logistic(spark, sparse, rounds):
    df, x, y = table(spark, sparse=sparse)
    model = M.logistic("label", rounds=rounds, penalty=0.05).setTol(1e-12).fit(df)
    found = logistic_certificate(model, df, penalty=0.05)
    mine = objective("logistic", x, y, model.coefficients.toArray(), model.intercept, 0.05)
    assert found.n == len(y) and found.objective == pytest.approx(mine, rel=1e-9)
    best = M.logistic("label", rounds=500, penalty=0.05).setTol(1e-14).fit(df)
    least = objective("logistic", x, y, best.coefficients.toArray(), best.intercept, 0.05)
    if rounds == 100:
        assert found.gradient < 1e-5 and found.gap < 1e-8
    else:
        assert found.gradient > 1e-3 and found.objective - least > 0


@pytest.mark.parametrize("rounds", [1, 200])
def test_svm(spark, rounds):
    df, x, y = table(spark)
    model = M.linear_svm("label", rounds=rounds, penalty=0.1).fit(df)
    found = svm_certificate(model, df, 0.1)
    assert found.objective == pytest.approx(objective("svm", x, y, model.coefficients.toArray(), model.intercept, 0.1), rel=1e-9)
    draw, least = np.random.default_rng(1), found.objective
    weights, intercept = model.coefficients.toArray(), model.intercept
    for _ in range(3_000):  # no point found by search lies below the bound
        step = draw.normal(size=7) * draw.choice([0.3, 0.05, 0.01])
        value = objective("svm", x, y, weights + step[:6], intercept + step[6], 0.1)
        if value < least:
            least, weights, intercept = value, weights + step[:6], intercept + step[6]
    assert found.objective - found.gap <= least + 1e-9
    assert found.gap < 0.5 * found.objective if rounds == 200 else found.gap > 0


def test_one_class(spark):
    df, *_ = table(spark)
    model = M.linear_svm("label", rounds=5).fit(df)
    found = svm_certificate(model, df.filter("label = 1"), 0.1)
    assert found.gap == found.objective
