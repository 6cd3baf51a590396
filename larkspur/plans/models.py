"""Model factories, training, tuning and model read-outs."""

from __future__ import annotations

import time
from collections.abc import Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier, GBTClassifier, LinearSVC, LogisticRegression, NaiveBayes, OneVsRest, RandomForestClassifier,
)
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator, Evaluator
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession, functions as F

from larkspur.operators.sampling import hash_bucket, hash_split


@contextmanager
def held(df: DataFrame):
    """Keep a frame that several jobs read, on memory and disk, and release it afterwards."""
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield kept
    finally:
        kept.unpersist()


def linear(label: str, features: str = "features", kind: str = "ordinary", strength: float = 0.1) -> LinearRegression:
    """``ordinary``, ``lasso`` or ``ridge`` regression."""
    mixing = {"ordinary": (0.0, 0.0), "lasso": (strength, 1.0), "ridge": (strength, 0.0)}
    penalty, mix = mixing[kind]
    return LinearRegression(labelCol=label, featuresCol=features, regParam=penalty, elasticNetParam=mix)


def boosted_regressor(label: str, features: str = "features", rounds: int = 20, depth: int = 5, seed: int = 42) -> GBTRegressor:
    return GBTRegressor(labelCol=label, featuresCol=features, maxIter=rounds, maxDepth=depth, seed=seed)


def logistic(
    label: str, features: str = "features", rounds: int = 50, weight: str | None = None, penalty: float = 0.0
) -> LogisticRegression:
    model = LogisticRegression(labelCol=label, featuresCol=features, maxIter=rounds, regParam=penalty)
    return model.setWeightCol(weight) if weight else model


def linear_svm(label: str, features: str = "features", rounds: int = 50, penalty: float = 0.1) -> LinearSVC:
    return LinearSVC(labelCol=label, featuresCol=features, maxIter=rounds, regParam=penalty)


def naive_bayes(label: str, features: str = "features", kind: str = "multinomial", smoothing: float = 1.0) -> NaiveBayes:
    """``multinomial``, ``gaussian`` or ``bernoulli``."""
    return NaiveBayes(labelCol=label, featuresCol=features, modelType=kind, smoothing=smoothing)


def decision_tree(label: str, features: str = "features", impurity: str = "entropy", depth: int = 4, seed: int = 1234):
    return DecisionTreeClassifier(labelCol=label, featuresCol=features, impurity=impurity, maxDepth=depth, seed=seed)


def random_forest(label: str, features: str = "features", trees: int = 20, depth: int = 4, seed: int = 42):
    return RandomForestClassifier(labelCol=label, featuresCol=features, numTrees=trees, maxDepth=depth, seed=seed)


def boosted_classifier(label: str, features: str = "features", rounds: int = 10, depth: int = 10, seed: int = 42):
    return GBTClassifier(labelCol=label, featuresCol=features, maxIter=rounds, maxDepth=depth, seed=seed)


def one_vs_rest(base: Estimator, label: str, features: str = "features", parallelism: int = 2) -> OneVsRest:
    return OneVsRest(classifier=base, labelCol=label, featuresCol=features, parallelism=parallelism)


def kmeans(k: int, features: str = "features", seed: int = 1) -> KMeans:
    return KMeans(k=k, featuresCol=features, seed=seed)


def fit_and_score(stages: Sequence, train: DataFrame, test: DataFrame) -> tuple[PipelineModel, DataFrame, float]:
    """Fit every stage on the training part only; returns model, scored test part and fit seconds."""
    started = time.perf_counter()
    model = Pipeline(stages=list(stages)).fit(train)
    return model, model.transform(test), time.perf_counter() - started


def sweep_k(df: DataFrame, ks: Sequence[int], features: str = "features", seed: int = 1) -> tuple[DataFrame, KMeansModel]:
    """Fit one clustering per ``k``; returns ``(k, silhouette, cost)`` and the model with the best silhouette."""
    judge = ClusteringEvaluator(featuresCol=features, predictionCol="prediction", metricName="silhouette")
    rows, best = [], None
    with held(df.select(features)) as points:
        for k in ks:
            model = kmeans(k, features, seed).fit(points)
            score = float(judge.evaluate(model.transform(points)))
            rows.append((k, score, float(model.summary.trainingCost)))
            if best is None or score > best[0]:
                best = (score, model)
    return df.sparkSession.createDataFrame(rows, "k int, silhouette double, cost double"), best[1]


def param_grid(choices: Sequence[tuple[object, Sequence]]) -> list:
    """All combinations of ``[(param, values), ...]``."""
    builder = ParamGridBuilder()
    for param, values in choices:
        builder = builder.addGrid(param, list(values))
    return builder.build()


def cross_validate(stage: Estimator, grid: list, judge: Evaluator, train: DataFrame, key: str, folds: int = 5, parallelism: int = 2):
    """Tune by cross-validation; a row's fold follows from a hash of its ``key``, not from its partition."""
    tuner = CrossValidator(
        estimator=stage, estimatorParamMaps=grid, evaluator=judge, numFolds=folds, parallelism=parallelism, foldCol="__fold"
    )
    with held(train.withColumn("__fold", hash_bucket(key, folds, salt="fold").cast("int"))) as kept:
        return tuner.fit(kept)


@dataclass(frozen=True)
class Tuned:
    """Validation score of each grid point, and the best setting fitted on all training rows."""

    grid: list
    validationMetrics: list[float]
    bestModel: Model

    def getEstimatorParamMaps(self) -> list:
        return self.grid


def validate_once(stage: Estimator, grid: list, judge: Evaluator, train: DataFrame, key: str, percent: int = 80) -> Tuned:
    """Tune on one split by a hash of ``key``; the best setting is fitted again on all rows of ``train``."""
    with held(train) as kept:
        fitted, judged = hash_split(kept, key, percent)
        scores = [float(judge.evaluate(stage.fit(fitted, point).transform(judged))) for point in grid]
        pick = max if judge.isLargerBetter() else min
        return Tuned(grid, scores, stage.fit(kept, grid[scores.index(pick(scores))]))


def tuning_table(tuned: Model, spark: SparkSession, larger_is_better: bool = True) -> DataFrame:
    """Score of each grid point, best first, with its settings as a map of strings."""
    scores = getattr(tuned, "avgMetrics", None) or tuned.validationMetrics
    rows = [
        ({param.name: str(value) for param, value in point.items()}, float(score))
        for point, score in zip(tuned.getEstimatorParamMaps(), scores)
    ]
    order = F.desc("score") if larger_is_better else F.asc("score")
    return spark.createDataFrame(rows, "settings map<string,string>, score double").orderBy(order)


def coefficients(model, names: Sequence[str], spark: SparkSession) -> DataFrame:
    """``(name, value)`` of a fitted linear model, with its intercept."""
    rows = [(n, float(v)) for n, v in zip(names, model.coefficients)] + [("intercept", float(model.intercept))]
    return spark.createDataFrame(rows, "name string, value double")


def cluster_centres(model: KMeansModel, spark: SparkSession) -> DataFrame:
    rows = [(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())]
    return spark.createDataFrame(rows, "cluster int, centre array<double>")


def tree_text(model, spark: SparkSession) -> DataFrame:
    """One row per line of a fitted tree's rules."""
    rows = [(i, line) for i, line in enumerate(model.toDebugString.splitlines())]
    return spark.createDataFrame(rows, "line int, rule string")


def metric_row(spark: SparkSession, name: str, **metrics: float) -> DataFrame:
    """One row of a model comparison table."""
    return spark.createDataFrame([(name, *map(float, metrics.values()))], ["model", *metrics])
