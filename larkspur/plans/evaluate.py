"""Metrics of predictions, each from one grouped pass."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml.evaluation import BinaryClassificationEvaluator, ClusteringEvaluator
from pyspark.sql import Column, DataFrame, Window, functions as F

from larkspur.operators.aggregates import contingency
from larkspur.operators.ordered import running_total
from larkspur.session import written


def confusion_counts(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """``(label, prediction, n, share)``; the share is within the label."""
    counted = df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(F.count(F.lit(1)).alias("n"))
    of_label = F.sum("n").over(Window.partitionBy("label"))
    return counted.withColumn("share", F.col("n").cast("double") / of_label)


def confusion_wide(df: DataFrame, classes: Sequence[object], label: str = "label", prediction: str = "prediction", other: str = "other") -> DataFrame:
    """One row per label, one count column per listed class, and ``other`` for every other prediction."""
    return contingency(df, label, prediction, classes, other)


def _ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b), F.lit(0.0))


def class_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Support, hits, precision, recall and F1 of each class seen as label or prediction; 0 where undefined."""
    cells = df.groupBy(F.col(label).alias("l"), F.col(prediction).alias("p")).agg(F.count(F.lit(1)).alias("n"))
    sides = cells.select(
        F.explode(F.array(F.struct(F.col("l").alias("class"), F.lit(True).alias("actual")), F.struct(F.col("p").alias("class"), F.lit(False).alias("actual")))).alias("s"),
        "n", (F.col("l") == F.col("p")).alias("hit"),
    )
    per_class = sides.groupBy(F.col("s.class").alias("class")).agg(
        F.sum(F.when(F.col("s.actual"), F.col("n")).otherwise(0)).alias("support"),
        F.sum(F.when(~F.col("s.actual"), F.col("n")).otherwise(0)).alias("predicted"),
        F.sum(F.when(F.col("s.actual") & F.col("hit"), F.col("n")).otherwise(0)).alias("hits"),
    )
    precision, recall = _ratio(F.col("hits"), F.col("predicted")), _ratio(F.col("hits"), F.col("support"))
    return per_class.withColumns(
        {"precision": precision, "recall": recall, "f1": _ratio(2 * precision * recall, precision + recall)}
    )


def overall_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Accuracy and support-weighted precision, recall and F1."""
    rows = class_metrics(df, label, prediction)
    weighted = lambda c: (F.sum(F.col(c) * F.col("support")) / F.sum("support")).alias(f"weighted_{c}")
    return rows.agg(
        (F.sum("hits").cast("double") / F.sum("support")).alias("accuracy"), *[weighted(c) for c in ("precision", "recall", "f1")]
    )


def class_rates(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """True and false positive rate of each class."""
    rows = class_metrics(df, label, prediction)
    n = df.agg(F.count(F.lit(1))).scalar()
    return rows.select(
        "class", F.col("recall").alias("true_positive_rate"),
        _ratio(F.col("predicted") - F.col("hits"), n - F.col("support")).alias("false_positive_rate"),
    )


def misclassified(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return df.filter(F.col(label) != F.col(prediction))


def most_confident(df: DataFrame, predicted: object, score: str, k: int, tie: Sequence[str], prediction: str = "prediction") -> DataFrame:
    return df.filter(F.col(prediction) == predicted).orderBy(F.desc(score), *tie).limit(k)


def regression_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """mse, rmse, mae and r2 in one aggregate."""
    miss = F.col(label) - F.col(prediction)
    mse = F.avg(miss * miss)
    return df.filter(miss.isNotNull()).agg(
        mse.alias("mse"), F.sqrt(mse).alias("rmse"), F.avg(F.abs(miss)).alias("mae"),
        (1 - F.try_divide(F.sum(miss * miss), F.var_pop(label) * F.count(label))).alias("r2"),
    )


def directional_accuracy(df: DataFrame, now: str, actual: str, forecast: str) -> DataFrame:
    """Per cent of rows whose forecast moves the same way as the actual value."""
    same = F.signum(F.col(actual) - F.col(now)) == F.signum(F.col(forecast) - F.col(now))
    n = F.count(F.lit(1))
    return df.agg(n.alias("n"), (F.count_if(same) * F.lit(100.0) / F.nullif(n, F.lit(0))).alias("direction_pct"))


def _score_totals(df: DataFrame, score: str, label: str, positive: object) -> DataFrame:
    """Positives and negatives per distinct score, and how many lie at or above it."""
    hit = F.col(label) == F.lit(positive)
    per_score = df.groupBy(F.col(score).cast("double").alias("score")).agg(
        F.count_if(hit).alias("pos"), F.count_if(~hit).alias("neg")
    )
    falling = written(per_score, "scores").withColumn("__down", -F.col("score"))
    return running_total(falling, {"tp": F.col("pos"), "fp": F.col("neg"), "rank": F.lit(1).cast("long")}, ["__down"]).drop("__down")


def _class_sizes(df: DataFrame, label: str, positive: object) -> Column:
    hit = F.col(label) == F.lit(positive)
    return df.agg(F.struct(F.count_if(hit).alias("p"), F.count_if(~hit).alias("n"))).scalar()


def curve_points(df: DataFrame, score: str, label: str, positive: object = 1, max_points: int | None = None) -> DataFrame:
    """Threshold curve ``(score, tp, fp, tpr, fpr, precision)``, one row per distinct score.

    ``max_points`` thins the curve evenly by rank for a chart; the end point stays.
    """
    points, size = _score_totals(df, score, label, positive), _class_sizes(df, label, positive)
    if max_points:
        last = df.agg(F.count_distinct(F.col(score).cast("double"))).scalar()
        step = F.greatest(F.lit(1), F.ceil(last / F.lit(max_points)))
        points = points.filter((F.col("rank") % step == 0) | (F.col("rank") == last))
    return points.select(
        "score", "tp", "fp",
        _ratio(F.col("tp"), size["p"]).alias("tpr"), _ratio(F.col("fp"), size["n"]).alias("fpr"),
        _ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
    )


def area_under_roc(df: DataFrame, score: str, label: str, positive: object = 1) -> DataFrame:
    """Exact area, ties counted half, from per-score counts."""
    points, size = _score_totals(df, score, label, positive), _class_sizes(df, label, positive)
    above = F.col("tp") - F.col("pos") + F.col("pos") / F.lit(2.0)
    return points.agg(F.try_divide(F.sum(F.col("neg") * above), (size["p"] * size["n"]).cast("double")).alias("auc"))


def area_under_roc_ml(df: DataFrame, raw: str = "rawPrediction", label: str = "label") -> float:
    """MLlib's area; pass a 0/1 prediction column to judge hard decisions instead of scores."""
    return BinaryClassificationEvaluator(rawPredictionCol=raw, labelCol=label, numBins=0).evaluate(df)


def silhouette(df: DataFrame, features: str = "features", prediction: str = "prediction") -> float:
    return ClusteringEvaluator(featuresCol=features, predictionCol=prediction).evaluate(df)


def comparison(rows: Sequence[DataFrame]) -> DataFrame:
    """One table from one-row metric frames."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows)


def best_model(table: DataFrame, metric: str, larger_is_better: bool = True) -> DataFrame:
    return table.orderBy(F.desc(metric) if larger_is_better else F.asc(metric), "model").limit(1)
