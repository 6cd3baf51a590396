"""How far a fitted linear classifier can be from the best one, from one aggregate.

Rows are read once in long sparse form ``(feature, value)``, with one more entry
per row for the intercept, and summed per feature: as many numbers reach the
driver as the model has coefficients.

``logistic`` gives the objective, the length of its gradient and, with a penalty,
a bound on the distance to the least objective: ``|gradient|**2 / (2 * penalty)``,
which holds where the gradient of the free intercept is zero.
``svm`` gives the objective and the duality gap of a feasible dual point: every
row inside the margin has weight one, the heavier class is scaled down so that
both weigh the same, and the best common factor is taken.  The least objective
lies between objective minus gap and objective, whatever the fit did.

Both follow MLlib's penalty on coefficients of features scaled by their sample
deviations.  Labels are 0 and 1; constant features carry no penalty weight.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.ml.functions import vector_to_array


@dataclass(frozen=True)
class Certificate:
    n: int
    objective: float
    gradient: float | None  # length of the gradient, for smooth losses
    gap: float | None  # how much better the best model can be at most


def _entries(features: str) -> Column:
    """Stored entries of a sparse or dense vector as an array of (index, value), and one (-1, 1.0)."""
    raw = F.unwrap_udt(F.col(features))
    dense = F.transform(raw["values"], lambda x, i: F.struct(i.alias("index"), x.alias("value")))
    sparse = F.transform(F.arrays_zip(raw["indices"], raw["values"]), lambda e: F.struct(e["indices"].alias("index"), e["values"].alias("value")))
    return F.concat(F.when(raw["type"] == 0, sparse).otherwise(dense), F.array(F.struct(F.lit(-1).alias("index"), F.lit(1.0).alias("value"))))


def _sums(model, df: DataFrame, features: str, label: str, loss: Column, push: Column) -> dict[str, np.ndarray]:
    """Per feature (the intercept last) the sums of value, its square, and value times ``push`` among each class; and of the loss."""
    scored = model.transform(df.select(features, label)).withColumn("z", F.get(vector_to_array("rawPrediction"), F.lit(1)))
    rows = scored.select(F.col(label).alias("y"), loss.alias("loss"), push.alias("push"), F.explode(_entries(features)).alias("e")).select("*", "e.index", "e.value")
    value, first = F.col("value"), F.col("index") == -1
    sums = rows.groupBy("index").agg(
        F.sum(value).alias("x"), F.sum(value * value).alias("xx"), F.sum(F.when(F.col("y") == 1, value * F.col("push")).otherwise(0.0)).alias("up"),
        F.sum(F.when(F.col("y") == 0, value * F.col("push")).otherwise(0.0)).alias("down"), F.sum(F.when(first, F.col("loss")).otherwise(0.0)).alias("loss"),
    )
    out = {name: np.zeros(model.numFeatures + 1) for name in ("x", "xx", "up", "down", "loss")}
    for r in sums.collect():  # a row per coefficient of the model
        for name in out:
            out[name][r["index"]] = r[name]
    return out


def _scaled(model, sums: dict[str, np.ndarray]) -> tuple[float, np.ndarray, np.ndarray]:
    """Rows, deviations of the features, and coefficients of scaled features."""
    n = sums["x"][-1]
    variance = (sums["xx"][:-1] - sums["x"][:-1] ** 2 / n) / max(n - 1, 1)
    deviation = np.sqrt(np.maximum(variance, 0.0))
    return n, deviation, model.coefficients.toArray() * deviation


def logistic_certificate(model, df: DataFrame, features: str = "features", label: str = "label", penalty: float = 0.0) -> Certificate:
    z, y = F.col("z"), F.col(label)
    signed = F.when(y == 1, z).otherwise(-z)
    loss = F.when(signed > 0, F.log1p(F.exp(-signed))).otherwise(F.log1p(F.exp(signed)) - signed)
    sums = _sums(model, df, features, label, loss, 1 / (1 + F.exp(-z)) - y)
    n, deviation, weights = _scaled(model, sums)
    slope = (sums["up"] + sums["down"]) / n
    inner = np.divide(slope[:-1], deviation, out=np.zeros_like(deviation), where=deviation > 0) + penalty * weights
    objective = float(sums["loss"][-1] / n + penalty / 2 * (weights @ weights))
    return Certificate(int(n), objective, float(np.sqrt(inner @ inner + slope[-1] ** 2)), float(inner @ inner / (2 * penalty)) if penalty else None)


def svm_certificate(model, df: DataFrame, penalty: float, features: str = "features", label: str = "label") -> Certificate:
    margin = F.when(F.col(label) == 1, F.col("z")).otherwise(-F.col("z"))
    sums = _sums(model, df, features, label, F.greatest(1 - margin, F.lit(0.0)), F.when(margin < 1, 1.0).otherwise(0.0))
    n, deviation, weights = _scaled(model, sums)
    objective = float(sums["loss"][-1] / n + penalty / 2 * (weights @ weights))
    up, down = sums["up"][-1], sums["down"][-1]
    lighter = min(up, down)
    if lighter <= 0:
        return Certificate(int(n), objective, None, objective)  # only the zero dual point is feasible
    pull = (sums["up"][:-1] * (lighter / up) - sums["down"][:-1] * (lighter / down)) / n
    pull = np.divide(pull, deviation, out=np.zeros_like(deviation), where=deviation > 0)
    weight, square = 2 * lighter / n, float(pull @ pull)
    factor = min(1.0, weight * penalty / square) if square else 1.0
    return Certificate(int(n), objective, None, objective - (factor * weight - factor**2 * square / (2 * penalty)))
