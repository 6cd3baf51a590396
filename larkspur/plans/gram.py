"""Linear models from sufficient statistics: one scan, whatever the number of folds, strengths and penalties.

A state holds the cross-products of ``(1, features, label)`` around an origin,
summed over rows.  States of parts of a table add up, and the state of all folds
but one is a difference, so a grid of settings is tuned, and the chosen one
fitted, without reading the table again.  A state has ``(p + 2) ** 2`` numbers
for ``p`` features, however many rows it covers; it can be written and later
added to the state of new rows.

Penalties follow MLlib: features and label are scaled by their population
deviations, the strength is divided by that of the label, ``mix`` 0 is ridge, 1
is lasso, and the intercept is free.  Rows with a null, NaN or infinite feature
or label take no part.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from larkspur.operators.sampling import hash_bucket

#: Penalty of each kind: what part of the strength goes to absolute values.
KINDS = {"ordinary": 0.0, "ridge": 0.0, "lasso": 1.0}


@dataclass(frozen=True)
class Gram:
    """Sums of the cross-products of ``(1, features - origin, label - origin)``."""

    names: tuple[str, ...]  # features, then the label
    origin: tuple[float, ...]
    cells: np.ndarray

    @property
    def n(self) -> float:
        return float(self.cells[0, 0])

    def around(self, origin: Sequence[float]) -> Gram:
        """The same rows around another origin."""
        move = np.eye(len(self.cells))
        move[1:, 0] = np.subtract(self.origin, origin)
        return Gram(self.names, tuple(map(float, origin)), move @ self.cells @ move.T)

    def __add__(self, other: Gram) -> Gram:
        if self.names != other.names:
            raise ValueError(f"states of {self.names} and {other.names} do not add up")
        return Gram(self.names, self.origin, self.cells + other.around(self.origin).cells)

    def __sub__(self, other: Gram) -> Gram:
        return self + Gram(other.names, other.origin, -other.cells)

    def moments(self) -> tuple[np.ndarray, np.ndarray]:
        """Means, and population covariances, of features and label."""
        shift = self.cells[0, 1:] / self.n
        return shift + self.origin, self.cells[1:, 1:] / self.n - np.outer(shift, shift)

    def fit(self, strength: float = 0.0, mix: float = 0.0) -> tuple[np.ndarray, float]:
        """Coefficients and intercept; constant features get 0, and of tied solutions the shortest is taken."""
        mean, cov = self.moments()
        scale = np.sqrt(np.maximum(np.diag(cov), 0.0))
        used = np.flatnonzero(scale[:-1] > 1e-12 * np.maximum(1.0, np.abs(mean[:-1])))
        slopes = np.zeros(len(mean) - 1)
        if len(used) and scale[-1] > 0:
            inner = cov[np.ix_(used, used)] / np.outer(scale[used], scale[used])
            target = cov[used, -1] / (scale[used] * scale[-1])
            lasso, ridge = mix * strength / scale[-1], (1 - mix) * strength / scale[-1]
            inner = inner + ridge * np.eye(len(used))
            solved = _descend(inner, target, lasso) if lasso else np.linalg.lstsq(inner, target, rcond=1e-12)[0]
            slopes[used] = solved * scale[-1] / scale[used]
        return slopes, float(mean[-1] - slopes @ mean[:-1])

    def squared_error(self, slopes: np.ndarray, intercept: float) -> float:
        """Sum of squared errors of a model over the rows of this state."""
        mean, cov = self.moments()
        weights = np.append(-slopes, 1.0)
        return self.n * float(max(weights @ cov @ weights, 0.0) + (weights @ mean - intercept) ** 2)


def _descend(inner: np.ndarray, target: np.ndarray, lasso: float) -> np.ndarray:
    """Coordinate descent for ``b'Ab / 2 - b'c + lasso |b|``."""
    found = np.zeros(len(target))
    for _ in range(100_000):
        moved = 0.0
        for j in range(len(target)):
            rest = target[j] - inner[j] @ found + inner[j, j] * found[j]
            new = np.sign(rest) * max(abs(rest) - lasso, 0.0) / inner[j, j]
            moved, found[j] = max(moved, abs(new - found[j])), new
        if moved < 1e-13:
            break
    return found


def fold_grams(df: DataFrame, features: Sequence[str], label: str, key: str | None = None, folds: int = 1) -> dict[int, Gram]:
    """State of each non-empty fold, all from one scan; a row's fold follows from a hash of ``key``."""
    names = (*features, label)
    fold = hash_bucket(key, folds, salt="fold").cast("int") if key and folds > 1 else F.lit(0)
    rows = df.select(fold.alias("__fold"), *[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(names)])
    for i in range(len(names)):
        rows = rows.filter(F.abs(f"c{i}") < F.lit(float("inf")))  # false for NaN, null for null
    first = rows.first()
    if first is None:
        return {}
    origin, width = np.array(first[1:], "f8"), len(names) + 1

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            fold_of = batch.column(0).to_numpy()
            values = np.column_stack([np.ones(len(batch)), *[batch.column(i).to_numpy() - origin[i - 1] for i in range(1, width)]])
            for f in np.unique(fold_of).tolist():
                mine = values[fold_of == f]
                sums[f] = sums.get(f, 0.0) + mine.T @ mine
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([m.ravel().tolist() for m in sums.values()])], names=["fold", "cells"])

    parts = rows.mapInArrow(part, "fold int, cells array<double>").select("fold", F.posexplode("cells").alias("at", "value"))
    found: dict[int, np.ndarray] = {}
    for r in parts.groupBy("fold", "at").agg(F.sum("value").alias("value")).collect():  # (p + 2) ** 2 rows a fold
        found.setdefault(r["fold"], np.zeros(width * width))[r["at"]] = r["value"]
    return {f: Gram(names, tuple(origin.tolist()), cells.reshape(width, width)) for f, cells in sorted(found.items())}


def gram_frame(spark: SparkSession, gram: Gram) -> DataFrame:
    """A state as rows ``(a, b, origin, value)``, to be written and read again; the empty name is the constant."""
    names, origin = ("", *gram.names), (0.0, *gram.origin)
    rows = [(a, b, origin[i], float(gram.cells[i, j])) for i, a in enumerate(names) for j, b in enumerate(names)]
    return spark.createDataFrame(rows, "a string, b string, origin double, value double")


def read_gram(frame: DataFrame, features: Sequence[str], label: str) -> Gram:
    names = ("", *features, label)
    rows = {(r["a"], r["b"]): (r["origin"], r["value"]) for r in frame.collect()}
    return Gram(names[1:], tuple(rows[n, ""][0] for n in names[1:]), np.array([[rows[a, b][1] for b in names] for a in names]))


@dataclass(frozen=True)
class LinearTuning:
    """Mean error over the folds per setting ``(kind, strength)``, and the best setting fitted on all rows."""

    scores: list[tuple[str, float, float]]
    kind: str
    strength: float
    slopes: dict[str, float]
    intercept: float

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.scores, "kind string, strength double, score double").orderBy("score", "kind", "strength")

    def predict(self, df: DataFrame, output: str = "prediction") -> DataFrame:
        return df.withColumn(output, sum((F.col(c) * v for c, v in self.slopes.items()), F.lit(self.intercept)))


def tune_linear(df: DataFrame, features: Sequence[str], label: str, key: str, grid: Sequence[tuple[str, float]], folds: int = 5) -> LinearTuning:
    """Cross-validated root mean squared error of each ``(kind, strength)``; ties go to the earlier setting."""
    grams = fold_grams(df, features, label, key, folds)
    if not grams:
        raise ValueError("no complete row to tune on")
    total = sum(list(grams.values())[1:], next(iter(grams.values())))
    scores = []
    for kind, strength in grid:
        errors = [np.sqrt(g.squared_error(*(total - g).fit(strength, KINDS[kind])) / g.n) for g in grams.values() if total.n > g.n]
        scores.append((kind, float(strength), float(np.mean(errors)) if errors else float("nan")))
    kind, strength, _ = min(scores, key=lambda s: s[2])
    slopes, intercept = total.fit(strength, KINDS[kind])
    return LinearTuning(scores, kind, strength, dict(zip(features, map(float, slopes))), intercept)
