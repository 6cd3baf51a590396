"""Clusterings for many ``k`` from one weighted coreset, judged in passes that serve all of them.

Three passes over the points, whatever the number of ``k``:

1. each partition is read as a stream of blocks.  Blocks are reduced to at most
   ``size`` weighted points, and two reduced blocks of one rank are merged and
   reduced again, so a task holds a logarithmic number of them.  What partitions
   leave is merged in rounds of ``fan_in`` until one coreset is left;
2. weighted k-means runs on the coreset, one task per ``k``, and one pass over
   the points assigns them under every ``k`` and sums count, coordinates, squared
   norms and cost per cluster;
3. the sums give the mean squared distance of a point to any cluster without
   pairs of points, so one pass gives the silhouettes of all ``k``.

Reduction keeps a point with a chance that follows half its weight and half its
weighted squared distance from the block's mean, and divides its weight by that
chance, so every cost stays right on average; up to ``size`` distinct points
are kept as they are.  The draw is seeded by the block's content, not by its
place, and a block is sorted first.

Points that are null or hold null, NaN or infinite values take no part.  If a
``k`` exceeds the distinct points of the coreset, it gets that many clusters.
Ties between centres go to the first.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from larkspur.session import written

_SCHEMA = "weight double, point array<double>"


def reduced(points: np.ndarray, weights: np.ndarray, size: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """At most ``size`` weighted points that stand for the given ones; equal points are one first."""
    points, place = np.unique(points, axis=0, return_inverse=True)
    weights = np.bincount(place.ravel(), weights, len(points))
    if len(points) <= size:
        return points, weights
    total = weights.sum()
    far = weights * ((points - weights @ points / total) ** 2).sum(1)
    chance = 0.5 * weights / total + 0.5 * far / max(far.sum(), 1e-300)
    chance /= chance.sum()
    draw = np.random.default_rng([seed, zlib.crc32(points.tobytes())])
    times = np.bincount(np.searchsorted(np.cumsum(chance)[:-1], draw.random(size), side="right"), minlength=len(points))
    kept = np.flatnonzero(times)
    new = weights[kept] * times[kept] / (size * chance[kept])
    return points[kept], new * (total / new.sum())


def weighted_kmeans(points: np.ndarray, weights: np.ndarray, k: int, seed: int = 0, rounds: int = 100, starts: int = 8) -> np.ndarray:
    """Centres of the best of several runs of Lloyd's algorithm from spread starts, in order of their coordinates."""
    best: tuple[float, np.ndarray] | None = None
    k = min(k, len(points))
    for start in range(starts):
        draw = np.random.default_rng([seed, k, start])
        centres = points[[draw.choice(len(points), p=weights / weights.sum())]]
        while len(centres) < k:
            far = weights * _squared(points, centres).min(1)
            centres = np.vstack([centres, points[draw.choice(len(points), p=far / far.sum())]])
        for _ in range(rounds):
            nearest = _squared(points, centres).argmin(1)
            sums = np.zeros_like(centres)
            np.add.at(sums, nearest, points * weights[:, None])
            held = np.bincount(nearest, weights, k)
            new = np.where(held[:, None] > 0, sums / np.maximum(held, 1e-300)[:, None], centres)
            if np.allclose(new, centres, rtol=0, atol=1e-12):
                break
            centres = new
        cost = float((weights * _squared(points, centres).min(1)).sum())
        if best is None or cost < best[0] - 1e-12 * abs(best[0]):
            best = (cost, centres)
    return best[1][np.lexsort(best[1].T[::-1])]


def _squared(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.maximum((points * points).sum(1)[:, None] - 2 * points @ centres.T + (centres * centres).sum(1), 0.0)


def _matrix(batch: pa.RecordBatch, name: str = "point") -> np.ndarray:
    column = batch.column(name)
    return column.flatten().to_numpy().reshape(len(column), -1)


def _points(df: DataFrame, point: Column) -> DataFrame:
    rows = df.select(point.cast("array<double>").alias("point"))
    finite = F.forall("point", lambda x: x.isNotNull() & (F.abs(x) < F.lit(math.inf)))
    return rows.filter(F.coalesce((F.size("point") > 0) & finite, F.lit(False)))


def coreset(points: DataFrame, size: int = 2_000, seed: int = 0, fan_in: int = 32) -> tuple[np.ndarray, np.ndarray]:
    """Points and weights of one coreset of the column ``point``; at most ``size`` rows reach the driver."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks: dict[int, tuple[np.ndarray, np.ndarray]] = {}

        def add(block: tuple[np.ndarray, np.ndarray], rank: int = 0) -> None:
            while rank in ranks:
                other = ranks.pop(rank)
                block = reduced(np.vstack([other[0], block[0]]), np.concatenate([other[1], block[1]]), size, seed)
                rank += 1
            ranks[rank] = block

        for batch in batches:
            if not len(batch):
                continue
            values = _matrix(batch)
            weights = batch.column("weight").to_numpy() if "weight" in batch.schema.names else np.ones(len(values))
            for a in range(0, len(values), 4 * size):
                add(reduced(values[a : a + 4 * size], weights[a : a + 4 * size], size, seed))
        if ranks:
            blocks = list(ranks.values())
            found, weights = reduced(np.vstack([b[0] for b in blocks]), np.concatenate([b[1] for b in blocks]), size, seed)
            yield pa.RecordBatch.from_arrays([pa.array(weights), pa.array(found.tolist(), pa.list_(pa.float64()))], names=["weight", "point"])

    left = written(points.mapInArrow(part, _SCHEMA).withColumn("part", F.spark_partition_id()), "coreset")
    parts = (left.agg(F.max("part")).first()[0] or 0) + 1
    while parts > 1:
        parts = math.ceil(parts / fan_in)
        merged = left.withColumn("part", F.floor(F.col("part") / fan_in).cast("int")).repartition(parts, "part").sortWithinPartitions("part", "point")
        left = written(merged.select("weight", "point").mapInArrow(part, _SCHEMA).withColumn("part", F.spark_partition_id()), "coreset")
    rows = left.select("weight", "point").toArrow().combine_chunks()
    if not len(rows):
        return np.empty((0, 0)), np.empty(0)
    values = rows["point"].combine_chunks().flatten().to_numpy().reshape(len(rows), -1)
    return reduced(values, rows["weight"].to_numpy(), size, seed)


def sweep_on_coreset(df: DataFrame, ks: Sequence[int], point: Column, size: int = 2_000, seed: int = 0) -> tuple[DataFrame, dict[int, np.ndarray]]:
    """``(k, silhouette, cost)`` over all points, and the centres found, per ``k``."""
    spark = df.sparkSession
    points = _points(df, point)
    values, weights = coreset(points, size, seed)
    if not len(values):
        return spark.createDataFrame([], "k int, silhouette double, cost double"), {}
    held = spark.sparkContext.broadcast((values, weights))

    def fit(group: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in group:
            yield pd.DataFrame([(k, c.tolist()) for k in frame["k"].tolist() for c in weighted_kmeans(*held.value, k, seed)], columns=["k", "centre"])

    asked = spark.createDataFrame([(int(k),) for k in dict.fromkeys(ks)], "k int").repartition(len(set(ks)), "k")
    centres: dict[int, list] = {}
    for r in asked.mapInPandas(fit, "k int, centre array<double>").collect():  # sum of the ks rows
        centres.setdefault(r["k"], []).append(r["centre"])
    found = {k: np.array(v) for k, v in sorted(centres.items())}
    sums = _cluster_sums(points, found)
    scores = [(k, s, float(sums[k][3].sum())) for k, s in _silhouettes(points, found, sums).items()]
    return spark.createDataFrame(scores, "k int, silhouette double, cost double"), found


def _cluster_sums(points: DataFrame, centres: dict[int, np.ndarray]) -> dict[int, tuple[np.ndarray, ...]]:
    """Per ``k``: counts, coordinate sums, sums of squared norms and of squared distances of the clusters."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {k: np.zeros((len(c), c.shape[1] + 3)) for k, c in centres.items()}
        for batch in batches:
            if not len(batch):
                continue
            values = _matrix(batch)
            norms = (values * values).sum(1)
            for k, c in centres.items():
                far = _squared(values, c)
                own = far.argmin(1)
                np.add.at(sums[k], own, np.column_stack([np.ones(len(values)), values, norms, far[np.arange(len(own)), own]]))
        rows = [(k, i, row.tolist()) for k, s in sums.items() for i, row in enumerate(s) if row[0]]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), (pa.int32(), pa.int32(), pa.list_(pa.float64())))], names=["k", "cluster", "sums"])

    parts = points.mapInArrow(part, "k int, cluster int, sums array<double>").select("k", "cluster", F.posexplode("sums").alias("at", "value"))
    out = {k: np.zeros((len(c), c.shape[1] + 3)) for k, c in centres.items()}
    for r in parts.groupBy("k", "cluster", "at").agg(F.sum("value").alias("value")).collect():  # a few numbers per cluster and coordinate
        out[r["k"]][r["cluster"], r["at"]] = r["value"]
    return {k: (s[:, 0], s[:, 1:-2], s[:, -2], s[:, -1]) for k, s in out.items()}


def _silhouettes(points: DataFrame, centres: dict[int, np.ndarray], sums: dict[int, tuple[np.ndarray, ...]]) -> dict[int, float]:
    """Mean silhouette with squared Euclidean distances per ``k``; a point alone in its cluster counts 0, as does every point if there is one cluster."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = dict.fromkeys(centres, 0.0), 0
        for batch in batches:
            if not len(batch):
                continue
            values = _matrix(batch)
            norms, n = (values * values).sum(1), n + len(values)
            for k, c in centres.items():
                counts, coordinates, squares, _ = sums[k]
                own, real = _squared(values, c).argmin(1), counts > 0
                if real.sum() < 2:
                    continue
                size = np.where(real, counts, 1.0)
                mean = np.maximum(norms[:, None] + squares / size - 2 * values @ (coordinates / size[:, None]).T, 0.0)
                mean[:, ~real] = np.inf
                rows = np.arange(len(own))
                alone = counts[own] <= 1
                inside = mean[rows, own] * counts[own] / np.maximum(counts[own] - 1, 1)
                mean[rows, own] = np.inf
                outside = mean.min(1)
                total[k] += float(np.where(alone, 0.0, (outside - inside) / np.maximum(np.maximum(outside, inside), 1e-300)).sum())
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array(list(total.values())), pa.array([n] * len(total))], names=["k", "total", "n"])

    rows = points.mapInArrow(part, "k int, total double, n long").groupBy("k").agg((F.sum("total") / F.sum("n")).alias("score")).collect()
    return {r["k"]: r["score"] for r in sorted(rows)}
