"""Audit of fitted trees: was every split the best one that the rows of its node allowed?

A fitted tree is a table of at most ``2 ** depth`` nodes.  Each row finds its
node level by level with look-ups in that table, and partitions add up one
histogram per (node, feature, bin) and statistic, so a few passes over the rows
(up to three for the bins, one for the histograms) audit all nodes of all depths at
once.  From the histograms follow the gain of every candidate split of every
node, the gain of the split the tree has, and the shortfall between the two.

Bins end at the distinct values of a feature if these are at most ``max_bins``,
which makes the audit exact for such features, and otherwise at approximate
quantiles and the tree's own thresholds.

Impurities are ``gini`` and ``entropy`` of a class label 0, 1, ... and
``variance`` of a number.  Rows with a null label or a null, NaN or infinite
feature take no part.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F


@dataclass(frozen=True)
class Node:
    """A node of a fitted tree, numbered as in a heap (children ``2i + 1`` and ``2i + 2``); a leaf has feature -1."""

    number: int
    feature: int
    threshold: float
    prediction: float


def tree_nodes(model) -> list[Node]:
    """Nodes of one fitted tree with continuous features, by number."""
    found = []

    def walk(node, number: int) -> None:
        if node.subtreeDepth() == 0:
            found.append(Node(number, -1, 0.0, float(node.prediction())))
            return
        split = node.split()
        found.append(Node(number, int(split.featureIndex()), float(split.threshold()), float(node.prediction())))
        walk(node.leftChild(), 2 * number + 1)
        walk(node.rightChild(), 2 * number + 2)

    walk(model._java_obj.rootNode(), 0)
    return sorted(found, key=lambda n: n.number)


def _usable(df: DataFrame, features: Sequence[str], label: Column) -> DataFrame:
    rows = df.select(*[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(features)], label.cast("double").alias("y"))
    for c in rows.columns:
        rows = rows.filter(F.abs(c) < F.lit(float("inf")))
    return rows


def bin_ends(rows: DataFrame, n_features: int, nodes: Sequence[Node], max_bins: int) -> list[np.ndarray]:
    """Sorted last values of the bins of each feature, the last one open; quantiles are taken of features with many values alone."""
    values = [F.slice(F.sort_array(F.collect_set(F.when(F.col("r") == i, F.col("v")))), 1, max_bins + 1).alias(f"s{i}") for i in range(n_features)]
    few = rows.agg(*[F.approx_count_distinct(f"x{i}", 0.02).alias(f"n{i}") for i in range(n_features)]).first()
    short = [i for i in range(n_features) if few[f"n{i}"] <= 1.2 * max_bins]
    exact: dict[int, list[float]] = {}
    if short:
        long = rows.select(F.explode(F.array(*[F.struct(F.lit(i).alias("r"), F.col(f"x{i}").alias("v")) for i in short])).alias("e")).select("e.*")
        found = long.distinct().agg(*[values[i] for i in short]).first()  # about max_bins values of each of these features
        exact = {i: list(found[f"s{i}"]) for i in short if len(found[f"s{i}"]) <= max_bins}
    many = [i for i in range(n_features) if i not in exact]
    quantiles = rows.agg(*[F.percentile_approx(f"x{i}", [j / max_bins for j in range(1, max_bins)], 10_000).alias(f"q{i}") for i in many]).first() if many else None
    ends = []
    for i in range(n_features):
        own = [n.threshold for n in nodes if n.feature == i]
        ends.append(np.array(exact[i][:-1] if i in exact else sorted({*(quantiles[f"q{i}"] or ()), *own}), "f8"))
    return ends


def _impurity(stats: np.ndarray, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """Rows and impurity from statistics in the last axis: counts per class, or count, sum and sum of squares."""
    if kind == "variance":
        n = stats[..., 0]
        mean = stats[..., 1] / np.maximum(n, 1)
        return n, np.maximum(stats[..., 2] / np.maximum(n, 1) - mean * mean, 0.0)
    n = stats.sum(-1)
    share = stats / np.maximum(n, 1)[..., None]
    if kind == "gini":
        return n, 1 - (share * share).sum(-1)
    return n, -(share * np.log2(np.where(share > 0, share, 1.0))).sum(-1)


def node_histograms(rows: DataFrame, nodes: Sequence[Node], ends: list[np.ndarray], n_stats: int, kind: str, shift: float) -> np.ndarray:
    """Statistics per (node, feature, bin), from one pass; only these numbers reach the driver."""
    place = {n.number: i for i, n in enumerate(nodes)}
    feature, threshold = np.array([n.feature for n in nodes]), np.array([n.threshold for n in nodes])
    child = np.array([[place.get(2 * n.number + s, -1) if n.feature >= 0 else -1 for s in (1, 2)] for n in nodes])
    width = max(len(e) for e in ends) + 1
    shape = (len(nodes), len(ends), width, n_stats)

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(int(np.prod(shape)))
        for batch in batches:
            if not len(batch):
                continue
            x = np.column_stack([batch.column(i).to_numpy() for i in range(len(ends))])
            y = batch.column("y").to_numpy() - shift
            bins = np.column_stack([np.searchsorted(e, x[:, i], side="left") for i, e in enumerate(ends)])
            node, live = np.zeros(len(y), "i8"), np.arange(len(y))
            while len(live):
                cell = ((node[live, None] * shape[1] + np.arange(shape[1])) * width + bins[live]) * n_stats
                if kind == "variance":
                    for s, weight in enumerate((np.ones(len(live)), y[live], y[live] ** 2)):
                        sums += np.bincount((cell + s).ravel(), np.repeat(weight, shape[1]), len(sums))
                else:
                    sums += np.bincount((cell + y[live, None].astype("i8")).ravel(), minlength=len(sums))
                live = live[feature[node[live]] >= 0]
                at = node[live]
                node[live] = child[at, (x[live, feature[at]] > threshold[at]).astype("i8")]
        kept = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(kept), pa.array(sums[kept])], names=["cell", "value"])

    out = np.zeros(int(np.prod(shape)))
    for r in rows.mapInArrow(part, "cell long, value double").groupBy("cell").agg(F.sum("value").alias("value")).collect():
        out[r["cell"]] = r["value"]
    return out.reshape(shape)


def audit_tree(model, df: DataFrame, features: Sequence[str], label: str | Column, kind: str = "gini", n_classes: int = 2, max_bins: int = 64) -> list[dict]:
    """Per inner node: its split, rows and gain, and the best split of its rows with its gain; ``shortfall`` is the difference."""
    nodes = tree_nodes(model)
    rows = _usable(df, features, F.col(label) if isinstance(label, str) else label)
    ends = bin_ends(rows, len(features), nodes, max_bins)
    shift = (rows.agg(F.avg("y")).first()[0] or 0.0) if kind == "variance" else 0.0
    sums = node_histograms(rows, nodes, ends, 3 if kind == "variance" else n_classes, kind, shift)
    out = []
    for at, node in enumerate(nodes):
        if node.feature < 0:
            continue
        left = np.cumsum(sums[at], axis=1)  # feature, bin, statistic
        whole = left[:, -1:]
        n, impurity = _impurity(whole, kind)
        (nl, il), (nr, ir) = _impurity(left, kind), _impurity(whole - left, kind)
        gain = np.where((nl > 0) & (nr > 0), impurity - (nl * il + nr * ir) / np.maximum(n, 1), -np.inf)
        for i, e in enumerate(ends):
            gain[i, len(e):] = -np.inf
        own = int(np.searchsorted(ends[node.feature], node.threshold, side="right")) - 1
        best = np.unravel_index(int(gain.argmax()), gain.shape)
        gained = float(gain[node.feature, own])
        out.append({
            "node": node.number, "depth": (node.number + 1).bit_length() - 1, "n": int(n[0, 0]), "feature": features[node.feature], "threshold": node.threshold, "gain": gained,
            "best_feature": features[best[0]], "best_end": float(ends[best[0]][best[1]]), "best_gain": float(gain.max()), "shortfall": float(gain.max()) - gained,
        })
    return out


def audit_frame(spark: SparkSession, audits: dict[str, list[dict]]) -> DataFrame:
    """Audits of several trees as one table with the column ``model``."""
    schema = "model string, node int, depth int, n long, feature string, threshold double, gain double, best_feature string, best_end double, best_gain double, shortfall double"
    return spark.createDataFrame([(name, *row.values()) for name, rows in audits.items() for row in rows], schema)


def boosted_residual(model, upto: int, features: Sequence[str], label: str) -> Column:
    """What tree ``upto`` of a boosted regressor with squared loss was fitted to, as an expression on the rows."""
    target = F.col(label)
    for tree, weight in list(zip(model.trees, model.treeWeights))[:upto]:
        nodes = {n.number: n for n in tree_nodes(tree)}

        def value(number: int) -> Column:
            node = nodes[number]
            if node.feature < 0:
                return F.lit(node.prediction)
            return F.when(F.col(features[node.feature]) <= node.threshold, value(2 * number + 1)).otherwise(value(2 * number + 2))

        target = target - value(0) * float(weight)
    return target * 2.0 if upto else target
