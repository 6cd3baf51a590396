"""Hard negatives by threshold joins over an inverted index whose entries are cut by suffix norms.

Vectors become whole numbers (``floor(scale * x)``), so scores are exact.  Rows
are dealt to blocks by a hash of their id and packed; anchors travel in blocks
of their own to every block of rows, and a task joins one block with another.

Inside a task the dimensions are ordered by the weight the anchors give them.
With ``t`` the smallest ratio of a threshold to its anchor's length, the first
dimensions of a row stay out of the index as long as their norm is below
``t``: alone they cannot lift a score over a threshold.  Scores are accumulated
over the indexed dimensions, heaviest first; after every few of them a pair is
dropped if its partial score plus the product of the two remaining norms is
below the anchor's threshold.  The rest is verified by the full product.

A window asks for the best ``k`` rows with a score between a floor and a
ceiling.  A bounded sample of rows shows how low its threshold must go: it
begins at a score that about twice ``k`` rows of the whole table should reach,
is lowered to the ``k``-th best of the sample (which ``k`` rows are sure to
reach), and at last to the floor, each time only for windows that are not yet
full.  A full window, or one searched down to its floor, is exact; the sample
decides the work and not the result.  Blocks give at most ``k`` rows a window.

Positives of an anchor are one window over the rows of its label, and the
negatives of a positive one over the rows of other labels with
``low_percent * positive <= 100 * score <= 100 * positive``.

Defined cases: rows with a null id, a null label, a null or empty vector, or a
null, NaN or infinite component, and vectors of another length than the most
frequent one take no part; vectors of zeros do; of several rows with one id the
smallest (label, vector) counts; ties go to the smaller id; a positive with a
negative score has no negatives; fewer rows than asked for give fewer; an empty
table gives no rows; other columns are ignored.  Lengths whose product could
pass 2**53 stop the job with an error, as scores would not be exact.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from larkspur.llm.common import staged

_NONE = -(1 << 62)  # a threshold that every score reaches
_WINDOW = "w long, high long, floor long, low long"
_FOUND = "anchor long, w long, id long, score long"
_ANCHORS_AT_ONCE = 128  # rows of a block of partial scores


def threshold_join(anchors: np.ndarray, lows: np.ndarray, rows: np.ndarray, step: int = 8) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs ``(anchor, row)`` with a product of at least the anchor's threshold, and the product; whole numbers held as float64."""
    order = np.argsort((anchors * anchors).sum(0), kind="stable")
    q, y = anchors[:, order], rows[:, order]
    ahead = lambda m: np.sqrt(np.concatenate([np.zeros((len(m), 1)), np.cumsum(m * m, axis=1)], axis=1))
    q_norms, y_norms = ahead(q), ahead(y)  # column e: norm of the first e dimensions
    lengths = q_norms[:, -1]
    if lengths.max(initial=0) * y_norms[:, -1].max(initial=0) >= 2**53:
        raise ValueError("scores of these vectors can pass 2**53 and would not be exact")
    slack = 1 + 1e-12  # norms are rounded
    least = float(np.min(np.where(lows > 0, lows / np.maximum(lengths, 1e-300), 0.0), initial=math.inf)) / slack
    omitted = (y_norms[:, 1:] < least).sum(1)  # leading dimensions of each row that stay out of the index
    live = np.flatnonzero(omitted < y.shape[1]) if least > 0 else np.arange(len(y))
    index = np.where(np.arange(y.shape[1]) >= omitted[:, None], y, 0.0)
    partial = np.zeros((len(q), len(y)))
    alive = np.zeros((len(q), len(y)), bool)
    alive[:, live] = True
    for start in reversed(range(0, y.shape[1], step)):
        live = live[alive[:, live].any(axis=0)]
        if not len(live):
            break
        partial[:, live] += q[:, start : start + step] @ index[live, start : start + step].T
        rest = np.maximum(omitted[live], start)  # dimensions of the row that are not in the sum
        bound = partial[:, live] + q_norms[:, rest] * (y_norms[live, rest] * slack)
        alive[:, live] &= bound >= lows[:, None]
    i, j = np.nonzero(alive)
    scores = np.concatenate([(anchors[i[a : a + 65_536]] * rows[j[a : a + 65_536]]).sum(1) for a in range(0, max(len(i), 1), 65_536)])
    sure = scores >= lows[i]
    return i[sure], j[sure], scores[sure]


def _join_blocks(k: int, same: bool):
    def join(asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[int, int, int, int]] = []
        if len(asked) and len(held):
            ids = np.frombuffer(held["ids"].iloc[0], "<i8")
            rows = np.frombuffer(held["vectors"].iloc[0], "<f8").reshape(len(ids), -1)
            labels = np.asarray(held["labels"].iloc[0], object)
            for at in range(0, len(asked), _ANCHORS_AT_ONCE):
                part = asked.iloc[at : at + _ANCHORS_AT_ONCE]
                vectors = np.stack(part["x"].to_numpy()).astype("f8")
                lows = np.array([min(w["low"] for w in ws) for ws in part["windows"]], "f8")
                i, j, scores = threshold_join(vectors, lows, rows)
                scores = scores.astype("i8")
                ends = np.searchsorted(i, np.arange(len(part) + 1))
                for n, (anchor, label, windows) in enumerate(zip(part["anchor"].tolist(), part["label"], part["windows"])):
                    mine = slice(ends[n], ends[n + 1])
                    fits = ((labels[j[mine]] == label) == same) & (ids[j[mine]] != anchor)
                    best, others = scores[mine][fits], ids[j[mine]][fits]
                    order = np.lexsort((others, -best))
                    best, others = best[order], others[order]
                    for w in windows:
                        inside = np.flatnonzero((best <= w["high"]) & (best >= w["low"]))[:k]
                        out += [(anchor, w["w"], x, s) for x, s in zip(others[inside].tolist(), best[inside].tolist())]
        return pd.DataFrame(out, columns=["anchor", "w", "id", "score"])

    return join


def _searched(windows: DataFrame, blocks: DataFrame, n_blocks: int, anchor_rows: int, n_anchors: int, k: int, same: bool) -> DataFrame:
    """The best ``k`` rows of each window down to its ``low``."""
    parts = max(1, math.ceil(n_anchors / anchor_rows))
    asked = windows.groupBy("anchor").agg(F.first("label").alias("label"), F.first("x").alias("x"), F.collect_list(F.struct("w", "high", "floor", "low")).alias("windows"))
    asked = asked.withColumns({"part": F.pmod(F.xxhash64("anchor"), F.lit(parts)).cast("int"), "block": F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)))})
    held = blocks.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    key, tasks = ["block", "part"], min(n_blocks * parts, 100_000)
    found = asked.repartition(tasks, *key).groupBy(*key).cogroup(held.repartition(tasks, *key).groupBy(*key)).applyInPandas(_join_blocks(k, same), _FOUND)
    rank = F.row_number().over(Window.partitionBy("anchor", "w").orderBy(F.desc("score"), "id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k)


def _filled(windows: DataFrame, blocks: DataFrame, sample: DataFrame, n_blocks: int, share: float, anchor_rows: int, n_anchors: int, k: int, same: bool) -> DataFrame:
    """The best ``k`` rows of each window ``(anchor, label, x, w, high, floor)``, thresholds lowered until it is full or at its floor."""
    search = lambda asked, where, n: staged(_searched(asked, where, n, anchor_rows, n_anchors, k, same), "windows")
    seen = search(windows.withColumn("low", F.col("floor")), sample, 1)
    scores = seen.groupBy("anchor", "w").agg(F.sort_array(F.collect_list("score"), False).alias("scores"))
    begin = min(k, max(1, math.ceil(2 * k * share)))  # the sample's place that about 2 k rows of the table reach
    levels = F.array_distinct(F.filter(F.array(F.get("scores", F.lit(begin - 1)), F.get("scores", F.lit(k - 1)), F.col("floor")), lambda x: x.isNotNull()))
    pending = staged(windows.join(scores, ["anchor", "w"], "left").withColumn("levels", levels).drop("scores"), "thresholds")
    full, step = [], 0
    while True:
        last = F.size("levels") - 1
        asked = pending.withColumn("low", F.get("levels", F.least(F.lit(step), last)))
        found = search(asked.drop("levels"), blocks, n_blocks)
        counts = found.groupBy("anchor", "w").agg(F.count("*").alias("n"))
        judged = asked.join(counts, ["anchor", "w"], "left").withColumn("done", (F.coalesce("n", F.lit(0)) >= k) | (F.col("low") <= F.col("floor")))
        full.append(found.join(judged.filter("done").select("anchor", "w"), ["anchor", "w"], "left_semi"))
        pending = staged(judged.filter("not done").drop("n", "done", "low"), "thresholds")
        step += 1
        if pending.isEmpty():
            break
    out = full[0]
    for more in full[1:]:
        out = out.unionByName(more)
    return out


def hard_negatives(
    df: DataFrame, is_anchor: Column, label: Column, scale: float = 256.0, k: int = 5, low_percent: int = 80, id_column: str = "vec_id", vector_column: str = "embedding",
    block_rows: int = 8_192, anchor_rows: int = 8_192, sample_rows: int = 4_096,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``is_anchor`` and ``label`` are expressions on the columns of ``df``; the anchor's own row is never an answer.
    """
    x = F.col(vector_column).cast("array<double>")
    rows = df.select(F.col(id_column).cast("long").alias("id"), label.cast("string").alias("label"), x.alias("x"), F.coalesce(is_anchor, F.lit(False)).alias("is_anchor"))
    finite = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(math.inf)))
    rows = rows.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & F.coalesce((F.size("x") > 0) & finite, F.lit(False)))
    sizes = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), "d").first()
    length, n = (sizes["d"], sizes["count"]) if sizes else (0, 0)
    whole = rows.filter(F.size("x") == length).withColumn("x", F.transform("x", lambda v: F.floor(F.lit(float(scale)) * v)))
    whole = staged(whole.groupBy("id").agg(F.min(F.struct("label", "x", "is_anchor")).alias("row")).select("id", "row.*"), "rows")  # copies go before the shuffle
    n_blocks = max(1, math.ceil(n / block_rows))
    share = min(1.0, sample_rows / max(n, 1))

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        vectors = np.stack(group["x"].to_numpy()).astype("<f8")
        return pd.DataFrame({"block": [group["block"].iloc[0]], "ids": [group["id"].to_numpy("<i8").tobytes()], "labels": [group["label"].tolist()], "vectors": [vectors.tobytes()]})

    packed = "block int, ids binary, labels array<string>, vectors binary"
    dealt = whole.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(n_blocks)).cast("int"))
    blocks = staged(dealt.select("block", "id", "label", "x").repartition(min(n_blocks, 100_000), "block").groupBy("block").applyInPandas(pack, packed), "blocks")
    few = F.pmod(F.xxhash64(F.col("id"), F.lit("sample")), F.lit(1 << 20)) < F.lit(int(math.ceil(share * (1 << 20))))
    sample = staged(whole.filter(few).select(F.lit(0).alias("block"), "id", "label", "x").groupBy("block").applyInPandas(pack, packed), "sample")
    anchors = whole.filter("is_anchor").select(F.col("id").alias("anchor"), "label", "x")
    n_anchors = anchors.count()

    fill = lambda windows, same: _filled(windows, blocks, sample, n_blocks, share, anchor_rows, n_anchors, k, same)
    every = anchors.withColumns({"w": F.lit(-1).cast("long"), "high": F.lit(-_NONE), "floor": F.lit(_NONE)})
    positives = staged(fill(every, True).select("anchor", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    floor = F.expr(f"(({low_percent} * high + 99) div 100)")
    asked = positives.filter("positive_score >= 0").select("anchor", F.col("positive_id").alias("w"), F.col("positive_score").alias("high")).withColumn("floor", floor)
    negatives = fill(asked.join(anchors, "anchor"), False)
    return negatives.join(positives.withColumnRenamed("positive_id", "w"), ["anchor", "w"]).select(
        F.col("anchor").alias("anchor_id"), F.col("w").alias("positive_id"), "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
