"""Hard negatives against brute force, with thresholds that must be lowered, ties, hot vectors and odd rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from larkspur.llm.negatives import hard_negatives, threshold_join

SCHEMA = "vec_id long, embedding array<float>, label int, w long, id string"


@pytest.mark.parametrize("low", [-50, 0, 30, 70, 120, 10_000])
def test_threshold_join(low):
    draw = np.random.default_rng(low + 100)
    anchors, rows = np.floor(draw.normal(0, 4, (30, 19))), np.floor(draw.normal(0, 4, (400, 19)))
    rows[5], anchors[3] = 0, 0
    lows = np.full(30, float(low)) + draw.integers(0, 20, 30)
    i, j, scores = threshold_join(anchors, lows, rows, step=4)
    full = anchors @ rows.T
    assert sorted(zip(i.tolist(), j.tolist())) == [tuple(x) for x in np.argwhere(full >= lows[:, None]).tolist()]
    assert (scores == full[i, j]).all()


def test_scores_beyond_exact_numbers_are_refused():
    huge = np.full((2, 4), 2.0**27)
    with pytest.raises(ValueError, match="exact"):
        threshold_join(huge, np.zeros(2), huge)


def expected(rows, k=5, low=80):
    usable = {}
    for vec_id, vector, label, *_ in rows:
        if vec_id is None or label is None or vector is None or any(v is None or not np.isfinite(v) for v in vector) or len(vector) != 8:
            continue
        key = (str(label), [int(np.floor(256 * float(np.float32(v)))) for v in vector])
        usable[vec_id] = min(usable.get(vec_id, key), key)
    out = set()
    for a, (label, x) in usable.items():
        if a % 10:
            continue
        scored = sorted((-sum(p * q for p, q in zip(x, y)), b, other) for b, (other, y) in usable.items() if b != a)
        for p, b, other in [s for s in scored if s[2] == label][:k]:
            near = [(n, c) for n, c, o in scored if o != label and low * -p <= 100 * -n <= 100 * -p][:k]
            out |= {(a, b, r, c, -p, -n) for r, (n, c) in enumerate(near, 1)}
    return out


def table(n=600, hot=150):
    draw = np.random.default_rng(9)
    points = draw.normal(0, 0.4, (n, 8))
    points[:hot] = points[0] + draw.normal(0, 0.02, (hot, 8))
    points[hot : hot + 60] = points[hot]  # copies and ties
    labels = np.where(draw.random(n) < 0.4, 1, draw.integers(0, 5, n))
    rows = [(i, p.tolist(), int(c), 1, "x") for i, (p, c) in enumerate(zip(points, labels))]
    rows += [(1000, points[3].tolist(), 77, 1, "x"), (1010, [0.0] * 8, 1, 1, "x"), (None, points[4].tolist(), 1, 1, "x"), (1020, None, 1, 1, "x"), (1030, points[5].tolist(), None, 1, "x")]
    rows += [(1040, [None] + [0.1] * 7, 1, 1, "x"), (1050, [float("nan")] + [0.1] * 7, 1, 1, "x"), (1060, [0.1] * 7, 1, 1, "x"), (1070, [], 1, 1, "x"), (1080, [float("inf")] + [0.1] * 7, 1, 1, "x")]
    return rows + [(20, points[50].tolist(), 3, 1, "y"), rows[30], rows[30]]


@pytest.mark.parametrize("sizes", [{}, {"block_rows": 90, "anchor_rows": 20, "sample_rows": 40}, {"block_rows": 200, "sample_rows": 1}])
def test_against_brute_force(spark, sizes):
    rows = table()
    found = hard_negatives(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 10 == 0, F.col("label"), **sizes)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    got = [tuple(r) for r in found.collect()]
    assert len(got) == len(set(got)) and set(got) == expected(rows)
    assert {r[0] for r in got} >= {0, 20, 160}


def test_empty_table(spark):
    assert hard_negatives(spark.createDataFrame([], SCHEMA), F.col("vec_id") % 10 == 0, F.col("label")).count() == 0
