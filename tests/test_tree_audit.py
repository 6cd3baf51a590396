"""Audits of fitted trees against plain NumPy, and audits that must find fault."""

import numpy as np
import pytest

from larkspur.plans import features as G, models as M
from larkspur.plans.tree_audit import Node, audit_frame, audit_tree, boosted_residual, tree_nodes

NAMES = ["a", "b", "c"]


def table(spark, n=3_000, seed=6):
    draw = np.random.default_rng(seed)
    x = np.column_stack([draw.integers(0, 20, n), draw.integers(0, 5, n), draw.normal(size=n)]).astype(float)
    kind = (x[:, 0] + 3 * x[:, 1] > 16).astype(int) + (x[:, 2] > 0.7)
    y = x[:, 0] * 2 - x[:, 1] ** 2 + draw.normal(size=n)
    rows = [(*map(float, r), float(k), float(t)) for r, k, t in zip(x, kind, y)]
    return G.assembler(NAMES).transform(spark.createDataFrame(rows, "a double, b double, c double, kind double, y double")), x, kind, y


def plain_gain(x, y, kind, feature, threshold, n_classes=3):
    def impurity(v):
        if kind == "variance":
            return v.var()
        share = np.bincount(v, minlength=n_classes) / len(v)
        return 1 - (share**2).sum() if kind == "gini" else -(share[share > 0] * np.log2(share[share > 0])).sum()

    left = x[:, feature] <= threshold
    if not left.any() or left.all():
        return -np.inf
    return impurity(y) - left.mean() * impurity(y[left]) - (~left).mean() * impurity(y[~left])


@pytest.mark.parametrize("kind", ["gini", "entropy"])
def test_gains_equal_numpy(spark, kind):
    df, x, label, _ = table(spark)
    model = M.decision_tree("kind", impurity=kind, depth=4).setMaxBins(64).fit(df)
    nodes = {n.number: n for n in tree_nodes(model)}
    rows = {0: np.arange(len(x))}
    for number in sorted(nodes):
        node = nodes[number]
        if node.feature >= 0:
            left = x[rows[number], node.feature] <= node.threshold
            rows[2 * number + 1], rows[2 * number + 2] = rows[number][left], rows[number][~left]
    audit = audit_tree(model, df, NAMES, "kind", kind, 3)
    assert {a["node"] for a in audit} == {n for n in nodes if nodes[n].feature >= 0}
    for a in audit:
        mine = rows[a["node"]]
        assert a["n"] == len(mine) and a["depth"] == int(np.log2(a["node"] + 1))
        assert a["gain"] == pytest.approx(plain_gain(x[mine], label[mine], kind, NAMES.index(a["feature"]), a["threshold"]), abs=1e-9)
        for f in (0, 1):  # features with few values: the best of all splits is known
            best = max(plain_gain(x[mine], label[mine], kind, f, t) for t in np.unique(x[mine, f]))
            assert a["best_gain"] >= best - 1e-9
        assert a["shortfall"] >= -1e-12


def test_boosted_trees(spark):
    df, x, _, y = table(spark)
    model = M.boosted_regressor("y", rounds=3, depth=3).setMaxBins(64).fit(df.select("features", "a", "b", "c", "y"))
    far = y.copy()
    for i in range(3):
        audit = audit_tree(model.trees[i], df, NAMES, boosted_residual(model, i, NAMES, "y"), "variance")
        assert len(audit) == 7 and audit[0]["n"] == len(y)
        root = audit[0]
        assert root["gain"] == pytest.approx(plain_gain(x, far, "variance", NAMES.index(root["feature"]), root["threshold"]), rel=1e-6)
        leaf = np.array([r[0] for r in model.trees[i].transform(df).select("prediction").collect()])
        y = y - leaf * model.treeWeights[i]
        far = 2 * y


class Fake:
    """A stump on the wrong feature."""

    def __init__(self, real):
        self._java_obj = real._java_obj


def test_a_bad_split_has_a_shortfall(spark):
    df, x, label, _ = table(spark)
    other = df.withColumn("kind", (df["c"] > 0).cast("double"))
    stump = M.decision_tree("kind", depth=1).fit(other)  # fitted to another label
    found = audit_tree(Fake(stump), df, NAMES, "kind", "gini", 3)
    assert len(found) == 1 and found[0]["feature"] == "c" and found[0]["best_feature"] != "c" and found[0]["shortfall"] > 0.05
    table_ = audit_frame(spark, {"stump": found}).first()
    assert table_["model"] == "stump" and table_["shortfall"] == pytest.approx(found[0]["shortfall"])


def test_odd_rows(spark):
    df, *_ = table(spark, 200)
    model = M.decision_tree("kind", depth=2).fit(df)
    more = df.select(*NAMES, "kind").union(spark.createDataFrame([(None, 1.0, 1.0, 1.0), (1.0, float("nan"), 1.0, 1.0), (1.0, 1.0, 1.0, None)], "a double, b double, c double, kind double"))
    assert audit_tree(model, more, NAMES, "kind", "gini", 3) == audit_tree(model, df, NAMES, "kind", "gini", 3)
    leaf = M.decision_tree("kind", depth=2).fit(df.filter("kind = 0"))
    assert tree_nodes(leaf) == [Node(0, -1, 0.0, 0.0)] and audit_tree(leaf, df, NAMES, "kind", "gini", 3) == []


def test_no_quantiles_of_few_values(spark, monkeypatch):
    from larkspur.plans import tree_audit as module

    monkeypatch.setattr(module.F, "percentile_approx", lambda *a: 1 / 0)
    rows = spark.createDataFrame([(float(i % 5), float(i % 9)) for i in range(90)], "x0 double, x1 double")
    assert [list(e) for e in module.bin_ends(rows, 2, [], 16)] == [[0.0, 1.0, 2.0, 3.0], [float(i) for i in range(8)]]
