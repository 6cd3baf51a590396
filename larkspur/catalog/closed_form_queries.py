"""Fitted models whose answers have a closed form on simple columns, so that SQL can state them."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from larkspur.catalog.registry import query, r6
from larkspur.functions import text as T
from larkspur.operators import sampling as X
from larkspur.plans import certificates as C, features as G, gram as S, models as M, tree_audit as A
from larkspur.sources.readers import table

_SETUP = """SELECT l_orderkey, l_linenumber, (l_quantity > 25)::int::double AS x, l_extendedprice AS price, (l_quantity + 5 * l_linenumber > 35)::int::double AS y,
   CASE WHEN l_quantity + 5 * l_linenumber < 35 THEN 'A' WHEN l_quantity + 5 * l_linenumber < 45 THEN 'N' ELSE 'R' END AS flag FROM lineitem"""


def _setup(spark, sf):
    """One 0/1 column ``x``, a class ``flag``, a 0/1 label ``y`` and a price per order line."""
    mixed = F.col("l_quantity") + 5 * F.col("l_linenumber")
    rows = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", (F.col("l_quantity") > 25).cast("double").alias("x"), F.col("l_extendedprice").alias("price"),
        (mixed > 35).cast("double").alias("y"), F.when(mixed < 35, "A").when(mixed < 45, "N").otherwise("R").alias("flag"),
    )
    return G.assembler(["x"]).transform(rows)


def _tight(model):
    return model.setTol(1e-10).setMaxIter(100)


def _by_x(scored, *cols):
    return scored.groupBy("x").agg(*[F.round(F.avg(c), 4).alias(n) for n, c in cols])


_WEIGHTED = f"""WITH s AS ({_SETUP}), w AS (SELECT *, CASE WHEN y = 1 THEN 1 - avg(y) OVER () ELSE avg(y) OVER () END AS w FROM s),
   p AS (SELECT x, sum(w * y) / sum(w) AS weighted, avg(y) AS plain FROM w GROUP BY 1)"""


@query("M5 M6 G7", f"{_WEIGHTED} SELECT x, round(plain, 4) AS plain, round(weighted, 4) AS weighted FROM p")
def logistic_odds(spark, sf):
    """With one 0/1 column the fitted probabilities are the shares per value, weighted or not."""
    rows = G.with_class_weights(_setup(spark, sf).select("x", "features", "y"), "y", 1.0)
    one = lambda c: F.get(vector_to_array(c), F.lit(1))
    with M.held(rows) as kept:
        plain = _tight(M.logistic("y")).setProbabilityCol("p").fit(kept).transform(kept).drop("rawPrediction", "prediction")
        both = _tight(M.logistic("y", weight="weight")).setProbabilityCol("q").fit(kept).transform(plain)
        out = _by_x(both, ("plain", one("p")), ("weighted", one("q"))).collect()
    return spark.createDataFrame(out, "x double, plain double, weighted double")


@query(
    "M7 M8",
    f"""WITH s AS ({_SETUP}), c AS (SELECT x, flag, count(*)::double AS n FROM s GROUP BY 1, 2), t AS (SELECT x, sum(n) AS total, arg_max(flag, n) AS mode FROM c GROUP BY 1),
            k AS (SELECT x, min(n / total) FILTER (flag = 'A') AS a, min(n / total) FILTER (flag = 'N') AS b, min(n / total) FILTER (flag = 'R') AS r FROM c JOIN t USING (x) GROUP BY 1)
       SELECT x, round(a, 4) AS "A", round(b, 4) AS "N", round(r, 4) AS "R", mode AS one_vs_rest FROM k JOIN t USING (x)""",
)
def class_shares(spark, sf):
    """Three classes on one 0/1 column: multinomial probabilities are the shares; one-vs-rest picks the largest."""
    rows = _setup(spark, sf).select("x", "features", "flag")
    index = G.indexer("flag", "label", alphabetical=True).fit(rows)
    with M.held(index.transform(rows)) as kept:
        soft = _tight(M.logistic("label")).fit(kept).transform(kept)
        shares = _by_x(soft, *[(name, F.get(vector_to_array("probability"), F.lit(i))) for i, name in enumerate(index.labels)])
        rest = M.one_vs_rest(_tight(M.logistic("label")), "label").fit(kept).transform(kept).groupBy("x").agg(F.max("prediction").alias("p"))
        names = F.array(*[F.lit(n) for n in index.labels])
        out = shares.join(rest, "x").withColumn("one_vs_rest", F.get(names, F.col("p").cast("int"))).drop("p").collect()
    return spark.createDataFrame(out, "x double, A double, N double, R double, one_vs_rest string")


@query(
    "M4 M9 M10 M11 M12 M19",
    f"""WITH s AS ({_SETUP}), c AS (SELECT x, flag, count(*) AS n FROM s GROUP BY 1, 2)
       SELECT x, round(avg(price), 4) AS boosted_price, round(avg(y), 4) AS tree_share, round(avg(y), 4) AS forest_share, (avg(y) > 0.5)::int::double AS boosted_class,
              (SELECT arg_max(flag, n) FROM c WHERE c.x = s.x) AS one_vs_rest FROM s GROUP BY x""",
)
def tree_means(spark, sf):
    """One split on a 0/1 column: trees, a forest of one and one round of boosting give the mean, share or majority per value."""
    one = lambda c: F.get(vector_to_array(c), F.lit(1))
    rows = _setup(spark, sf)
    index = G.indexer("flag", "label", alphabetical=True).fit(rows)
    with M.held(index.transform(rows).select("x", "features", "y", "price", "label")) as kept:
        scored = M.boosted_regressor("price", rounds=1, depth=1).setPredictionCol("price_").fit(kept).transform(kept)
        for name, model in (("tree", M.decision_tree("y", depth=1)), ("forest", M.random_forest("y", trees=1, depth=1).setBootstrap(False))):
            model = model.setProbabilityCol(name).setRawPredictionCol(f"{name}_raw").setPredictionCol(f"{name}_class")
            scored = model.fit(kept).transform(scored)
        boosted = M.boosted_classifier("y", rounds=1, depth=1).setProbabilityCol("b").setRawPredictionCol("b_raw").setPredictionCol("b_class")
        scored = boosted.fit(kept).transform(scored)
        rest = M.one_vs_rest(M.boosted_classifier("label", rounds=1, depth=1), "label").setPredictionCol("rest").fit(kept)
        scored = rest.transform(scored)
        names = F.array(*[F.lit(n) for n in index.labels])
        out = _by_x(scored, ("boosted_price", F.col("price_")), ("tree_share", one("tree")), ("forest_share", one("forest")), ("boosted_class", F.col("b_class")), ("r", F.col("rest")))
        found = out.withColumn("one_vs_rest", F.get(names, F.col("r").cast("int"))).drop("r").collect()
    return spark.createDataFrame(found, "x double, boosted_price double, tree_share double, forest_share double, boosted_class double, one_vs_rest string")


_SPLIT_ON = ["quantity", "discount", "tax", "line"]


def _grown(name: str, target: str, kind: str, depth: int = 3) -> str:
    """CTEs that grow a tree greedily: ``name_d`` has the best split per node of depth ``d``, ``name_r`` each row's node below the last one."""
    if kind == "variance":
        stats, imp = "count(*)::double AS n, sum(y) AS s, sum(y * y) AS q", "greatest({q} / {n} - ({s} / {n}) ** 2, 0)"
    else:
        part = "CASE WHEN {x} <= 0 THEN 0 ELSE -({x} / {n}) * log2({x} / {n}) END"
        stats = "count(*)::double AS n, sum(y) AS s, 0.0 AS q"
        imp = f"({part.format(x='({s})', n='({n})')} + {part.format(x='(({n}) - ({s}))', n='({n})')})" if kind == "entropy" else "(2 * (({s}) / ({n})) * (1 - ({s}) / ({n})))"
    out = [f"{name}_r0 AS (SELECT *, ({target})::double AS y, 0 AS node FROM base)"]
    cells = " UNION ALL ".join(f"SELECT node, {i} AS f, {c}::double AS v, y FROM {name}_r{{d}}" for i, c in enumerate(_SPLIT_ON))
    fill = lambda n, s, q: imp.format(n=n, s=s, q=q)
    for d in range(depth):
        out.append(f"{name}_h{d} AS (SELECT node, f, v, {stats} FROM ({cells.format(d=d)}) GROUP BY 1, 2, 3)")
        out.append(
            f"""{name}_c{d} AS (SELECT node, f, v, lead(v) OVER w AS nxt, sum(n) OVER w AS nl, sum(s) OVER w AS sl, sum(q) OVER w AS ql,
                sum(n) OVER a AS n, sum(s) OVER a AS s, sum(q) OVER a AS q FROM {name}_h{d} WINDOW w AS (PARTITION BY node, f ORDER BY v), a AS (PARTITION BY node, f))"""
        )
        gain = f"{fill('n', 's', 'q')} - (nl * {fill('nl', 'sl', 'ql')} + (n - nl) * {fill('(n - nl)', '(s - sl)', '(q - ql)')}) / n"
        out.append(
            f"""{name}_{d} AS (SELECT node, n, f, (v + nxt) / 2 AS threshold, gain FROM (SELECT *, {gain} AS gain FROM {name}_c{d} WHERE nxt IS NOT NULL)
                QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, f, v) = 1)"""
        )
        value = f"CASE f {' '.join(f'WHEN {i} THEN {c}' for i, c in enumerate(_SPLIT_ON))} END"
        out.append(f"{name}_r{d + 1} AS (SELECT r.* REPLACE (2 * r.node + CASE WHEN {value} <= threshold THEN 1 ELSE 2 END AS node) FROM {name}_r{d} r JOIN {name}_{d} USING (node))")
    return ",\n".join(out)


def _grown_rows(name: str, depth: int = 3) -> str:
    """Inner nodes of a grown tree; the library joins leaves again under which every leaf predicts the same class."""
    names = f"[{', '.join(repr(c) for c in _SPLIT_ON)}]"
    guess = f"(SELECT node AS leaf, {'(avg(y) > 0.5)::int' if name in ('tree', 'forest') else 'avg(y)'} AS guess FROM {name}_r{depth} GROUP BY 1)"
    return " UNION ALL ".join(
        f"SELECT '{name}' AS model, node::int AS node, {d} AS depth, n::bigint AS n, {names}[f + 1] AS feature, round(threshold, 6) AS threshold, round(gain, 6) AS gain, true AS best FROM {name}_{d} WHERE (SELECT count(DISTINCT guess) FROM {guess} WHERE ((leaf + 1) >> {depth - d}) - 1 = node) > 1"
        for d in range(depth)
    )


@query(
    "M4 M10 M11 M12 M19",
    f"""WITH base AS (SELECT l_quantity::double AS quantity, l_discount::double AS discount, l_tax::double AS tax, l_linenumber::double AS line,
           (l_quantity * (1 + 3 * l_discount) + 4 * l_linenumber * l_tax * 10 > 38)::int::double AS flag, l_extendedprice / 1000.0 AS price FROM lineitem),
       {_grown("tree", "flag", "entropy")}, {_grown("forest", "flag", "gini")}, {_grown("boosted_0", "price", "variance")},
       leaf AS (SELECT node, avg(y) AS m FROM boosted_0_r3 GROUP BY 1), again AS (SELECT b.*, 2 * (b.y - m) AS target FROM boosted_0_r3 b JOIN leaf USING (node)),
       {_grown("boosted_1", "target", "variance").replace("FROM base)", "FROM (SELECT * EXCLUDE (y, node) FROM again))", 1)}
       {" UNION ALL ".join(_grown_rows(n) for n in ("tree", "forest", "boosted_0", "boosted_1"))}""",
)
def tree_audit(spark, sf):
    """Every split of a tree, a forest's tree and two boosted trees of depth three: rows, gain, and whether no other split gains more."""
    mixed = F.col("quantity") * (1 + 3 * F.col("discount")) + 4 * F.col("line") * F.col("tax") * 10
    rows = table(spark, sf, "lineitem").select(
        F.col("l_quantity").cast("double").alias("quantity"), F.col("l_discount").cast("double").alias("discount"), F.col("l_tax").cast("double").alias("tax"),
        F.col("l_linenumber").cast("double").alias("line"), (F.col("l_extendedprice") / 1000.0).alias("price"),
    ).withColumn("flag", (mixed > 38).cast("double"))
    with M.held(G.assembler(_SPLIT_ON).transform(rows)) as kept:
        tree = M.decision_tree("flag", depth=3).setMaxBins(64).fit(kept)
        forest = M.random_forest("flag", trees=1, depth=3).setMaxBins(64).setBootstrap(False).setFeatureSubsetStrategy("all").fit(kept)
        boosted = M.boosted_regressor("price", rounds=2, depth=3).setMaxBins(64).fit(kept)
        audits = {"tree": A.audit_tree(tree, kept, _SPLIT_ON, "flag", "entropy"), "forest": A.audit_tree(forest.trees[0], kept, _SPLIT_ON, "flag", "gini")}
        for i in range(2):
            audits[f"boosted_{i}"] = A.audit_tree(boosted.trees[i], kept, _SPLIT_ON, A.boosted_residual(boosted, i, _SPLIT_ON, "price"), "variance")
    found = A.audit_frame(spark, audits)
    return found.select("model", "node", "depth", "n", "feature", F.round("threshold", 6).alias("threshold"), r6("gain").alias("gain"), (F.col("shortfall") < 1e-9 * (1 + F.col("gain"))).alias("best"))


@query("M10 M19", f"SELECT count(DISTINCT x)::int AS leaves, (count(DISTINCT x) - 1)::int AS splits FROM ({_SETUP})")
def tree_shape(spark, sf):
    """The rules of a tree of depth one read as a leaf per value and the splits between them."""
    rules = M.tree_text(M.decision_tree("y", depth=1).fit(_setup(spark, sf)), spark)
    return rules.agg(F.count_if(F.col("rule").contains("Predict")).cast("int").alias("leaves"), F.count_if(F.col("rule").startswith("  If ")).cast("int").alias("splits"))


@query("M17 M19", "SELECT DISTINCT (l_quantity > 25)::int::double AS value FROM lineitem")
def two_centres(spark, sf):
    """The centres of two clusters of two values are the values."""
    model = M.kmeans(2).fit(_setup(spark, sf).select("features"))
    return M.cluster_centres(model, spark).select(F.round(F.col("centre")[0], 6).alias("value"))


@query(
    "M17 M18 E9 A25",
    "SELECT 2 AS k, 1.0::double AS silhouette, 0.0::double AS cost, list_sort([count(*) FILTER (l_quantity > 25), count(*) FILTER (NOT l_quantity > 25)]) AS sizes FROM lineitem",
)
def two_clusters(spark, sf):
    """Two values far apart: the sweep finds them without cost, and the clusters have their sizes."""
    points = _setup(spark, sf).select("features")
    scores, best = M.sweep_k(points, [2])
    sizes = best.transform(points).groupBy("prediction").agg(F.count(F.lit(1)).alias("n")).agg(F.sort_array(F.collect_list("n")).alias("sizes"))
    return scores.select("k", F.round("silhouette", 4).alias("silhouette"), F.round("cost", 4).alias("cost")).crossJoin(F.broadcast(sizes))


@query("T6", r"""SELECT doc_id, len(list_filter(string_split_regex(lower(text), '\W+'), lambda t: t <> ''))::double AS tokens FROM documents""")
def hashed_counts(spark, sf):
    """Hashed term counts of a document add up to its tokens, whatever collides."""
    rows = table(spark, sf, "documents").select("doc_id", "text")
    stages = G.tf_idf_stages("text", buckets=1 << 18, words_only=True, keep_stop_words=True, weighted=False)
    counted = Pipeline(stages=stages).fit(rows).transform(rows)
    total = F.aggregate(vector_values("features"), F.lit(0.0), lambda a, x: a + x)
    return counted.select("doc_id", total.alias("tokens"))


def vector_values(col):
    """Stored values of a vector column; a sparse vector stays sparse."""
    return F.unwrap_udt(F.col(col))["values"]


_TOKENS = r"list_filter(string_split_regex(lower(text), '\W+'), lambda t: t <> '')"


@query(
    "T11",
    f"""WITH w AS (SELECT doc_id, unnest({_TOKENS}) AS t FROM documents), v AS (SELECT t FROM w GROUP BY 1 HAVING count(*) >= 5)
       SELECT doc_id, 25 AS size, EXISTS (SELECT 1 FROM w JOIN v USING (t) WHERE w.doc_id = documents.doc_id) AS filled FROM documents""",
)
def word_vector_shape(spark, sf):
    """Averaged word vectors have their size, and are zero just where no word is frequent enough."""
    rows = table(spark, sf, "documents").select("doc_id", T.word_tokens("text").alias("words"))
    model = G.word_vectors("words", "vector", size=25, min_count=5, parts=G.training_parts(rows)).fit(rows)
    vector = vector_to_array("vector")
    return model.transform(rows).select("doc_id", F.size(vector).alias("size"), F.exists(vector, lambda x: x != 0).alias("filled"))


@query(
    "T15 T7",
    f"""WITH w AS (SELECT t, doc_id FROM (SELECT doc_id, unnest({_TOKENS}) AS t FROM documents WHERE ('0x' || left(md5(doc_id::varchar), 8))::bigint % 100 < 80))
       SELECT t AS term FROM w GROUP BY 1 HAVING count(DISTINCT doc_id) >= 20""",
)
def train_vocabulary(spark, sf):
    """A vocabulary fitted on the training part holds the terms of that part alone."""
    train, _ = X.hash_split(table(spark, sf, "documents").select("doc_id", "text"), "doc_id")
    model = Pipeline(stages=G.tf_idf_stages("text", min_df=20.0, words_only=True, keep_stop_words=True, weighted=False)).fit(train)
    return spark.createDataFrame([(t,) for t in model.stages[-1].vocabulary], "term string")


_BEST_LINE = f"""WITH s AS (SELECT x, 2 * y - 1 AS y FROM ({_SETUP})), c AS (SELECT count(*)::double AS n, 0.1 * var_samp(x) AS p,
       -sum(CASE WHEN x = 0 THEN y ELSE 0 END) / count(*) AS g, -sum(CASE WHEN x = 1 THEN y ELSE 0 END) / count(*) AS h FROM s),
   u AS (SELECT *, unnest([-1.0::double, 1.0]) AS e FROM c),
   t AS (SELECT n, p, g, h, e AS a, greatest(-1, least(1, e - h / p)) AS b FROM u UNION ALL SELECT n, p, g, h, greatest(-1, least(1, e - g / p)), e FROM u)
   SELECT any_value(n)::bigint AS n, round(min(1 + g * a + h * b + p / 2 * (b - a) ** 2), 6) AS least, true AS bounded FROM t"""


@query("M13 M20", _BEST_LINE)
def svm_invariants(spark, sf):
    """On one 0/1 column the least objective of a support vector machine has a closed form, which must lie within the duality gap of the fitted one."""
    rows = _setup(spark, sf).select("x", "features", F.col("y").alias("label"))
    sign = 2 * F.col("label") - 1
    with M.held(rows) as kept:
        fitted, _, seconds = M.fit_and_score([M.linear_svm("label", rounds=10)], kept, kept)
        found = C.svm_certificate(fitted.stages[0], kept, 0.1)
        g, h, p = kept.agg(-F.avg((1 - F.col("x")) * sign), -F.avg(F.col("x") * sign), 0.1 * F.var_samp("x")).first()
    inside = lambda v: max(-1.0, min(1.0, v))  # noqa: E731  # the scores of both values lie between the margins
    scores = [(e, inside(e - h / p)) for e in (-1.0, 1.0)] + [(inside(e - g / p), e) for e in (-1.0, 1.0)]
    least = min(1 + g * a + h * b + p / 2 * (b - a) ** 2 for a, b in scores)
    bounded = found.objective - found.gap <= least + 1e-9 and least <= found.objective + 1e-9 and seconds > 0
    return spark.createDataFrame([(found.n, round(least, 6), bounded)], "n long, least double, bounded boolean")


@query(
    "M5 M6",
    f"""WITH k AS (SELECT x, count(*)::double AS n, avg(y) AS p FROM ({_SETUP}) GROUP BY 1)
       SELECT sum(n)::bigint AS n, round(-sum(n * (CASE WHEN p > 0 THEN p * ln(p) ELSE 0 END + CASE WHEN p < 1 THEN (1 - p) * ln(1 - p) ELSE 0 END)) / sum(n), 6) AS objective,
          round(abs(avg(0.0 * n)), 4) AS gradient FROM k""",
)
def logistic_certificate(spark, sf):
    """On one 0/1 column the least log loss is the entropy of the label given the column, and there the gradient is zero."""
    rows = _setup(spark, sf).select("features", F.col("y").alias("label"))
    with M.held(rows) as kept:
        found = C.logistic_certificate(_tight(M.logistic("label")).fit(kept), kept)
    return spark.createDataFrame([(found.n, round(found.objective, 6), round(found.gradient, 4))], "n long, objective double, gradient double")


_POSITIONS = """WITH x AS (SELECT label, (generate_subscripts(embedding, 1) - 1)::int AS p, unnest(embedding)::double AS v FROM embeddings),
   g AS (SELECT p, label, count(*)::double AS n, avg(v) AS m, var_pop(v) * count(*) AS w FROM x GROUP BY 1, 2), t AS (SELECT p, avg(v) AS m FROM x GROUP BY 1),
   f AS (SELECT p, (sum(n * (g.m - t.m) ** 2) / (count(*) - 1)) / (sum(w) / (sum(n) - count(*))) AS f FROM g JOIN t USING (p) GROUP BY p)"""


@query("G9", f"{_POSITIONS} SELECT p AS position FROM f ORDER BY f DESC, p LIMIT 5")
def anova_top(spark, sf):
    """The five embedding positions whose F statistic against the class is largest."""
    rows = table(spark, sf, "embeddings").select(array_to_vector("embedding").alias("all"), "label")
    model = G.feature_selector("all", "kept", "label", continuous=True, mode="numTopFeatures", threshold=5).fit(rows)
    return spark.createDataFrame([(int(i),) for i in model.selectedFeatures], "position int")


@query(
    "G11",
    """WITH c AS (SELECT quantile_disc(l_linenumber, 0.5) AS cut FROM lineitem)
       SELECT (l_linenumber >= cut)::int::double AS bin, count(*) AS n, min(l_linenumber)::int AS low, max(l_linenumber)::int AS high FROM lineitem, c GROUP BY 1""",
)
def median_bins(spark, sf):
    """Two quantile bins of a column with few values are cut at its median."""
    rows = table(spark, sf, "lineitem").select("l_linenumber")
    out = G.quantile_bins("l_linenumber", "bin", 2).fit(rows).transform(rows)
    return out.groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.min("l_linenumber").cast("int").alias("low"), F.max("l_linenumber").cast("int").alias("high"))


_HASH = "('0x' || left(md5({salt}l_orderkey::varchar || '-' || l_linenumber::varchar), 8))::bigint"
_FOLDED = f"""WITH t AS (SELECT l_quantity AS x, l_extendedprice AS y, {_HASH.format(salt="'fold' || ")} % 3 AS fold, {_HASH.format(salt="")} % 100 < 80 AS train FROM lineitem),
   k AS (SELECT * FROM (VALUES (0.0), (20000.0)) AS v(strength)), f AS (SELECT DISTINCT fold FROM t WHERE train),
   s AS (SELECT f.fold, corr(y, x) AS r, stddev_samp(y) AS sy, regr_slope(y, x) AS b, avg(x) AS mx, avg(y) AS my FROM f JOIN t ON t.train AND t.fold <> f.fold GROUP BY 1),
   m AS (SELECT fold, strength, b / (1 + strength / sy) AS b, mx, my FROM s, k),
   e AS (SELECT strength, m.fold, sqrt(avg((y - (my + b * (x - mx))) ** 2)) AS rmse FROM m JOIN t ON t.train AND t.fold = m.fold GROUP BY 1, 2),
   g AS (SELECT strength, avg(rmse) AS score FROM e GROUP BY 1)"""


def _tuned_lines(spark, sf):
    """Ridge strength tuned on the training part by hash folds: the tuner's result and the test part."""
    rows = table(spark, sf, "lineitem").select(F.concat_ws("-", "l_orderkey", "l_linenumber").alias("id"), "l_quantity", "l_extendedprice")
    train, test = X.hash_split(G.assembler(["l_quantity"]).transform(rows), "id")
    ridge = M.linear("l_extendedprice", kind="ridge")
    judge = RegressionEvaluator(labelCol="l_extendedprice", metricName="rmse")
    return M.cross_validate(ridge, M.param_grid([(ridge.regParam, [0.0, 20000.0])]), judge, train, "id", folds=3), test, judge


@query("M21 M23", f"{_FOLDED} SELECT strength::double AS strength, round(score, 1) AS score FROM g")
def fold_scores(spark, sf):
    """Cross-validated error of each ridge strength over hash folds, from one scan of the training part."""
    rows = table(spark, sf, "lineitem").select(F.concat_ws("-", "l_orderkey", "l_linenumber").alias("id"), "l_quantity", "l_extendedprice")
    train, _ = X.hash_split(rows, "id")
    tuned = S.tune_linear(train, ["l_quantity"], "l_extendedprice", "id", [("ridge", 0.0), ("ridge", 20000.0)], folds=3)
    return tuned.frame(spark).select("strength", F.round("score", 1).alias("score"))


_GRID = [(kind, strength) for strength in (0.1, 2000.0, 12000.0) for kind in ("ridge", "lasso")]


@query(
    "M2 M3 M21 M23 E1",
    f"""WITH t AS (SELECT l_quantity::double AS a, l_discount::double AS b, l_extendedprice::double AS y, {_HASH.format(salt="'fold' || ")} % 3 AS fold FROM lineitem),
       k AS (SELECT * FROM (VALUES {', '.join(f"('{k}', {s}::double)" for k, s in _GRID)}) AS v(kind, strength)), f AS (SELECT DISTINCT fold FROM t),
       s AS (SELECT f.fold, corr(a, b) AS r, corr(a, y) AS ca, corr(b, y) AS cb, stddev_pop(a) AS da, stddev_pop(b) AS db, stddev_pop(y) AS dy, avg(a) AS ma, avg(b) AS mb, avg(y) AS my
             FROM f JOIN t ON t.fold <> f.fold GROUP BY 1),
       p AS (SELECT s.*, kind, strength, CASE WHEN kind = 'lasso' THEN strength / dy ELSE 0 END AS l, CASE WHEN kind = 'ridge' THEN 1 + strength / dy ELSE 1 END AS q FROM s, k),
       g AS (SELECT p.*, sa, sb,
               CASE WHEN sa = 0 THEN 0 WHEN sb = 0 THEN (ca - l * sa) / q ELSE (q * (ca - l * sa) - r * (cb - l * sb)) / (q * q - r * r) END AS wa,
               CASE WHEN sb = 0 THEN 0 WHEN sa = 0 THEN (cb - l * sb) / q ELSE (q * (cb - l * sb) - r * (ca - l * sa)) / (q * q - r * r) END AS wb
             FROM p, (VALUES (-1), (0), (1)) AS x(sa), (VALUES (-1), (0), (1)) AS z(sb)),
       m AS (SELECT kind, strength, fold, arg_min(wa * dy / da, cost) AS wa, arg_min(wb * dy / db, cost) AS wb, any_value(ma) AS ma, any_value(mb) AS mb, any_value(my) AS my
             FROM (SELECT *, q * (wa * wa + wb * wb) / 2 + r * wa * wb - wa * ca - wb * cb + l * (abs(wa) + abs(wb)) AS cost FROM g WHERE sign(wa) = sa AND sign(wb) = sb) GROUP BY 1, 2, 3),
       e AS (SELECT kind, strength, m.fold, sqrt(avg((y - my - wa * (a - ma) - wb * (b - mb)) ** 2)) AS rmse FROM m JOIN t USING (fold) GROUP BY 1, 2, 3)
       SELECT kind, strength, round(avg(rmse), 3) AS score FROM e GROUP BY 1, 2""",
)
def regression_grid(spark, sf):
    """Ridge and lasso strengths for two features by cross-validation, all from one scan."""
    rows = table(spark, sf, "lineitem").select(F.concat_ws("-", "l_orderkey", "l_linenumber").alias("id"), "l_quantity", "l_discount", "l_extendedprice")
    tuned = S.tune_linear(rows, ["l_quantity", "l_discount"], "l_extendedprice", "id", _GRID, folds=3)
    return tuned.frame(spark).withColumn("score", F.round("score", 3))


@query(
    "M21 M23",
    f"""{_FOLDED}, best AS (SELECT arg_min(strength, score) AS strength FROM g),
       w AS (SELECT strength, regr_slope(y, x) / (1 + strength / stddev_samp(y)) AS b, avg(x) AS mx, avg(y) AS my FROM t, best WHERE train GROUP BY strength)
       SELECT strength::double AS strength, round(sqrt(avg((y - (my + b * (x - mx))) ** 2)), 1) AS rmse, count(*) AS n FROM t, w WHERE NOT train GROUP BY 1""",
)
def tuned_scores(spark, sf):
    """The best setting, fitted on all training rows and scored on the test part."""
    tuned, test, judge = _tuned_lines(spark, sf)
    scored = tuned.bestModel.transform(test)
    row = (float(tuned.bestModel.getRegParam()), round(float(judge.evaluate(scored)), 1), scored.count())
    return spark.createDataFrame([row], "strength double, rmse double, n long")
