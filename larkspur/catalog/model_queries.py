"""Training, tuning and scoring."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import CountVectorizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from larkspur.catalog.registry import query, r6, rounded
from larkspur.catalog.text_queries import CLEAN_SQL, STOP_SQL
from larkspur.functions import text as T
from larkspur.operators import sampling as X, timeseries as W
from larkspur.plans import bayes_grid as B, coreset as R, evaluate as E, features as G, models as M
from larkspur.session import written
from larkspur.sources.readers import table

# Regression

_SUMS = """SELECT regr_slope(l_extendedprice, l_quantity) AS b, regr_intercept(l_extendedprice, l_quantity) AS a FROM lineitem"""


@query(
    "M1 M19",
    f"SELECT 'l_quantity' AS \"name\", round(b, 4) AS \"value\" FROM ({_SUMS}) UNION ALL SELECT 'intercept', round(a, 4) FROM ({_SUMS})",
)
def linreg_single(spark, sf):
    rows = G.assembler(["l_quantity"]).transform(table(spark, sf, "lineitem").select("l_quantity", "l_extendedprice"))
    out = M.coefficients(M.linear("l_extendedprice").fit(rows), ["l_quantity"], spark)
    return out.withColumn("value", F.round("value", 4))


_TWO = """WITH s AS (SELECT var_pop(l_quantity) AS q, var_pop(l_discount) AS d, covar_pop(l_quantity, l_discount) AS qd, covar_pop(l_quantity, l_extendedprice) AS qy,
       covar_pop(l_discount, l_extendedprice) AS dy, avg(l_quantity) AS mq, avg(l_discount) AS md, avg(l_extendedprice) AS my FROM lineitem),
   b AS (SELECT *, (d * qy - qd * dy) / (q * d - qd * qd) AS bq, (q * dy - qd * qy) / (q * d - qd * qd) AS bd FROM s)"""


@query(
    "M1 M19",
    f"""{_TWO} SELECT 'l_quantity' AS "name", round(bq, 3) AS "value" FROM b UNION ALL SELECT 'l_discount', round(bd, 3) FROM b
        UNION ALL SELECT 'intercept', round(my - bq * mq - bd * md, 3) FROM b""",
)
def linreg_two(spark, sf):
    names = ["l_quantity", "l_discount"]
    rows = G.assembler(names).transform(table(spark, sf, "lineitem").select(*names, "l_extendedprice"))
    return M.coefficients(M.linear("l_extendedprice").fit(rows), names, spark).withColumn("value", F.round("value", 3))


_PENALISED = """WITH s AS (SELECT corr(l_extendedprice, l_quantity) AS r, stddev_pop(l_extendedprice) AS sy, stddev_pop(l_quantity) AS sx,
       avg(l_extendedprice) AS my, avg(l_quantity) AS mx FROM lineitem),
   b AS (SELECT 'ridge' AS kind, r / (1 + 5000 / sy) * sy / sx AS b, my, mx FROM s UNION ALL SELECT 'lasso', greatest(r - 5000 / sy, 0) * sy / sx, my, mx FROM s)
   SELECT kind, round(b, 1) AS slope, round(my - b * mx, 0) AS intercept FROM b"""


@query("M2 M3 M19", _PENALISED)
def penalised_lines(spark, sf):
    """With one feature a ridge slope is shrunk and a lasso slope cut by a known amount."""
    rows = G.assembler(["l_quantity"]).transform(table(spark, sf, "lineitem").select("l_quantity", "l_extendedprice"))
    with M.held(rows.select("features", "l_extendedprice")) as kept:
        lines = [(k, M.linear("l_extendedprice", kind=k, strength=5000.0).fit(kept)) for k in ("ridge", "lasso")]
    found = [(k, float(m.coefficients[0]), float(m.intercept)) for k, m in lines]
    out = spark.createDataFrame(found, "kind string, slope double, intercept double")
    return out.select("kind", F.round("slope", 1).alias("slope"), F.round("intercept", 0).alias("intercept"))


@query("M1 M2 M3 E1 E13 G1 G2 X4")
def linreg_family(spark, sf):
    """Ordinary, lasso and ridge regression on one hash split, compared by error."""
    rows = table(spark, sf, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("id"), "l_quantity", "l_discount", "l_tax", "l_extendedprice"
    )
    train, test = X.hash_split(rows, "id", 70)
    target = "l_extendedprice"
    prepared = Pipeline(stages=[G.assembler(["l_quantity", "l_discount", "l_tax"], "raw"), G.scaler("raw", "features")]).fit(train)
    ready = lambda part: prepared.transform(part).select("features", target)
    scores = []
    with M.held(ready(train)) as fitted:
        for kind in ("ordinary", "lasso", "ridge"):
            scored = M.linear(target, kind=kind).fit(fitted).transform(ready(test))
            metrics = E.regression_metrics(scored, target, "prediction").first().asDict()
            scores.append(M.metric_row(spark, kind, **metrics))
    return E.comparison(scores)


@query("M1 M3 M4 E2 E3 E13 W8 W14 T15")
def forecast(spark, sf):
    """Next close from bar features: scaled ridge and boosted trees, split in time, with direction."""
    ticks = table(spark, sf, "events")
    prices = dict.fromkeys(["open_", "high", "low", "close", "volume"], "value")
    bars = W.resample_ohlcv(ticks, "ts", "event_id", keys=["event_type"], period="hour", **prices)
    rows = W.bar_features(written(bars, "bars"), "ts", ["ts"], ["event_type"])
    names = "close_lag_1 close_lag_2 close_lag_5 close_lag_10 close_mean_5 close_mean_20 close_std_20 volume_mean_20 price_range month day_of_week".split()
    rows = written(rows.select("ts", "event_type", "close", "target_close", *names), "features")
    split = W.chronological_split(rows, ["ts", "event_type"], 0.8)
    scores = []
    with M.held(split) as kept:
        train, test = X.column_split(kept, "split")
        ridge = [G.assembler(names, "raw"), G.scaler("raw", "features", centre=True), M.linear("target_close", kind="ridge", strength=0.01)]
        trees = [G.assembler(names), M.boosted_regressor("target_close", rounds=10)]
        for name, stages in (("ridge", ridge), ("trees", trees)):
            _, scored, _ = M.fit_and_score(stages, train, test)
            errors = E.regression_metrics(scored, "target_close", "prediction").first().asDict()
            moves = E.directional_accuracy(scored, "close", "target_close", "prediction").first().asDict()
            scores.append(M.metric_row(spark, name, **errors, **moves))
    return E.comparison(scores)


def _lines(spark, sf):
    return table(spark, sf, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("id"), "l_quantity", "l_discount", "l_extendedprice"
    )


# Text classification


def _texts(spark, sf):
    rows = table(spark, sf, "documents").select("doc_id", "text", "lang").join(table(spark, sf, "labels"), "doc_id")
    return rows.withColumns({"text": T.clean_text("text"), "label": F.col("quality").cast("double")})  # texts without labels are not cleaned


def _counted(texts, counting, *cols):
    """Texts through stages that need no fit, written once: each later pass reads term counts, not texts."""
    return written(Pipeline(stages=counting).fit(texts).transform(texts).select("doc_id", *cols, "counts"), "counted")


def _text_model(spark, rows, name, stages):
    train, test = X.hash_split(rows, "doc_id")
    _, scored, seconds = M.fit_and_score(stages, train, test)
    with M.held(scored.select("label", "prediction", *[c for c in ("rawPrediction",) if c in scored.columns])) as kept:
        row = E.overall_metrics(kept).first().asDict()
        row["auc"] = E.area_under_roc_ml(kept)
    return M.metric_row(spark, name, **row, fit_seconds=seconds)


def _vector_models(spark, sf, *models):
    """Metrics of several models on the same hashed term weights: texts are cleaned and counted once."""
    *counting, weights = G.tf_idf_stages("text", buckets=1 << 18)
    train, test = X.hash_split(_counted(_texts(spark, sf), counting, "label"), "doc_id")
    prepared = weights.fit(train)
    ready = lambda part: prepared.transform(part).select("label", "features")
    rows = []
    with M.held(ready(train)) as fitted, M.held(ready(test)) as judged:
        for name, model in models:
            _, scored, _ = M.fit_and_score([model], fitted, judged)
            with M.held(scored.select("label", "prediction", "rawPrediction")) as kept:
                rows.append(M.metric_row(spark, name, **E.overall_metrics(kept).first().asDict(), auc=E.area_under_roc_ml(kept)))
    return E.comparison(rows)


@query("M6 E4 E6 T1 T3 T6 T8 T15")
def text_logistic(spark, sf):
    return _vector_models(spark, sf, ("logistic", M.logistic("label")))


@query("M13 E4 E6 T6 T8 T15")
def text_svm(spark, sf):
    return _vector_models(spark, sf, ("svm", M.linear_svm("label")))


@query("M6 M13 E13 T15")
def text_models(spark, sf):
    """Logistic regression and support vectors on one set of held vectors."""
    return _vector_models(spark, sf, ("logistic", M.logistic("label")), ("svm", M.linear_svm("label")))


@query("M20 E13")
def text_comparison(spark, sf):
    """Naive Bayes on term counts against logistic regression, with fit times."""
    bayes = [*G.tf_idf_stages("text", vocabulary=10_000, words_only=True), M.naive_bayes("label")]
    logit = [*G.tf_idf_stages("text", vocabulary=10_000, words_only=True), M.logistic("label", rounds=10)]
    rows = written(_texts(spark, sf), "texts")
    return E.comparison([_text_model(spark, rows, "bayes", bayes), _text_model(spark, rows, "logistic", logit)])


@query("M7 T11")
def text_language(spark, sf):
    """Four-class logistic regression on word vectors and on hashed term weights."""
    *counting, weights = G.tf_idf_stages("text", buckets=1000)
    rows = _counted(_texts(spark, sf), counting, "lang", "tokens")
    train, test = X.hash_split(rows, "doc_id")
    index = G.indexer("lang", "label")
    vectors = [index, G.word_vectors("tokens", "features", 25, 2, parts=G.training_parts(train)), M.logistic("label", rounds=20)]
    hashed = [index, weights, M.logistic("label", rounds=20)]
    scores = []
    for name, stages in (("word vectors", vectors), ("term weights", hashed)):
        _, scored, _ = M.fit_and_score(stages, train, test)
        scores.append(M.metric_row(spark, name, **E.overall_metrics(scored).first().asDict()))
    return E.comparison(scores)


_WORDS = r"list_filter(string_split_regex(lower(text), '\W+'), lambda t: t <> '')"
_BAYES = f"""WITH w AS (SELECT doc_id, quality AS label, unnest({_WORDS}) AS term FROM documents JOIN labels USING (doc_id)),
   v AS (SELECT term FROM w GROUP BY 1 HAVING count(DISTINCT doc_id) >= 30),
   k AS (SELECT quality AS label, count(*) AS docs FROM labels JOIN documents USING (doc_id) GROUP BY 1),
   c AS (SELECT label, term, count(*) AS n, count(DISTINCT doc_id) AS d FROM w JOIN v USING (term) GROUP BY 1, 2),
   g AS (SELECT k.label, docs, v.term, coalesce(n, 0) AS n, coalesce(d, 0) AS d FROM k CROSS JOIN v LEFT JOIN c ON c.label = k.label AND c.term = v.term)"""


def _bayes_weights(spark, sf, kind):
    """(label, term, weight): the fitted log probability of each term in each class."""
    rows = X.widen(table(spark, sf, "documents"), "doc_id").select("doc_id", T.word_tokens("text").alias("words")).join(table(spark, sf, "labels"), "doc_id")
    rows = rows.withColumn("label", F.col("quality").cast("double"))
    counts = CountVectorizer(inputCol="words", outputCol="counts", minDF=30.0, vocabSize=G.ANY_SIZE)
    stages = [counts, G.presence("counts", "features")] if kind == "bernoulli" else [counts.setOutputCol("features")]
    model = Pipeline(stages=[*stages, M.naive_bayes("label", kind=kind)]).fit(rows)
    weights, terms = model.stages[-1].theta.toArray(), model.stages[0].vocabulary
    cells = [(int(c), t, float(weights[c][i])) for c in range(weights.shape[0]) for i, t in enumerate(terms)]
    return spark.createDataFrame(cells, "label int, term string, weight double").withColumn("weight", r6("weight"))


@query("M14 T7", f"{_BAYES} SELECT label::int AS label, term, round(ln((n + 1.0::double) / (sum(n) OVER (PARTITION BY label) + count(*) OVER (PARTITION BY label))), 6) AS weight FROM g")
def naive_bayes_multinomial(spark, sf):
    return _bayes_weights(spark, sf, "multinomial")


@query("M16 T10", f"{_BAYES} SELECT label::int AS label, term, round(ln((d + 1.0::double) / (docs + 2)), 6) AS weight FROM g")
def naive_bayes_bernoulli(spark, sf):
    return _bayes_weights(spark, sf, "bernoulli")


def _points(spark, sf):
    return table(spark, sf, "embeddings").select(
        "vec_id", array_to_vector("embedding").alias("features"), F.col("label").cast("double").alias("label")
    )


@query(
    "M15",
    """WITH x AS (SELECT label::int AS label, (generate_subscripts(embedding, 1) - 1)::int AS "position", unnest(embedding)::double AS v FROM embeddings)
       SELECT label, "position", round(avg(v), 6) AS mean, round(var_pop(v), 6) AS variance FROM x GROUP BY 1, 2""",
)
def naive_bayes_gaussian(spark, sf):
    """Mean and variance of every feature in every class."""
    model = M.naive_bayes("label", kind="gaussian").fit(_points(spark, sf))
    means, variances = model.theta.toArray(), model.sigma.toArray()
    cells = [
        (c, i, float(means[c][i]), float(variances[c][i])) for c in range(means.shape[0]) for i in range(means.shape[1])
    ]
    return rounded(spark.createDataFrame(cells, "label int, position int, mean double, variance double"), "mean", "variance")


# Classification of vectors and columns


def _class_model(spark, rows, name, stages, key):
    train, test = X.hash_split(rows, key, 70)
    model, scored, _ = M.fit_and_score(stages, train, test)
    return model, M.metric_row(spark, name, **E.overall_metrics(scored).first().asDict())


@query("M10 M19 E4")
def decision_trees(spark, sf):
    rows = _points(spark, sf)
    entropy = _class_model(spark, rows, "entropy, depth 4", [M.decision_tree("label")], "vec_id")[1]
    gini = _class_model(spark, rows, "gini, depth 3", [M.decision_tree("label", impurity="gini", depth=3)], "vec_id")[1]
    return E.comparison([entropy, gini])


@query("M19")
def tree_rules(spark, sf):
    return M.tree_text(M.decision_tree("label").fit(_points(spark, sf)), spark)


@query("M8 E4")
def one_vs_rest_logistic(spark, sf):
    return _class_model(spark, _points(spark, sf), "one-vs-rest", [M.one_vs_rest(M.logistic("label"), "label")], "vec_id")[1]


def _orders(spark, sf):
    rows = table(spark, sf, "orders").select(
        "o_orderkey", "o_totalprice", "o_orderpriority", "o_orderstatus", F.month("o_orderdate").alias("month"), F.year("o_orderdate").alias("year")
    )
    stages = [G.mixed_features(["o_orderpriority"], ["o_totalprice", "month", "year"], "o_orderstatus")]
    return rows, stages


@query("M9 G6")
def one_vs_rest_boosted(spark, sf):
    """Three classes, each told apart by boosted trees."""
    rows, prepare = _orders(spark, sf)
    boosted = M.one_vs_rest(M.boosted_classifier("label", rounds=3, depth=3), "label")
    return _class_model(spark, rows, "one-vs-rest boosted", [*prepare, boosted], "o_orderkey")[1]


@query("M11 M12 E6")
def forest_and_boosting(spark, sf):
    """Random forest and boosted trees on a two-class problem."""
    rows = _points(spark, sf).withColumn("label", (F.col("label") < 5).cast("double"))
    forest = _class_model(spark, rows, "forest", [M.random_forest("label")], "vec_id")[1]
    boosted = _class_model(spark, rows, "boosted", [M.boosted_classifier("label", rounds=5, depth=4)], "vec_id")[1]
    return E.comparison([forest, boosted])


@query("M5 G7 E7")
def weighted_logistic(spark, sf):
    """Class-weighted logistic regression on column features, judged by scores and by hard decisions."""
    rows = table(spark, sf, "documents").select("doc_id", "lang", F.col("n_chars").cast("double").alias("size")).join(table(spark, sf, "labels"), "doc_id")
    rows = rows.withColumn("label", F.col("toxic").cast("double"))
    train, test = X.hash_split(rows, "doc_id")
    stages = [G.mixed_features(["lang"], ["size", "quality"]), G.scaler("features", "scaled"), M.logistic("label", "scaled", 10, "weight")]
    _, scored, _ = M.fit_and_score(stages, G.with_class_weights(train, "label"), test.withColumn("weight", F.lit(1.0)))
    with M.held(scored.select("label", "prediction", "rawPrediction")) as kept:
        return M.metric_row(
            spark, "weighted", auc=E.area_under_roc_ml(kept), auc_hard=E.area_under_roc_ml(kept, "prediction"), **E.overall_metrics(kept).first().asDict()
        )


@query("M18 M17 E9")
def kmeans_sweep(spark, sf):
    """Silhouette and cost of several numbers of clusters, all from one coreset and in passes that serve every one."""
    return R.sweep_on_coreset(_points(spark, sf), [3, 5, 10, 15], vector_to_array("features"))[0]


_CUTS = ", ".join(f"({k}, '{cut}')" for k, cuts in ((2, ("0111", "0011", "0001")), (3, ("0122", "0112", "0012")), (4, ("0123",))) for cut in cuts)


@query(
    "M17 M18 E9",
    f"""WITH v AS (SELECT [0, 10, 40, 100][l_linenumber % 4 + 1]::double AS x, count(*)::double AS n FROM lineitem GROUP BY 1),
       a AS (SELECT k, cut, substr(cut, i::int, 1)::int AS c, x, n FROM (VALUES {_CUTS}) AS t(k, cut), (SELECT *, row_number() OVER (ORDER BY x) AS i FROM v)),
       s AS (SELECT k, cut, c, sum(n) AS m, sum(n * x) AS y, sum(n * x * x) AS q FROM a GROUP BY ALL),
       best AS (SELECT k, arg_min(cut, cost) AS cut, min(cost) AS cost FROM (SELECT k, cut, sum(q - y * y / m) AS cost FROM s GROUP BY 1, 2) GROUP BY 1),
       d AS (SELECT a.k, x, n, a.c AS own, s.c, m, x * x + q / m - 2 * x * y / m AS far FROM best JOIN a USING (k, cut) JOIN s USING (k, cut)),
       z AS (SELECT k, x, any_value(n) AS n, max(CASE WHEN own = c THEN far * m / (m - 1) END) AS a, min(CASE WHEN own <> c THEN far END) AS b FROM d GROUP BY 1, 2)
       SELECT k::int AS k, round(sum(n * (b - a) / greatest(a, b)) / sum(n), 7) AS silhouette, round(any_value(cost), 2) AS cost FROM z JOIN best USING (k) GROUP BY 1""",
)
def cluster_choice(spark, sf):
    """Two to four clusters of four values: the best partition, its cost and its silhouette for each number."""
    value = F.get(F.array(*[F.lit(float(x)) for x in (0, 10, 40, 100)]), F.col("l_linenumber") % 4)
    scores, _ = R.sweep_on_coreset(table(spark, sf, "lineitem").select(F.array(value).alias("point")), [2, 3, 4], F.col("point"))
    return scores.select("k", F.round("silhouette", 7).alias("silhouette"), F.round("cost", 2).alias("cost"))


@query("A25 A28 M17")
def cluster_sizes(spark, sf):
    points = _points(spark, sf)
    return M.kmeans(10).fit(points).transform(points).groupBy("prediction").agg(F.count(F.lit(1)).alias("n"))


@query("M19 M17")
def cluster_centres(spark, sf):
    model = M.kmeans(10).fit(_points(spark, sf))
    return M.cluster_centres(model, spark).select("cluster", F.posexplode("centre").alias("position", "value"))


@query("M21 M23")
def cross_validation(spark, sf):
    """Depth and bin counts of a tree by five-fold cross-validation."""
    tree = M.decision_tree("label")
    grid = M.param_grid([(tree.maxDepth, [2, 4]), (tree.maxBins, [16, 32])])
    judge = MulticlassClassificationEvaluator(metricName="accuracy")
    return M.tuning_table(M.cross_validate(tree, grid, judge, _points(spark, sf), "vec_id"), spark)


_GRID_SQL = f"""
WITH docs AS (SELECT doc_id, quality AS label, list_filter(string_split({CLEAN_SQL}, ' '), lambda t: t <> '' AND t NOT IN ({STOP_SQL})) AS tokens,
       ('0x' || left(md5(doc_id::varchar), 8))::bigint % 100 < 80 AS train FROM documents JOIN labels USING (doc_id)),
   w AS (SELECT doc_id, label, train, unnest(tokens) AS term FROM docs), size AS (SELECT count(*)::double AS n FROM docs WHERE train),
   classes AS (SELECT label, count(*)::double AS docs FROM docs WHERE train GROUP BY 1),
   v AS (SELECT term, ln((n + 1) / (count(DISTINCT doc_id) + 1)) AS idf, row_number() OVER (ORDER BY count(*) DESC, term) AS rank FROM w, size WHERE train GROUP BY term, n),
   c AS (SELECT term, label, count(*) AS tf FROM w WHERE train GROUP BY 1, 2),
   s AS (SELECT v.term, idf, rank, k.label, idf * coalesce(tf, 0) AS total FROM v CROSS JOIN classes k LEFT JOIN c ON c.term = v.term AND c.label = k.label),
   grid AS (SELECT * FROM (VALUES (200), (1000), (5000)) AS a(vocabulary), (VALUES (0.5::double), (1.0), (2.0)) AS b(smoothing)),
   d AS (SELECT vocabulary, smoothing, label, ln(sum(total) + smoothing * count(*)) AS below FROM s, grid WHERE rank <= vocabulary GROUP BY 1, 2, 3),
   a AS (SELECT doc_id, vocabulary, smoothing, s.label AS guess, sum(idf * (ln(total + smoothing) - below)) AS score
         FROM w JOIN s USING (term) JOIN grid ON rank <= vocabulary JOIN d USING (vocabulary, smoothing) WHERE NOT train AND d.label = s.label GROUP BY 1, 2, 3, 4),
   p AS (SELECT doc_id, docs.label, vocabulary, smoothing, arg_max(k.label, (coalesce(score, 0) + ln(k.docs + smoothing) - ln(n + smoothing * (SELECT count(*) FROM classes)), -k.label)) AS guess
         FROM docs CROSS JOIN grid CROSS JOIN classes k CROSS JOIN size LEFT JOIN a USING (doc_id, vocabulary, smoothing) WHERE NOT train AND (a.guess IS NULL OR a.guess = k.label) GROUP BY 1, 2, 3, 4),
   m AS (SELECT vocabulary, smoothing, k.label, count(*) FILTER (p.label = k.label) AS support, count(*) FILTER (p.guess = k.label) AS predicted,
         count(*) FILTER (p.label = k.label AND p.guess = k.label) AS hits FROM p, classes k GROUP BY 1, 2, 3)
SELECT vocabulary::int AS vocabulary, smoothing, sum(support)::bigint AS n, round(sum(hits) / sum(support), 6) AS accuracy,
   round(sum(CASE WHEN support = 0 THEN 0 ELSE support * 2.0 * hits / (support + predicted) END) / sum(support), 6) AS f1 FROM m GROUP BY 1, 2"""


@query("M14 M22 M23 T7 T8 T15", _GRID_SQL)
def validation_split(spark, sf):
    """Vocabulary size and smoothing of naive Bayes by one train/validation split, every setting from one table of counts."""
    words = F.filter(F.split("text", " "), lambda t: t != "")  # cleaned texts are lower case with single spaces
    tokens = T.without_stop_words(words, T.default_stop_words())
    rows = _texts(spark, sf).select("doc_id", F.col("quality").alias("label"), tokens.alias("tokens"))
    return rounded(B.validate_bayes(rows, "doc_id", "label", "tokens", [200, 1000, 5000], [0.5, 1.0, 2.0]), "accuracy", "f1")
