"""Metrics, checked on rule-based predictions so that SQL can state the answer."""

from __future__ import annotations

from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from larkspur.catalog.registry import query, r6, rounded
from larkspur.operators.ordered import window_columns
from larkspur.plans import evaluate as E, models as M
from larkspur.sources.readers import table

_PRED = """SELECT doc_id, quality AS label, CASE WHEN n_chars > 1500 THEN 1 ELSE 0 END AS prediction, n_chars::double AS score
    FROM documents JOIN labels USING (doc_id)"""


def predictions(spark, sf):
    rows = table(spark, sf, "documents").select("doc_id", "n_chars").join(table(spark, sf, "labels"), "doc_id")
    return rows.select(
        "doc_id", F.col("quality").cast("int").alias("label"), F.when(F.col("n_chars") > 1500, 1).otherwise(0).alias("prediction"),
        F.col("n_chars").cast("double").alias("score"),
    )


@query(
    "E10",
    f"""WITH p AS ({_PRED}), c AS (SELECT label, prediction, count(*) AS n FROM p GROUP BY 1, 2)
        SELECT label::int AS label, prediction, n, round(n::double / sum(n) OVER (PARTITION BY label), 6) AS share FROM c""",
)
def confusion_counts(spark, sf):
    return rounded(E.confusion_counts(predictions(spark, sf)), "share")


@query("E10 A26", f'WITH p AS ({_PRED}) SELECT label::int AS label, count(*) FILTER (prediction = 0) AS "0", count(*) FILTER (prediction = 1) AS "1", 0::BIGINT AS other FROM p GROUP BY 1')
def confusion_wide(spark, sf):
    return E.confusion_wide(predictions(spark, sf), [0, 1])


_CLASS = f"""p AS ({_PRED}), k AS (SELECT unnest([0, 1]) AS class),
    c AS (SELECT class, count(*) FILTER (label = class) AS support, count(*) FILTER (prediction = class) AS predicted,
          count(*) FILTER (label = class AND prediction = class) AS hits FROM p, k GROUP BY 1),
    m AS (SELECT *, hits::double / predicted AS precision, hits::double / support AS recall, 2.0::double * hits / (predicted + support) AS f1 FROM c)"""


@query("E5 E12", f"WITH {_CLASS} SELECT class::int AS class, support, predicted, hits, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1 FROM m")
def class_metrics(spark, sf):
    return rounded(E.class_metrics(predictions(spark, sf)), "precision", "recall", "f1")


_OVERALL = f"""WITH {_CLASS} SELECT round(sum(hits)::double / sum(support), 6) AS accuracy, round(sum(precision * support) / sum(support), 6) AS weighted_precision,
    round(sum(recall * support) / sum(support), 6) AS weighted_recall, round(sum(f1 * support) / sum(support), 6) AS weighted_f1 FROM m"""


@query("E4", _OVERALL)
def overall_metrics(spark, sf):
    out = E.overall_metrics(predictions(spark, sf))
    return rounded(out, *out.columns)


@query("E4", _OVERALL)
def evaluator_metrics(spark, sf):
    """The same figures from MLlib's evaluator."""
    rows = predictions(spark, sf).select(F.col("label").cast("double"), F.col("prediction").cast("double"))
    names = {"accuracy": "accuracy", "weighted_precision": "weightedPrecision", "weighted_recall": "weightedRecall", "weighted_f1": "f1"}
    with M.held(rows) as kept:
        judge = MulticlassClassificationEvaluator()
        values = {n: judge.setMetricName(m).evaluate(kept) for n, m in names.items()}
    out = spark.createDataFrame([tuple(values.values())], list(values))
    return rounded(out, *out.columns)


@query(
    "E8",
    f"""WITH {_CLASS} SELECT class::int AS class, round(recall, 6) AS true_positive_rate,
        round((predicted - hits)::double / ((SELECT count(*) FROM p) - support), 6) AS false_positive_rate FROM m""",
)
def class_rates(spark, sf):
    return rounded(E.class_rates(predictions(spark, sf)), "true_positive_rate", "false_positive_rate")


@query("F8", f"SELECT doc_id FROM ({_PRED}) WHERE label <> prediction")
def misclassified(spark, sf):
    return E.misclassified(predictions(spark, sf)).select("doc_id")


@query("E14 O3", f"SELECT doc_id, score FROM ({_PRED}) WHERE prediction = 1 ORDER BY score DESC, doc_id LIMIT 20")
def most_confident(spark, sf):
    return E.most_confident(predictions(spark, sf), 1, "score", 20, ["doc_id"]).select("doc_id", "score")


_NAIVE = "SELECT value, lead(value) OVER (ORDER BY ts, event_id) AS actual, lag(value, 1, value) OVER (ORDER BY ts, event_id) AS forecast FROM events"


def _naive_forecast(spark, sf):
    build = lambda w: {"actual": F.lead("value", 1).over(w), "forecast": F.lag("value", 1).over(w)}
    rows = window_columns(table(spark, sf, "events").select("event_id", "ts", "value"), build, ["ts", "event_id"], before=1, after=1)
    return rows.withColumn("forecast", F.coalesce("forecast", "value")).filter(F.col("actual").isNotNull())


@query(
    "E1 E2",
    f"""SELECT round(avg((actual - forecast) ** 2), 4) AS mse, round(sqrt(avg((actual - forecast) ** 2)), 6) AS rmse, round(avg(abs(actual - forecast)), 6) AS mae,
        round(1 - sum((actual - forecast) ** 2) / (var_pop(actual) * count(*)), 6) AS r2 FROM ({_NAIVE}) WHERE actual IS NOT NULL""",
)
def regression_metrics(spark, sf):
    out = E.regression_metrics(_naive_forecast(spark, sf), "actual", "forecast")
    return rounded(out, "rmse", "mae", "r2").withColumn("mse", F.round("mse", 4))


@query(
    "E3 C11",
    f"""SELECT count(*) AS n, round(100.0::double * count(*) FILTER (sign(actual - value) = sign(forecast - value)) / count(*), 6) AS direction_pct
        FROM ({_NAIVE}) WHERE actual IS NOT NULL""",
)
def directional_accuracy(spark, sf):
    return rounded(E.directional_accuracy(_naive_forecast(spark, sf), "value", "actual", "forecast"), "direction_pct")


_ROC = f"""WITH p AS ({_PRED}), g AS (SELECT score, count(*) FILTER (label = 1) AS pos, count(*) FILTER (label = 0) AS neg FROM p GROUP BY 1),
    s AS (SELECT score, pos, neg, sum(pos) OVER (ORDER BY score DESC)::bigint AS tp, sum(neg) OVER (ORDER BY score DESC)::bigint AS fp,
          (SELECT sum(pos) FROM g) AS np, (SELECT sum(neg) FROM g) AS nn FROM g)"""


@query(
    "E11 E8",
    f"""{_ROC} SELECT score, tp, fp, round(tp::double / np, 6) AS tpr, round(fp::double / nn, 6) AS fpr, round(tp::double / (tp + fp), 6) AS precision FROM s""",
)
def roc_points(spark, sf):
    return rounded(E.curve_points(predictions(spark, sf), "score", "label"), "tpr", "fpr", "precision")


@query(
    "E11",
    f"""{_ROC}, r AS (SELECT *, row_number() OVER (ORDER BY score DESC) AS rn, count(*) OVER () AS n FROM s)
        SELECT score, round(tp::double / np, 6) AS tpr, round(fp::double / nn, 6) AS fpr FROM r WHERE rn % ceil(n / 50.0)::bigint = 0 OR rn = n""",
)
def roc_points_thinned(spark, sf):
    out = E.curve_points(predictions(spark, sf), "score", "label", max_points=50)
    return rounded(out, "tpr", "fpr").select("score", "tpr", "fpr")


_AUC = f"{_ROC} SELECT round(sum(neg * (tp - pos + pos / 2.0::double)) / (min(np) * min(nn))::double, 6) AS auc FROM s"


@query("E6", _AUC)
def auc(spark, sf):
    return rounded(E.area_under_roc(predictions(spark, sf), "score", "label"), "auc")


@query("E7", _AUC.replace("n_chars::double AS score", "(n_chars > 1500)::int::double AS score"))
def auc_hard(spark, sf):
    """Area under the curve of 0/1 decisions."""
    return rounded(E.area_under_roc(predictions(spark, sf), "prediction", "label"), "auc")


@query("E6", _AUC)
def auc_ml(spark, sf):
    rows = predictions(spark, sf).select("score", F.col("label").cast("double").alias("label"))
    return spark.createDataFrame([(E.area_under_roc_ml(rows, "score"),)], "auc double").select(r6("auc").alias("auc"))


@query(
    "E9",
    """WITH x AS (SELECT vec_id, label, generate_subscripts(embedding, 1) AS i, unnest(embedding)::double AS v FROM embeddings),
       norm AS (SELECT vec_id, label, sum(v * v) AS sq FROM x GROUP BY 1, 2),
       mean AS (SELECT label AS c, i, avg(v) AS m FROM x GROUP BY 1, 2),
       size AS (SELECT label AS c, count(*) AS n, avg(sq) AS sq FROM norm GROUP BY 1),
       dot AS (SELECT vec_id, x.label, c, sum(v * m) AS d FROM x JOIN mean USING (i) GROUP BY 1, 2, 3),
       dist AS (SELECT vec_id, label, c, n, (norm.sq + size.sq - 2 * d) AS dd FROM dot JOIN norm USING (vec_id, label) JOIN size USING (c)),
       ab AS (SELECT vec_id, max(CASE WHEN label = c THEN dd * n / (n - 1) END) AS a, min(CASE WHEN label <> c THEN dd END) AS b FROM dist GROUP BY 1)
       SELECT round(avg(CASE WHEN a < b THEN 1 - a / b WHEN a > b THEN b / a - 1 ELSE 0 END), 6) AS silhouette FROM ab""",
)
def silhouette(spark, sf):
    points = table(spark, sf, "embeddings").select(array_to_vector("embedding").alias("features"), F.col("label").cast("double").alias("prediction"))
    return spark.createDataFrame([(E.silhouette(points),)], "s double").select(r6("s").alias("silhouette"))


@query(
    "E13 O2",
    f"""WITH p AS ({_PRED.replace('n_chars::double AS score', 'n_chars')}), k AS (SELECT unnest([500, 1500, 5000]) AS t)
        SELECT 'over ' || t AS model, round(avg(((n_chars > t)::int = label)::int), 6) AS accuracy FROM p, k GROUP BY t ORDER BY 2 DESC, 1 LIMIT 1""",
)
def best_model(spark, sf):
    """Three threshold rules compared in one table; the best by accuracy."""
    rows = predictions(spark, sf)
    scored = [
        E.overall_metrics(rows.withColumn("prediction", F.when(F.col("score") > t, 1).otherwise(0))).select(
            F.lit(f"over {t}").alias("model"), r6("accuracy").alias("accuracy")
        )
        for t in (500, 1500, 5000)
    ]
    return E.best_model(E.comparison(scored), "accuracy")
