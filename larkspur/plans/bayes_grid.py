"""Multinomial naive Bayes over term weights, from one table of class-by-term counts.

The counts of each term in each class settle every model of the grid: a
vocabulary is a prefix of the terms by falling use (ties by term), a weight is
``tf * ln((N + 1) / (df + 1))``, and smoothing is added to the class sums.  So
all vocabulary sizes and smoothings are scored in one pass over the judged
documents, without fitting a model per setting.  A term lies in one band of
ranks between two vocabulary sizes; a document's sums per band add up to those
of each size.

Terms are counted before they are shuffled, ranked in range buckets, and joined
to the documents by term, so neither the vocabulary nor a document's row needs
to fit into a task.  Classes and settings must be few: a document gets a sum
for each class and smoothing.

Documents without a known term get the class with the largest prior; ties go to
the class that comes first in order.  Rows with a null label or null tokens
take no part.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from larkspur.operators.lookups import lookup_join
from larkspur.operators.ordered import row_numbers
from larkspur.operators.sampling import hash_split
from larkspur.session import written


def _usable(df: DataFrame, doc: str, label: str, tokens: str) -> DataFrame:
    """Rows with label and tokens, written once: tokens are made a single time, and filtered after that, lest the filter make them too."""
    rows = written(df.select(F.col(doc).alias("doc"), F.col(label).alias("label"), F.col(tokens).alias("tokens")), "documents")
    return rows.filter(F.col("label").isNotNull() & F.col("tokens").isNotNull())


def class_sizes(df: DataFrame, label: str) -> list[tuple[object, int]]:
    """Documents per class, in order of the class; a row per class reaches the driver."""
    return sorted((r[0], r[1]) for r in df.filter(F.col(label).isNotNull()).groupBy(label).count().collect())


def class_term_counts(df: DataFrame, label: str, tokens: str, classes: Sequence[object]) -> DataFrame:
    """``(term, uses, df, in_class)``: tokens and documents of each term, and its tokens in each class."""
    # sorted, a term's uses in a document follow each other, so its first one counts the document: tokens are read once
    listed = df.select(F.col(label).alias("label"), F.array_sort(tokens).alias("sorted"))
    first = lambda t, i: (i == 0) | ~t.eqNullSafe(F.get("sorted", i - 1))
    used = listed.select("label", F.inline(F.transform("sorted", lambda t, i: F.struct(t.alias("term"), first(t, i).alias("first")))))
    in_class = [F.count_if(F.col("label") == F.lit(c)) for c in classes]
    return used.groupBy("term").agg(F.count("*").alias("uses"), F.count_if("first").alias("df"), F.array(*in_class).alias("in_class"))


def _ranked_terms(df: DataFrame, label: str, tokens: str, sizes: Sequence[tuple[object, int]], min_df: int) -> DataFrame:
    """Terms with their rank by falling use, weight and weighted class sums, written once."""
    n = sum(count for _, count in sizes)
    counts = class_term_counts(df, label, tokens, [c for c, _ in sizes]).filter(F.col("df") >= min_df)
    counts = written(counts.withColumn("less", -F.col("uses")), "terms")
    ranked = row_numbers(counts, ["less", "term"], name="rank")
    idf = F.log(F.lit(n + 1.0) / (F.col("df") + 1))
    return ranked.select("term", "rank", idf.alias("idf"), F.transform("in_class", lambda x: x * idf).alias("sums"))


def _sum(cols: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a + b, cols)


def bayes_weights(df: DataFrame, doc: str, label: str, tokens: str, vocabulary: int, smoothing: float, min_df: int = 1) -> DataFrame:
    """The fitted model in long form ``(label, term, idf, weight)``, with the class's prior at a null term."""
    rows = _usable(df, doc, label, tokens)
    sizes = class_sizes(rows, "label")
    terms = written(_ranked_terms(rows, "label", "tokens", sizes, min_df).filter(F.col("rank") <= vocabulary), "ranked")
    total = terms.agg(F.count("*").alias("n"), *[F.sum(F.get("sums", F.lit(i))).alias(f"s{i}") for i in range(len(sizes))]).first()
    n, log = sum(c for _, c in sizes), math.log
    priors = [(log(c + smoothing) - log(n + smoothing * len(sizes))) for _, c in sizes]
    below = [log((total[f"s{i}"] or 0.0) + smoothing * max(total["n"], 1)) for i in range(len(sizes))]
    each = F.array(*[F.struct(F.lit(c).alias("label"), (F.log(F.get("sums", F.lit(i)) + smoothing) - below[i]).alias("weight")) for i, (c, _) in enumerate(sizes)])
    fitted = terms.select("term", "idf", F.inline(each)).select("label", "term", "idf", "weight")
    prior = df.sparkSession.createDataFrame([(c, None, None, p) for (c, _), p in zip(sizes, priors)], fitted.schema)
    return fitted.unionByName(prior)


def bayes_predictions(weights: DataFrame, df: DataFrame, doc: str, tokens: str) -> DataFrame:
    """``(doc, prediction)`` for each document with tokens, by the model of :func:`bayes_weights`."""
    rows = df.select(F.col(doc).alias("doc"), F.col(tokens).alias("tokens")).filter(F.col("tokens").isNotNull())
    priors = sorted((r["label"], r["weight"]) for r in weights.filter("term is null").collect())  # a row per class
    per_term = weights.filter("term is not null").groupBy("term").agg(F.first("idf").alias("idf"), F.map_from_entries(F.collect_list(F.struct("label", "weight"))).alias("w"))
    found = lookup_join(rows.select("doc", F.explode("tokens").alias("term")), per_term, "term")
    sums = found.groupBy("doc").agg(*[F.sum(F.col("idf") * F.element_at("w", F.lit(c))).alias(f"a{i}") for i, (c, _) in enumerate(priors)])
    scores = F.array(*[F.coalesce(f"a{i}", F.lit(0.0)) + p for i, (_, p) in enumerate(priors)])
    return rows.select("doc").join(sums, "doc", "left").select(F.col("doc").alias(doc), F.get(F.array(*[F.lit(c) for c, _ in priors]), _first_largest(scores)).alias("prediction"))


def _first_largest(scores: Column) -> Column:
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")


def validate_bayes(
    df: DataFrame, doc: str, label: str, tokens: str, vocabularies: Sequence[int], smoothings: Sequence[float], percent: int = 80, min_df: int = 1
) -> DataFrame:
    """``(vocabulary, smoothing, n, accuracy, f1)`` per setting: fitted on ``percent`` of the documents by a hash of ``doc``, judged on the others.

    ``f1`` is weighted by the documents of each class.
    """
    spark = df.sparkSession
    fitted, judged = hash_split(_usable(df, doc, label, tokens), "doc", percent)
    sizes = class_sizes(fitted, "label")
    if not sizes:
        raise ValueError("no document with label and tokens to fit on")
    bounds, classes = sorted(set(vocabularies)), [c for c, _ in sizes]
    band = F.lit(len(bounds))
    for i in reversed(range(len(bounds))):
        band = F.when(F.col("rank") <= bounds[i], i).otherwise(band)
    terms = _ranked_terms(fitted, "label", "tokens", sizes, min_df).withColumn("band", band.cast("int")).filter(F.col("band") < len(bounds))
    terms = written(terms.drop("rank"), "ranked")
    class_sums = [F.sum(F.get("sums", F.lit(i))).alias(f"s{i}") for i in range(len(classes))]
    totals = {r["band"]: r for r in terms.groupBy("band").agg(F.count("*").alias("n"), *class_sums).collect()}  # a row per size

    cells = [(k, i) for k in range(len(smoothings)) for i in range(len(classes))]
    logs = F.array(*[F.col("idf") * F.log(F.get("sums", F.lit(i)) + float(smoothings[k])) for k, i in cells])
    known = terms.select("term", "band", "idf", logs.alias("logs"))
    found = lookup_join(judged.select("doc", F.explode("tokens").alias("term")), known, "term")
    in_band = lambda b, x: F.sum(F.when(F.col("band") == b, x))
    per_doc = found.groupBy("doc").agg(
        *[in_band(b, F.col("idf")).alias(f"w{b}") for b in range(len(bounds))],
        *[in_band(b, F.get("logs", F.lit(j))).alias(f"a{b}_{j}") for b in range(len(bounds)) for j in range(len(cells))],
    )
    rows = judged.select("doc", "label").join(per_doc, "doc", "left")
    upto = lambda b, name: _sum([F.coalesce(name(x), F.lit(0.0)) for x in range(b + 1)])
    n, settings = sum(c for _, c in sizes), []
    for b, size in enumerate(bounds):
        held = [totals[x] for x in range(b + 1) if x in totals]
        n_terms, sums = sum(r["n"] for r in held), [sum(r[f"s{i}"] for r in held) for i in range(len(classes))]
        for k, smoothing in enumerate(smoothings):
            scores = [
                upto(b, lambda x, j=k * len(classes) + i: F.col(f"a{x}_{j}")) - upto(b, lambda x: F.col(f"w{x}")) * math.log(sums[i] + smoothing * max(n_terms, 1))
                + (math.log(count + smoothing) - math.log(n + smoothing * len(classes)))
                for i, (_, count) in enumerate(sizes)
            ]
            pick = F.get(F.array(*[F.lit(c) for c in classes]), _first_largest(F.array(*scores)))
            settings.append(F.struct(F.lit(size).alias("vocabulary"), F.lit(float(smoothing)).alias("smoothing"), pick.alias("prediction")))
    counts = rows.select("label", F.inline(F.array(*settings))).groupBy("vocabulary", "smoothing", "label", "prediction").agg(F.count("*").alias("n"))
    counts = spark.createDataFrame(counts.collect(), counts.schema)  # classes squared rows a setting
    key = ["vocabulary", "smoothing"]
    actual = counts.groupBy(*key, "label").agg(F.sum("n").alias("support"), F.sum(F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)).alias("hits"))
    predicted = counts.groupBy(*key, F.col("prediction").alias("label")).agg(F.sum("n").alias("predicted"))
    both = actual.join(predicted, [*key, "label"], "left").withColumn("f1", 2 * F.col("hits") / (F.col("support") + F.coalesce("predicted", F.lit(0))))
    return both.groupBy(*key).agg(
        F.sum("support").alias("n"), (F.sum("hits") / F.sum("support")).alias("accuracy"), (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("f1")
    )
