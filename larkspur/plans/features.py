"""Turning columns into model features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import (
    Binarizer, CountVectorizer, HashingTF, IDF, OneHotEncoder, QuantileDiscretizer, RegexTokenizer, StandardScaler,
    StopWordsRemover, StringIndexer, StringIndexerModel, Tokenizer, UnivariateFeatureSelector, VectorAssembler,
    VectorSlicer, Word2Vec,
)
from pyspark.sql import DataFrame, Window, functions as F

from larkspur.operators.lookups import lookup_join
from larkspur.operators.ordered import row_numbers
from larkspur.session import written


ANY_SIZE = 2**31 - 1  # the estimator must be given a size; this one cuts nothing

def assembler(cols: Sequence[str], output: str = "features", keep_invalid: bool = False) -> VectorAssembler:
    """Columns to one vector; a null is an error unless ``keep_invalid`` (then it becomes NaN)."""
    return VectorAssembler(inputCols=list(cols), outputCol=output, handleInvalid="keep" if keep_invalid else "error")


def scaler(source: str, output: str, centre: bool = False) -> StandardScaler:
    """Divide by the sample deviation; ``centre`` also subtracts the mean."""
    return StandardScaler(inputCol=source, outputCol=output, withMean=centre, withStd=True)


def standardise(df: DataFrame, cols: Sequence[str], centre: bool = True, suffix: str = "_z") -> DataFrame:
    """Scaled copies of plain columns; a constant column becomes 0."""
    stats = df.agg(F.struct(*[f(c).alias(f"{p}_{c}") for c in cols for p, f in (("m", F.avg), ("s", F.stddev))])).scalar()
    shift = lambda c: F.col(c) - stats[f"m_{c}"] if centre else F.col(c)
    return df.withColumns(
        {c + suffix: F.when(stats[f"s_{c}"] == 0, F.lit(0.0)).otherwise(shift(c) / stats[f"s_{c}"]) for c in cols}
    )


def indexer(source: str, output: str, alphabetical: bool = False, unseen: str = "error") -> StringIndexer:
    """Strings to 0, 1, ... by falling frequency (ties by name) or alphabetically."""
    order = "alphabetAsc" if alphabetical else "frequencyDesc"
    return StringIndexer(inputCol=source, outputCol=output, stringOrderType=order, handleInvalid=unseen)


def category_index(df: DataFrame, col: str) -> DataFrame:
    """``(value, n, index)`` in the order of :func:`indexer`, for any number of categories."""
    counted = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    ranked = row_numbers(written(counted, "categories").withColumn("__less", -F.col("n")), ["__less", col], name="index")
    return ranked.select(col, "n", (F.col("index") - 1).alias("index"))


def with_category_index(df: DataFrame, col: str, name: str | None = None) -> DataFrame:
    index = category_index(df, col).withColumnRenamed("index", name or f"{col}_index").withColumnRenamed("n", "__n")
    return lookup_join(df, index, col).drop("__n")


def one_hot_long(df: DataFrame, row_id: str, col: str) -> DataFrame:
    """Sparse one-hot code ``(row, category index)``; the last category is all zeros, so it has no row."""
    index = category_index(df, col).withColumnRenamed("n", "__n")
    last = index.agg(F.max("index")).scalar()
    return lookup_join(df.select(row_id, col), index, col).filter(F.col("index") < last).select(
        row_id, F.col("index").alias("position")
    )


def one_hot(sources: Sequence[str], outputs: Sequence[str]) -> OneHotEncoder:
    return OneHotEncoder(inputCols=list(sources), outputCols=list(outputs))


def mixed_features(categorical: Sequence[str], numeric: Sequence[str], label: str | None = None) -> Pipeline:
    """Index and one-hot the categorical columns, index the label, assemble everything."""
    stages: list = [indexer(c, f"{c}_index") for c in categorical]
    if categorical:
        stages.append(one_hot([f"{c}_index" for c in categorical], [f"{c}_code" for c in categorical]))
    if label:
        stages.append(indexer(label, "label"))
    return Pipeline(stages=[*stages, assembler([*[f"{c}_code" for c in categorical], *numeric])])


def with_class_weights(df: DataFrame, label: str, positive: object = 1, name: str = "weight") -> DataFrame:
    """Weight positives by the share of negatives and negatives by the share of positives."""
    is_positive = F.col(label) == F.lit(positive)
    negatives = df.agg(F.avg(F.when(is_positive, F.lit(0.0)).otherwise(F.lit(1.0)))).scalar()
    return df.withColumn(name, F.when(is_positive, negatives).otherwise(1 - negatives))


def chi_square(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """Chi-square statistic and degrees of freedom of each categorical feature against the label.

    Uses sum(observed^2 / expected) - n, so only pairs that occur are visited.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value")) for c in features])
    cells = df.select(F.inline(pairs), F.col(label).alias("label")).groupBy("feature", "value", "label").agg(
        F.count(F.lit(1)).cast("double").alias("o")
    )
    # every total comes from the counted cells; rows of one value stay together with one row per label
    values = cells.groupBy("feature", "value").agg(F.collect_list(F.struct("label", "o")).alias("labels"), F.sum("o").alias("row_total"))
    per_cell = values.select("feature", "row_total", F.inline("labels"))
    per_label = cells.groupBy("feature", "label").agg(F.sum("o").alias("col_total"))
    stat = per_cell.join(per_label, ["feature", "label"]).groupBy("feature").agg(
        F.sum(F.col("o") * F.col("o") / (F.col("row_total") * F.col("col_total"))).alias("ratio"),
        F.sum(F.col("o") / F.col("row_total")).alias("n_values"),
        F.sum(F.col("o") / F.col("col_total")).alias("n_labels"),
        F.sum("o").alias("n"),
    )
    return stat.select(
        "feature",
        (F.col("n") * (F.col("ratio") - 1)).alias("statistic"),
        ((F.round("n_values") - 1) * (F.round("n_labels") - 1)).cast("long").alias("degrees_of_freedom"),
    )


def feature_selector(
    source: str, output: str, label: str, continuous: bool = False, mode: str = "fpr", threshold: float = 0.05
) -> UnivariateFeatureSelector:
    """Chi-square (categorical) or ANOVA F (continuous) selection against a categorical label."""
    selector = UnivariateFeatureSelector(featuresCol=source, outputCol=output, labelCol=label, selectionMode=mode)
    selector.setFeatureType("continuous" if continuous else "categorical").setLabelType("categorical")
    return selector.setSelectionThreshold(threshold)


def vector_slice(source: str, output: str, indices: Sequence[int]) -> VectorSlicer:
    return VectorSlicer(inputCol=source, outputCol=output, indices=list(indices))


def quantile_bins(source: str, output: str, buckets: int) -> QuantileDiscretizer:
    return QuantileDiscretizer(inputCol=source, outputCol=output, numBuckets=buckets, handleInvalid="keep")


def presence(source: str, output: str) -> Binarizer:
    """1.0 where a count is above zero."""
    return Binarizer(inputCol=source, outputCol=output, threshold=0.0)


def tokeniser(source: str, output: str = "tokens", words_only: bool = False):
    """Split on single whitespace characters, or on non-word characters when ``words_only``."""
    if words_only:
        return RegexTokenizer(inputCol=source, outputCol=output, pattern=r"\W+", gaps=True, toLowercase=True)
    return Tokenizer(inputCol=source, outputCol=output)


def stop_words(source: str, output: str) -> StopWordsRemover:
    return StopWordsRemover(inputCol=source, outputCol=output)


def tf_idf_stages(
    text: str, *, buckets: int | None = None, vocabulary: int | None = None, min_df: float = 1.0, words_only: bool = False,
    keep_stop_words: bool = False, weighted: bool = True, output: str = "features",
) -> list:
    """Text to term weights: hashed into ``buckets``, or over a fitted vocabulary.

    The vocabulary holds every term of ``min_df`` documents; only a caller that
    names ``vocabulary`` cuts it to so many terms.
    """
    stages: list = [tokeniser(text, "tokens", words_only)]
    tokens = "tokens"
    if not keep_stop_words:
        stages.append(stop_words("tokens", "kept"))
        tokens = "kept"
    counts = "counts" if weighted else output
    if buckets:
        stages.append(HashingTF(inputCol=tokens, outputCol=counts, numFeatures=buckets))
    else:
        stages.append(CountVectorizer(inputCol=tokens, outputCol=counts, vocabSize=vocabulary or ANY_SIZE, minDF=min_df))
    if weighted:
        stages.append(IDF(inputCol=counts, outputCol=output))
    return stages


def word_count_stages(cols: Sequence[str], output: str = "features") -> list:
    """Inverse document weights over a wide table of ready-made word-count columns."""
    return [assembler(cols, "counts", keep_invalid=True), IDF(inputCol="counts", outputCol=output)]


def training_parts(documents: DataFrame, per_part: int = 20_000) -> int:
    """Parts for :func:`word_vectors`: one per ``per_part`` documents, so they follow the data and never the machine."""
    return max(1, -(-documents.count() // per_part))


def word_vectors(tokens: str, output: str, size: int = 100, min_count: int = 1, parts: int = 1, seed: int = 42) -> Word2Vec:
    """Averaged word vectors.  ``parts`` tasks train and are averaged, so it is part of the result and must not follow the machine."""
    return Word2Vec(inputCol=tokens, outputCol=output, vectorSize=size, minCount=min_count, numPartitions=parts, seed=seed)


def label_names(model: PipelineModel, spark) -> DataFrame:
    """``(output column, index, label)`` for every fitted string indexer of a pipeline.

    The labels are those the fitted model holds on the driver already; for more
    categories than that allows use :func:`category_index`.
    """
    rows = [
        (stage.getOutputCol(), float(i), name)
        for stage in model.stages
        if isinstance(stage, StringIndexerModel)
        for i, name in enumerate(stage.labels)
    ]
    return spark.createDataFrame(rows, "column string, index double, label string")


def sparse_entries(df: DataFrame, row_id: str, vector: str) -> DataFrame:
    """Non-zero entries of a vector column as ``(row, position, value)``; sparse vectors stay sparse."""
    fields = F.unwrap_udt(F.col(vector))
    positions = F.coalesce(fields["indices"], F.sequence(F.lit(0), F.size(fields["values"]) - 1))
    pairs = F.arrays_zip(positions.alias("position"), fields["values"].alias("value"))
    return df.select(row_id, F.inline(pairs)).filter(F.col("value") != 0)
