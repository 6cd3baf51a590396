"""From raw documents to packed training sequences, stage by stage.

Every stage takes ``(spark, docs, sf_dir)`` and gives a DataFrame, which is
written as Parquet and read again as the next stage's ``docs``.  All but the
last keep the columns of ``documents``.

1. ``language_id`` drops documents in no recognisable language: without a
   letter, or with words that hardly tell the languages apart.
2. ``near_duplicates`` keeps one document of each group of near copies, the one
   with the smallest id.  Rows that share an id are one group; of these the
   smallest row stays.  Rows without an id are in no group and stay.
3. ``personal_data`` puts surrogates in the place of personal data.
4. ``packing`` cuts the documents into token pieces and packs these.

Defined cases: null and empty texts are in no language, so the first stage
drops them; whole texts of any length go through every stage; an empty table
gives empty stages of the same columns; further columns of any type, whatever
their names, are kept by the first three stages and ignored by the last.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from larkspur.llm.common import staged, table
from larkspur.llm.language import fit_languages, with_language
from larkspur.llm.ngram_join import ngram_components
from larkspur.llm.queries import SURROGATE_KEY, packed_documents
from larkspur.llm.surrogates import replace_entities

LEAST_SCORE = 0.4


def _short_batches(spark: SparkSession) -> None:
    """Texts are long rows: a thousand at a time keep a task's Python batch at a few MB."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _short_batches(spark)
    told = with_language(docs, fit_languages(docs), name_column="__name", score_column="__score")
    return told.filter((F.col("__name") != "und") & (F.col("__score") >= LEAST_SCORE)).select(*docs.columns)


def _unordered(kind: str) -> bool:
    """Whether values of a type have no order of their own, as those that hold a map."""
    return "map<" in kind or "variant" in kind


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _short_batches(spark)
    groups = ngram_components(docs)
    first = groups.filter(F.col("doc_id") == F.col("component_id")).select("doc_id").distinct()
    rest = [c for c in docs.columns if c != "doc_id"]
    order = [F.to_json(F.struct(f"`{c}`")) if _unordered(docs.schema[c].dataType.simpleString()) else F.col(f"`{c}`") for c in rest]
    one = docs.join(first, "doc_id", "left_semi").groupBy("doc_id").agg(F.min_by(F.struct(*[f"`{c}`" for c in rest]), F.struct(*order)).alias("row"))
    return one.select("doc_id", "row.*").select(*docs.columns).unionByName(docs.filter("doc_id is null"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    replaced = replace_entities(docs, SURROGATE_KEY, count_column=None)
    return replaced.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns) if "n_chars" in docs.columns else replaced


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _short_batches(spark)
    return packed_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("packing", packing),
]

#: Tokens, surrogates and the fitted model are beyond SQL; tests/llm compares the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, applied to ``documents`` through all stages."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
