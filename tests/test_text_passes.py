"""Texts are cleaned and cut into tokens once per labelled document, however many passes a query makes."""

import pytest
from pyspark.sql import functions as F

from larkspur.catalog import model_queries as Q
from larkspur.plans import bayes_grid as B


def counting(spark, returns, make):
    """A column function and the number of values it has made."""
    made = spark.sparkContext.accumulator(0)

    @F.udf(returns)
    def f(value):
        made.add(1)
        return make(value)

    return f, made


@pytest.fixture
def tables(spark, tmp_path):
    """60 documents in two languages, 40 of them with labels."""
    words = {"en": "the cat sat on a warm mat", "de": "der hund lag vor dem haus"}
    docs = [(i, f"{words[lang]} w{i % 5} {'good' if i % 3 else 'bad'}", lang) for i in range(60) for lang in ["de" if i % 2 else "en"]]
    spark.createDataFrame(docs, "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(40)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    return str(tmp_path)


def test_language_cleans_once(spark, tables, monkeypatch):
    clean, made = counting(spark, "string", str.lower)
    monkeypatch.setattr(Q.T, "clean_text", clean)
    found = {r["model"]: r["accuracy"] for r in Q.text_language(spark, tables).collect()}
    assert set(found) == {"word vectors", "term weights"} and found["term weights"] == 1
    assert made.value == 40


def test_grid_makes_tokens_once(spark):
    split, made = counting(spark, "array<string>", str.split)
    df = spark.createDataFrame([(i, i % 2, f"{'x' if i % 2 else 'y'} z{i % 4} z{i % 4}") for i in range(80)], "id long, label int, text string")
    found = B.validate_bayes(df.select("id", "label", split("text").alias("tokens")), "id", "label", "tokens", [2, 50], [1.0]).collect()
    assert {(r["vocabulary"], r["accuracy"]) for r in found} >= {(50, 1.0)}
    assert made.value == 80


def test_class_term_counts(spark, rows):
    data = [("a", ["x", "y", "x", None, "x"]), ("b", ["y", None, None]), ("b", []), ("a", ["x"])]
    df = spark.createDataFrame(data, "label string, tokens array<string>")
    found = B.class_term_counts(df, "label", "tokens", ["a", "b"])
    assert rows(found) == sorted([("x", 4, 2, [4, 0]), ("y", 2, 2, [1, 1]), (None, 3, 2, [1, 2])], key=repr)


def test_vector_models_clean_once(spark, tables, monkeypatch):
    clean, made = counting(spark, "string", str.lower)
    monkeypatch.setattr(Q.T, "clean_text", clean)
    found = Q._vector_models(spark, tables, ("logistic", Q.M.logistic("label", rounds=5)), ("svm", Q.M.linear_svm("label", rounds=5))).collect()
    assert [r["model"] for r in found] == ["logistic", "svm"] and found[0]["accuracy"] == 1
    assert made.value == 40
