"""Text cleaning, tokens, term weights and token normalisation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column, DataFrame, functions as F

from larkspur.operators.heavy import heavy_hitters
from larkspur.operators.lookups import frequent_lookup, lookup_join
from larkspur.operators.quality import non_blank
from larkspur.session import written


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_text(col: Column | str, strip_breaks: bool = False) -> Column:
    """Lower case, optional ``<br>`` removal, ASCII letters only, single spaces, trimmed."""
    text = F.lower(_col(col))
    if strip_breaks:
        text = F.regexp_replace(text, r"<br\s*/?>", " ")
    return F.trim(F.regexp_replace(text, "[^a-z]+", " "))


def join_text(*cols: str) -> Column:
    """Columns joined by a space; nulls are skipped."""
    return F.concat_ws(" ", *[F.col(c).cast("string") for c in cols])


def messages(df: DataFrame, label: str, text: str, labels: Sequence[str]) -> DataFrame:
    """Normalise label and text, keep listed labels and non-blank texts."""
    tidy = df.withColumns({label: F.lower(F.trim(F.col(label))), text: F.trim(F.col(text))})
    return tidy.filter(F.col(label).isin(list(labels)) & non_blank(text))


def space_tokens(col: Column | str) -> Column:
    """Lower-cased tokens between whitespace, empty ones dropped."""
    return F.filter(F.split(F.lower(_col(col)), r"\s+"), lambda t: t != "")


def word_tokens(col: Column | str) -> Column:
    """Lower-cased runs of ASCII word characters."""
    return F.filter(F.split(F.lower(_col(col)), r"\W+"), lambda t: t != "")


def default_stop_words(language: str = "english") -> list[str]:
    return StopWordsRemover.loadDefaultStopWords(language)


def without_stop_words(tokens: Column | str, words: Sequence[str]) -> Column:
    """Tokens not in ``words``; order and repeats kept."""
    return F.filter(_col(tokens), lambda t: ~t.isin(list(words)))


def word_count_columns(tokens: str, words: Sequence[str], prefix: str = "") -> list[Column]:
    """One count column per listed word."""
    return [F.size(F.filter(tokens, lambda t: t == F.lit(word))).alias(f"{prefix}{word}") for word in words]


def term_counts(df: DataFrame, doc: str, tokens: Column | str) -> DataFrame:
    """Sparse term-document table ``(doc, term, tf)``."""
    return df.select(doc, F.explode(_col(tokens)).alias("term")).groupBy(doc, "term").agg(F.count(F.lit(1)).alias("tf"))


def document_frequency(counts: DataFrame, documents: DataFrame) -> DataFrame:
    """Documents and uses per term, and the smoothed weight ln((N + 1) / (df + 1))."""
    n_docs = documents.agg(F.count(F.lit(1))).scalar()
    return counts.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("uses")).withColumn(
        "idf", F.log((n_docs + 1).cast("double") / (F.col("df") + 1))
    )


def tf_idf(df: DataFrame, doc: str, tokens: Column | str) -> DataFrame:
    """Long term-document matrix ``(doc, term, tf, df, idf, tfidf)``; no vector, counted once, and only rows of rare terms move again."""
    counts = written(term_counts(df, doc, tokens), "counts")
    joined = frequent_lookup(counts, written(document_frequency(counts, df), "frequency"), "term", "df")
    return joined.withColumn("tfidf", F.col("tf") * F.col("idf")).select(doc, "term", "tf", "df", "idf", "tfidf")


def top_terms(df: DataFrame, label: str, tokens: Column | str, k: int) -> DataFrame:
    """The ``k`` most frequent terms of each class, ties by term; only candidates are shuffled."""
    return heavy_hitters(df.select(label, F.explode(_col(tokens)).alias("term")), "term", k, [label])


def positioned_tokens(df: DataFrame, doc: str, tokens: Column | str) -> DataFrame:
    """One row per token: ``(doc, position, term)``."""
    return df.select(doc, F.posexplode(_col(tokens)).alias("position", "term"))


# English noun endings and what replaces them to reach a base form.
NOUN_ENDINGS = [
    ("s", ""), ("ses", "s"), ("ves", "f"), ("xes", "x"), ("zes", "z"), ("ches", "ch"), ("shes", "sh"), ("men", "man"), ("ies", "y"),
]


def lemma_table(vocabulary: DataFrame, lexicon: DataFrame) -> DataFrame:
    """``(term, n, lemma)`` for each distinct term of ``vocabulary (term, n)``.

    A term keeps its form or loses a noun ending, whichever shortest form the
    ``lexicon (term)`` lists; a term without a listed form stays as it is.
    """
    forms = [F.col("term")] + [
        F.when(F.col("term").endswith(old), F.concat(F.expr(f"left(term, length(term) - {len(old)})"), F.lit(new)))
        for old, new in NOUN_ENDINGS
    ]
    candidates = vocabulary.select(F.col("term").alias("word"), "n", F.explode(F.array_compact(F.array(*forms))).alias("term"))
    listed = candidates.join(lexicon.select("term").distinct().withColumn("listed", F.lit(True)), "term", "left")
    best = F.min(F.when(F.col("listed"), F.struct(F.length("term").alias("size"), F.col("term").alias("form"))))
    return listed.groupBy("word").agg(F.first("n").alias("n"), best.alias("best")).select(
        F.col("word").alias("term"), "n", F.coalesce("best.form", "word").alias("lemma")
    )


def lemmatise(df: DataFrame, doc: str, tokens: Column | str, lexicon: DataFrame) -> DataFrame:
    """``(doc, position, term, lemma)``: each distinct term is resolved once, then joined back."""
    rows = positioned_tokens(df, doc, tokens)
    vocabulary = rows.groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    return lookup_join(rows, lemma_table(vocabulary, lexicon), "term").select(doc, "position", "term", "lemma")


def gather_tokens(rows: DataFrame, doc: str, token: str, name: str = "tokens") -> DataFrame:
    """Rebuild one ordered token array per document from ``(doc, position, token)`` rows."""
    listed = rows.groupBy(doc).agg(F.array_sort(F.collect_list(F.struct("position", F.col(token).alias("t")))).alias("a"))
    return listed.select(doc, F.col("a.t").alias(name))
