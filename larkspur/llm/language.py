"""Language identification by words first, then shorter and shorter character n-grams.

A word of the model scores each language by its logarithmic relative frequency
there, or a fixed penalty where the language never had it.  A word the model
does not know falls back to the n-grams of the padded word, the longest length
that has a known n-gram, down to single characters; their scores are averaged.
A text's score is the mean over its words; the language with the highest wins,
ties to the smaller name.

The model is fitted on a bounded sample: about ``fit_rows`` labelled rows,
drawn by a hash of the row id in equal shares of all labels, so a label with
few rows has all of them in it.  Every label, word and n-gram of the sample is
kept; the sample alone bounds what is sent to the tasks, where a word or n-gram
holds numbers only for the languages that have it.

Defined cases: a text that is null or has no letter is ``und`` with score 0, as
is every text if nothing could be learned; words without any known n-gram say
nothing, and a text of only such words takes the first language with an even
score.  Rows keep their other columns (those named like the two new ones are replaced), repeated rows are predicted alike.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from larkspur.llm.common import Shared, staged
from larkspur.llm.words import WordTable

_LETTERS = re.compile(r"[^\W\d_]+")
_HELD_WORDS = 200_000  # words that a fitting task counts before it passes them on
_TABLE_WORDS, _TABLE_BYTES = 150_000, 48 << 20  # scored words that a predicting task keeps, and their size
_MATRIX_BYTES = 32 << 20  # of a model that a task spreads out
_TEXT_WORDS = 8_192  # words of a text that are added up at once
_EVIDENCE_WORDS = 8  # the certainty of a longer text is that of so many words
PENALTY = -7.0  # log10 frequency of what a language never had


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    longest: int
    rows: dict[str, int]  # word, or n-gram after a tab -> its row
    starts: np.ndarray  # where a row begins in the next two, and the end
    which: np.ndarray  # languages that have it
    values: np.ndarray  # their log10 frequencies

    def scores(self, rows: list[int], axis: int = 0) -> np.ndarray:
        """Per row the score of each language, and 1."""
        out = np.full((len(rows), len(self.languages) + 1), PENALTY)
        out[:, -1] = 1.0
        for at, row in enumerate(rows):
            here = slice(self.starts[row], self.starts[row + 1])
            out[at, self.which[here]] = self.values[here]
        return out


def _words(text: str) -> list[str]:
    return _LETTERS.findall(text.lower())


def _word_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    counts: Counter = Counter()
    for batch in batches:
        for text, lang in zip(batch["text"], batch["lang"]):
            counts.update((lang, w) for w in _words(text))
            if len(counts) > _HELD_WORDS:
                yield pd.DataFrame([(a, w, n) for (a, w), n in counts.items()], columns=["lang", "word", "n"])
                counts.clear()
    yield pd.DataFrame([(a, w, n) for (a, w), n in counts.items()], columns=["lang", "word", "n"])


def fit_languages(labelled: DataFrame, id_column: str = "doc_id", fit_rows: int = 4_000, longest: int = 5) -> LanguageModel:
    """Learn from ``text`` and ``lang`` of the rows where both are given."""
    rows = labelled.filter("text is not null and lang is not null")
    found = rows.groupBy("lang").count().collect()  # a row per label
    none = np.empty(0, "i4")
    if not found:
        return LanguageModel((), longest, {}, np.zeros(1, "i8"), none, np.empty(0))
    languages = tuple(sorted(r["lang"] for r in found))
    steps, each = 1 << 20, max(1, fit_rows // len(found))
    keep = F.create_map(*[F.lit(x) for r in found for x in (r["lang"], max(1, min(steps, -(-steps * each // r["count"]))))])
    sample = rows.filter(F.pmod(F.xxhash64(F.col(id_column)), F.lit(steps)) < F.element_at(keep, F.col("lang"))).select("text", "lang")
    words = sample.mapInPandas(_word_counts, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    words = words.persist()
    padded, size = F.concat(F.lit(" "), F.col("word"), F.lit(" ")), F.length("word") + 2

    def grams_of(n: int) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(size - n + 1, F.lit(1)))
        return F.filter(F.transform(starts, lambda i: F.concat(F.lit("\t"), F.substring(padded, i, F.lit(n)))), lambda g: F.length(g) == n + 1)

    grams = F.concat(*[grams_of(n) for n in range(1, longest + 1)])
    entries = words.select("lang", F.col("word").alias("key"), F.lit(0).alias("size"), "n").unionByName(
        words.select("lang", F.explode(grams).alias("key"), "n").withColumn("size", F.length("key") - 1)
    )
    per_key = entries.groupBy("size", "key", "lang").agg(F.sum("n").alias("n"))
    by_language = F.map_from_entries(F.sort_array(F.collect_list(F.struct("lang", "n"))))
    wide = staged(per_key.groupBy("size", "key").agg(F.sum("n").alias("n"), by_language.alias("by")), "language-counts")
    words.unpersist()
    counted = wide.select("size", F.explode("by").alias("lang", "n")).groupBy("size", "lang").agg(F.sum("n").alias("n"))
    number = {name: i for i, name in enumerate(languages)}
    totals = np.ones((longest + 1, len(languages)))
    for r in counted.collect():  # a row per language and length
        totals[r["size"], number[r["lang"]]] = r["n"]
    numbers = F.create_map(*[F.lit(x) for pair in number.items() for x in pair])
    entries = wide.select("key", "size", F.transform(F.map_keys("by"), lambda a: F.element_at(numbers, a)).alias("which"), F.map_values("by").alias("n"))
    entries = entries.toArrow().combine_chunks()
    if not len(entries):
        return LanguageModel(languages, longest, {}, np.zeros(1, "i8"), none, np.empty(0))
    column = lambda name: entries[name].combine_chunks()
    which, n, held = column("which").flatten().to_numpy(), column("n").flatten().to_numpy(), pc.list_value_length(column("which")).to_numpy()
    rows_of = {key: row for row, key in enumerate(column("key").to_pylist())}
    values = np.log10(n / totals[np.repeat(column("size").to_numpy(), held), which])
    return LanguageModel(languages, longest, rows_of, np.concatenate([[0], np.cumsum(held)]), which.astype("i4"), values)


class _Scorer:
    """Scores of words: a model of few languages is spread out once into a plain matrix, one of many stays as it is."""

    def __init__(self, model: LanguageModel) -> None:
        n = len(model.languages) + 1
        self.rows, self.longest, self.nothing, self.scores = model.rows, model.longest, np.zeros(n), model.scores
        if 8 * n * len(model.rows) <= _MATRIX_BYTES:
            plain = np.full((len(model.rows), n), PENALTY)
            plain[:, -1] = 1.0
            plain[np.repeat(np.arange(len(plain)), np.diff(model.starts)), model.which] = model.values
            self.scores = plain.take

    def __call__(self, word: str) -> np.ndarray:
        """Score per language, and 1 if the word says anything or else 0."""
        row = self.rows.get(word)
        if row is not None:
            return self.scores([row], 0)[0]
        for n in range(self.longest, 0, -1):
            text = f" {word} " if n > 1 else word  # a padding space alone says nothing
            found = [r for i in range(len(text) - n + 1) if (r := self.rows.get("\t" + text[i : i + n])) is not None]
            if found:
                return self.scores(found, 0).sum(axis=0) / len(found)
        return self.nothing


def _table(model: LanguageModel) -> WordTable:
    """Scores of words already met by a Python worker."""
    return WordTable(_Scorer(model), "<f8", max(1_000, min(_TABLE_WORDS, _TABLE_BYTES // (8 * (len(model.languages) + 1)))))


def with_language(df: DataFrame, model: LanguageModel, text_column: str = "text", name_column: str = "lang_pred", score_column: str = "score") -> DataFrame:
    """Add the predicted language of each whole text and a score from 0 to 1."""
    shared = df.sparkSession.sparkContext.broadcast(Shared(model, _table))

    @F.pandas_udf("name string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        fitted, table = shared.value.value, shared.value.made()
        n = len(fitted.languages)
        out = []
        for text in texts:
            words = _words(text) if text and n else []
            if not words:
                out.append(("und", 0.0))
                continue
            parts = (words[a : a + _TEXT_WORDS] for a in range(0, len(words), _TEXT_WORDS))
            scores = sum(np.frombuffer(b"".join(map(table.__getitem__, part)), "<f8").reshape(-1, n + 1).sum(axis=0) for part in parts)
            told = scores[-1]
            mean = scores[:-1] / max(told, 1.0)
            best = int(np.argmax(mean))
            weight = np.exp((mean - mean[best]) * np.log(10) * min(told, _EVIDENCE_WORDS))
            out.append((fitted.languages[best], float(1 / weight.sum())))
        return pd.DataFrame(out, columns=["name", "score"])

    others = [c for c in df.columns if c not in (name_column, score_column)]
    return df.withColumn("__language", predict(F.col(text_column))).select(
        *others, F.col("__language.name").alias(name_column), F.col("__language.score").alias(score_column)
    )


def fold_of(id_column: str | Column = "doc_id", folds: int = 5) -> Column:
    """Fold of a row: crc32 of its id as text, modulo ``folds``; null for a null id."""
    return F.pmod(F.crc32(F.encode(F.col(id_column).cast("string") if isinstance(id_column, str) else id_column.cast("string"), "UTF-8")), F.lit(folds))
