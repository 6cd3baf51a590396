"""Repetition rules against brute force on words, with edge cases."""

import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from larkspur.llm.repeats import common_prefixes, maximal_repeats, suffix_array, with_repetition

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def blocks(draw, n_docs=12, alphabet=3, longest=40):
    lengths = draw.integers(0, longest, n_docs)
    docs = np.repeat(np.arange(n_docs), lengths)
    return draw.integers(0, alphabet, len(docs)).astype("i8"), docs, np.cumsum(lengths)[docs]


@pytest.mark.parametrize("alphabet", [1, 2, 5, 100])
def test_suffix_array_and_prefixes(alphabet):
    symbols, docs, stops = blocks(np.random.default_rng(alphabet), alphabet=alphabet)
    order, ranks = suffix_array(symbols, docs, stops)
    suffix = [(docs[i], symbols[i : stops[i]].tolist()) for i in range(len(symbols))]
    assert order.tolist() == sorted(range(len(symbols)), key=lambda i: suffix[i])
    for least in (1, 3, 5):
        found = common_prefixes(order, ranks, least).tolist()
        for slot in range(1, len(order)):
            (da, a), (db, b) = suffix[order[slot - 1]], suffix[order[slot]]
            same = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b))) if da == db else 0
            assert found[slot] == (same if same >= least else 0)


@pytest.mark.parametrize("alphabet", [1, 2, 4])
def test_maximal_repeats(alphabet):
    symbols = np.random.default_rng(alphabet).integers(0, alphabet, 60).astype("i8")
    n, docs = len(symbols), np.zeros(60, "i8")
    order, ranks = suffix_array(symbols, docs, docs + n)
    before = np.where(order == 0, -1, symbols[order - 1])
    found = {tuple(symbols[order[first] : order[first] + length].tolist()) for length, first, _ in maximal_repeats(common_prefixes(order, ranks, 2), before)}
    text = symbols.tolist()
    places = {}
    for i in range(n):
        for j in range(i + 2, n + 1):
            places.setdefault(tuple(text[i:j]), []).append(i)
    expected = set()
    for sequence, at in places.items():
        left = {text[i - 1] if i else "start" for i in at}
        right = {text[i + len(sequence)] if i + len(sequence) < n else "end" for i in at}
        if len(at) > 1 and len(left) > 1 and len(right) > 1:
            expected.add(sequence)
    assert found == expected


def plain(text, least=10):
    words = WORD.findall(text or "")
    n = len(words)

    def covered(width):
        seen = Counter(tuple(words[i : i + width]) for i in range(n - width + 1))
        return {j for i in range(n - width + 1) if seen[tuple(words[i : i + width])] > 1 for j in range(i, i + width)}

    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    longest = 0
    while longest < n and len(covered(longest + 1)) > 0:
        longest += 1
    repeated, chars = len(covered(5)), sum(map(len, words))
    inside = sum(len(words[j]) for j in covered(least))
    failed = n < 10 or 100 * repeated > 20 * n
    longest = longest if longest >= 5 else 0
    return n, chars, len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), repeated, failed, inside, longest, not failed and 100 * inside <= 25 * chars and longest <= 50


def texts():
    draw = np.random.default_rng(3)
    prose = lambda n: " ".join(f"w{x}" for x in draw.integers(0, 5_000, n))
    passage = prose(60)
    some = [None, "", " \n\t ", "one", "a b c d e f g h i j", "x " * 400, prose(300), f"{prose(400)}\n{passage}\n{prose(500)}\n{passage}",
            f"{passage} {passage}", "# | <b>&\nsame line here\n\nsame line here\r\nsame line here", "é ü ß 漢字 " * 7 + prose(40),
            "\x0b".join([prose(30), prose(30)]), "no separator " * 3 + "\x1c\x85 x", prose(20_000)]
    return some + [" ".join(draw.choice(["a", "b", "c"], 60)) for _ in range(20)]


def test_rules_equal_brute_force(spark):
    rows = list(enumerate(texts()))
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("repetition_", F.create_map("doc_id", "doc_id"))
    found = {r["doc_id"]: r["repetition"] for r in with_repetition(df).collect()}
    assert len(found) == len(rows)
    for doc_id, text in rows:
        r = found[doc_id]
        got = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.covered_chars, r.longest_repeat, r.kept)
        if text is None or len(text) < 50_000:
            assert got == plain(text), doc_id
        else:
            assert r.n_words == 20_000 and r.kept
        inside = "".join((text or "")[s["start"] : s["end"]] for s in r.repeat_spans)
        assert len(re.sub(r"[\x20\x09-\x0D]", "", inside)) == r.covered_chars


def test_verdict_of_the_method(spark):
    """A passage of 60 words that comes twice in a long clean text passes the base rules and fails the longest repeat."""
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts())], "doc_id long, text string")
    verdict = {r["doc_id"]: r["repetition"] for r in with_repetition(df).filter("doc_id in (6, 7)").collect()}
    assert verdict[6].kept and not verdict[7].base_failed and not verdict[7].kept and verdict[7].longest_repeat == 60 and verdict[7].n_repeats == 1


def test_other_columns_and_empty_tables(spark):
    schema = "doc_id long, text string, n_words string, kept map<string,int>"
    df = spark.createDataFrame([(None, None, "x", {"a": 1}), (1, "a b", None, None), (1, "a b", None, None)], schema)
    out = with_repetition(df)
    assert out.columns == ["doc_id", "text", "n_words", "kept", "repetition"] and out.count() == 3
    assert with_repetition(df.limit(0)).count() == 0
