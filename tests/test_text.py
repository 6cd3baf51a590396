import math
from collections import Counter

import pytest

from larkspur.catalog.text_queries import STOP_WORDS
from larkspur.functions import text as T
from larkspur.functions.stem import stem_tokens
from larkspur.plans import features as G

# Word pairs published with the algorithm.
STEMS = {
    "caresses": "caress", "ponies": "poni", "ties": "ti", "cats": "cat", "feed": "feed", "agreed": "agre", "plastered": "plaster", "bled": "bled",
    "motoring": "motor", "sing": "sing", "conflated": "conflat", "troubled": "troubl", "sized": "size", "hopping": "hop", "tanned": "tan",
    "falling": "fall", "hissing": "hiss", "fizzed": "fizz", "failing": "fail", "filing": "file", "happy": "happi", "sky": "sky",
    "relational": "relat", "conditional": "condit", "rational": "ration", "digitizer": "digit", "radicalli": "radic", "vietnamization": "vietnam",
    "operator": "oper", "feudalism": "feudal", "hopefulness": "hope", "formaliti": "formal", "sensibiliti": "sensibl", "triplicate": "triplic",
    "electrical": "electr", "goodness": "good", "revival": "reviv", "airliner": "airlin", "adjustable": "adjust", "replacement": "replac",
    "adoption": "adopt", "homologou": "homolog", "communism": "commun", "bowdlerize": "bowdler", "probate": "probat", "rate": "rate",
    "cease": "ceas", "controll": "control", "roll": "roll", "yes": "ye", "is": "is", "": "", "généreux": "généreux",
}


def test_stems(spark):
    df = spark.createDataFrame([(list(STEMS),), ([],), (None,)], "words array<string>")
    first, empty, null = [r[0] for r in df.select(stem_tokens("words")).collect()]
    assert dict(zip(STEMS, first)) == STEMS and empty == [] and null is None


def test_clean_text(spark):
    cases = {
        "Hello, <br /><br>World!! 42": ("hello br br world", "hello world"), "": ("", ""), "?!": ("", ""), "Été là": ("t l", "t l"), "a\n\tb": ("a b", "a b"),
    }
    df = spark.createDataFrame([(k,) for k in cases] + [(None,)], "t string")
    got = {r[0]: (r[1], r[2]) for r in df.select("t", T.clean_text("t"), T.clean_text("t", strip_breaks=True)).collect()}
    assert got == {**cases, None: (None, None)}


def test_tokens(spark):
    df = spark.createDataFrame([("A  b, c ",), ("",), ("  ",), ("it's_ok 3x!",)], "t string")
    assert [r[0] for r in df.select(T.space_tokens("t")).collect()] == [["a", "b,", "c"], [], [], ["it's_ok", "3x!"]]
    assert [r[0] for r in df.select(T.word_tokens("t")).collect()] == [["a", "b", "c"], [], [], ["it", "s_ok", "3x"]]
    assert G.tokeniser("t").transform(df).first()["tokens"] == ["a", "", "b,", "c"]
    assert G.tokeniser("t", words_only=True).transform(df).first()["tokens"] == ["a", "b", "c"]


def test_stop_words_match_the_library(spark):
    assert sorted(T.default_stop_words()) == sorted(STOP_WORDS)
    df = spark.createDataFrame([(["the", "cat", "the", "cat"],)], "w array<string>")
    assert df.select(T.without_stop_words("w", ["the"])).first()[0] == ["cat", "cat"]


def test_messages(spark):
    df = spark.createDataFrame([(" HAM ", " hi "), ("spam", "  "), ("spam", None), ("other", "x"), (None, "x")], "label string, message string")
    assert [tuple(r) for r in T.messages(df, "label", "message", ["ham", "spam"]).collect()] == [("ham", "hi")]


def test_tf_idf_by_hand(spark):
    docs = {1: "a b a the", 2: "b the", 3: "the the c", 4: ""}
    df = spark.createDataFrame(list(docs.items()), "doc int, text string")
    got = {(r["doc"], r["term"]): r["tfidf"] for r in T.tf_idf(df, "doc", T.space_tokens("text")).collect()}
    counts = {d: Counter(t.split()) for d, t in docs.items()}
    expected = {
        (d, t): n * math.log(5 / (1 + sum(t in c for c in counts.values()))) for d, c in counts.items() for t, n in c.items()
    }
    assert got.keys() == expected.keys()
    assert all(got[k] == pytest.approx(expected[k]) for k in got)


def test_lemmas(spark):
    lexicon = spark.createDataFrame([(w,) for w in "cat box man berry wolf glass bus".split()], "term string")
    words = "the cats boxes men berries wolves glasses glass buses foos".split()
    df = spark.createDataFrame([(1, words)], "doc int, w array<string>")
    got = [r["lemma"] for r in T.lemmatise(df, "doc", "w", lexicon).orderBy("position").collect()]
    assert got == "the cat box man berry wolf glass glass bus foos".split()


def test_gather_keeps_order_and_repeats(spark):
    words = [str(i % 7) for i in range(300)]
    df = spark.createDataFrame([(1, words)], "doc int, w array<string>").repartition(4)
    rows = T.positioned_tokens(df, "doc", "w").repartition(8)
    assert T.gather_tokens(rows, "doc", "term").first()["tokens"] == words


def test_top_terms_break_ties_by_term(spark):
    df = spark.createDataFrame([("x", ["b", "a", "c", "c"]), ("y", [])], "label string, w array<string>")
    got = [(r["term"], r["rank"]) for r in T.top_terms(df, "label", "w", 2).orderBy("rank").collect()]
    assert got == [("c", 1), ("a", 2)]


def test_joined_text_skips_nulls(spark):
    df = spark.createDataFrame([("a", None, "c")], "x string, y string, z string")
    assert df.select(T.join_text("x", "y", "z")).first()[0] == "a c"


def test_frequent_lookup_equals_join(spark, rows):
    from larkspur.operators.lookups import frequent_lookup

    used = spark.createDataFrame([(i, f"t{i % 40 % (1 + i % 13)}") for i in range(400)] + [(0, None)], "doc long, term string")
    lookup = used.filter("term is not null").groupBy("term").count().filter("term <> 't1'")
    for most in (0, 3, 8, 100):
        assert rows(frequent_lookup(used, lookup, "term", "count", most), "doc", "term", "count") == rows(used.join(lookup, "term"), "doc", "term", "count")


def test_documents_are_counted_once(spark, tmp_path):
    from larkspur.catalog.text_queries import lemma_counts

    docs = spark.createDataFrame([(i, "cats cat runs run " * (i + 1)) for i in range(6)], "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    for found in (T.tf_idf(docs, "doc_id", T.space_tokens("text")), lemma_counts(spark, str(tmp_path))):
        assert "Generate explode(filter" not in found._jdf.queryExecution().optimizedPlan().toString()  # the tokens of no text are taken apart again
    assert {(r["lemma"], r["n"], r["forms"]) for r in lemma_counts(spark, str(tmp_path)).collect()} == {("cat", 42, 2), ("run", 42, 2)}
