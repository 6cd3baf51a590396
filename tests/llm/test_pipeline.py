"""The pipeline's stages against plain versions on the smallest tables, and on odd documents."""

import re
from collections import defaultdict

import corpus_pipeline
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from larkspur.llm.common import staged

FOLDER = "/root/testdata/sf0.001"
ENTITY = re.compile(r"[\w.]+@[\w.]+\.com|\+1 \(\d{3}\) \d{3}-\d{4}|(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?![\d.])|(?<![\d.])\d{16}(?!\d)")


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) > 4 else {tuple(words)} - {()}


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    found = {"documents": docs}
    for name, stage in corpus_pipeline.STAGES:
        docs = found[name] = staged(stage(spark, docs, FOLDER), name)
    return found


def rows(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_languages_keep_clean_documents(steps):
    before, after = rows(steps["documents"]), rows(steps["language_id"])
    assert steps["language_id"].columns == steps["documents"].columns
    assert after == {i: r for i, r in before.items() if i in after}
    assert {i for i in before if i not in after} <= {i for i, r in before.items() if len(re.findall(r"[^\W\d_]+", r["text"] or "")) <= 1}


def test_one_of_each_group_stays(steps):
    before, after = rows(steps["language_id"]), rows(steps["near_duplicates"])
    sets = {i: shingles(r["text"]) for i, r in before.items()}
    group = {i: i for i in sets}
    ids = sorted(sets)
    for x, i in enumerate(ids):
        for j in ids[:x]:
            if sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                low, high = sorted((group[i], group[j]))
                group = {k: low if g == high else g for k, g in group.items()}
    assert after == {i: r for i, r in before.items() if group[i] == i}


def test_personal_data_is_replaced(steps):
    before, after = rows(steps["near_duplicates"]), rows(steps["personal_data"])
    assert set(before) == set(after) and steps["personal_data"].columns == steps["documents"].columns
    hidden = defaultdict(set)
    for i, row in after.items():
        old, new = before[i]["text"], row["text"]
        assert row["n_chars"] == len(new) and (row["lang"], row["source"]) == (before[i]["lang"], before[i]["source"])
        if not ENTITY.search(old):
            assert new == old
        for value, other in zip(ENTITY.findall(old), ENTITY.findall(new)):
            hidden[value].add(other)
    assert hidden and all(len(v) == 1 for v in hidden.values())
    assert sum(v == {k} for k, v in hidden.items()) == sum(len(k) == 16 and k.isdigit() and not luhn(k) for k in hidden)


def luhn(number):
    return sum(d * 2 - 9 * (d > 4) if i % 2 else d for i, d in enumerate(map(int, reversed(number)))) % 10 == 0


def test_everything_kept_is_packed(steps):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    sizes = defaultdict(int)
    for row in steps["packing"].collect():
        sizes[row["doc_id"]] += row["length"]
    assert sizes == {i: len(tokenizer.encode(r["text"], add_special_tokens=False).ids) + 1 for i, r in rows(steps["personal_data"]).items()}


def test_run_applies_all_stages(spark, steps):
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    out = corpus_pipeline.run(spark, FOLDER)
    assert sorted(map(tuple, out.select(columns).collect())) == sorted(map(tuple, steps["packing"].select(columns).collect()))


@pytest.mark.parametrize("empty", [False, True])
def test_odd_documents(spark, empty):
    rows = [
        (1, "the cat sat on the mat with the dog", "en", None, 1), (1, "the cat sat on the mat with the dog", "en", None, 1), (2, None, None, None, None), (3, "", "en", "s", 0),
        (None, "the dog and the cat went home", None, "s", 5), (4, "12 34 !!", "fr", "s", 8), (5, "le chat est sur la table avec le chien", "fr", "s", 8),
        (6, "mail me at a.b@c.example.com the dog the cat", "en", "s", 8), (7, "le chat " * 20_000, "fr", "s", 8), (5, "le chien est dans la maison", "fr", "s", 8),
    ]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    clash = [F.col("source").alias(c) for c in ("h", "row", "component_id", "score", "lang_pred", "length", "ids", "piece_", "n")]
    docs = spark.createDataFrame([] if empty else rows, schema).select("*", *clash, F.create_map(F.lit("a"), "n_chars").alias("unordered"))
    columns, kept = docs.columns, []
    for name, stage in corpus_pipeline.STAGES[:3]:
        docs = staged(stage(spark, docs, FOLDER), name)
        assert docs.columns == columns
        kept.append(sorted((r["doc_id"] for r in docs.collect()), key=repr))
    packed = corpus_pipeline.packing(spark, docs, FOLDER)
    if empty:
        assert kept == [[], [], []] and packed.count() == 0
        return
    assert kept == [[1, 1, 5, 5, 6, 7, None], [1, 5, 6, 7, None], [1, 5, 6, 7, None]]
    assert "a.b@c.example.com" not in docs.filter("doc_id = 6").first()["text"]
    assert sorted({r["doc_id"] for r in packed.collect()}, key=repr) == [1, 5, 6, 7, None]
