"""Registered queries next to their SQL, and the queries without SQL next to plain Python."""

import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from check_oracles import compare, connect
from tokenizers import Tokenizer

from larkspur.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents():
    return connect(FOLDER).execute("SELECT doc_id, text, lang FROM documents ORDER BY doc_id").fetchall()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, name):
    problem, rows = compare(QUERIES[name](spark, FOLDER), connect(FOLDER), ORACLES[name])
    assert problem is None, problem
    assert rows


def numbers(ids):
    return np.array(ids, "<u4").tobytes()


def test_token_files(spark, documents):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    found = {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in QUERIES["op10_token_files"](spark, FOLDER).collect()}
    start = 0
    for doc_id, text, _ in documents:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        assert found.pop(doc_id) == (start, len(ids), zlib.crc32(numbers(ids)))
        start += len(ids)
    assert not found


def test_sentence_pieces(spark, documents):
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    found = {r["doc_id"]: tuple(r)[1:] for r in QUERIES["op9_sentence_pieces"](spark, FOLDER).collect()}
    for doc_id, text, _ in documents:
        ids = model.encode(text or "", add_bos=True, add_eos=True)
        digests = hashlib.sha256(numbers(ids)).hexdigest(), hashlib.sha256(model.decode(ids).encode()).hexdigest()
        assert found.pop(doc_id) == (len(ids), *digests)
    assert not found


def test_packing(spark, documents):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows = QUERIES["op7_packing"](spark, FOLDER).collect()
    by_place = {(r["doc_id"], r["piece"]): r for r in rows}
    for doc_id, text, _ in documents:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        for piece, start in enumerate(range(0, len(ids), 4096)):
            part = ids[start : start + 4096]
            row = by_place.pop((doc_id, piece))
            assert (row["start"], row["length"], row["ids_crc32"]) == (start, len(part), zlib.crc32(numbers(part)))
    assert not by_place
    at = {}
    for row in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert row["offset"] == at.get(row["sequence_id"], 0)
        at[row["sequence_id"]] = row["offset"] + row["length"]
    assert max(at.values()) <= 4096
    assert len(at) == -(-sum(r["length"] for r in rows) // 4096)


def test_language_accuracy(spark, documents):
    rows = QUERIES["op4_language_id"](spark, FOLDER).collect()
    lang = {doc_id: name for doc_id, _, name in documents}
    assert {r["doc_id"] for r in rows} == set(lang)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) >= 0.98 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_nearest(spark):
    folder = "/root/testdata/sf0.1"
    data = connect(folder).execute("SELECT vec_id, embedding FROM embeddings ORDER BY vec_id").fetchall()
    ids, points = np.array([r[0] for r in data]), np.array([r[1] for r in data], "f8")
    answers = {}
    for row in QUERIES["op8_nearest"](spark, folder).collect():
        answers.setdefault(row["query_id"], []).append((row["rank"], row["vec_id"], row["score"]))
    assert set(answers) == {i for i in ids.tolist() if i % 100 == 0}
    hits = 0
    for query, rows in answers.items():
        rows.sort()
        far = np.sqrt(((points - points[ids == query]) ** 2).sum(1))
        assert [r[0] for r in rows] == list(range(1, 11))
        assert [r[2] for r in rows] == [far[ids == v][0] for _, v, _ in rows]
        far[ids == query] = np.inf
        hits += len({v for _, v, _ in rows} & set(ids[np.lexsort((ids, far))[:10]].tolist()))
    assert hits >= 0.97 * 10 * len(answers)
