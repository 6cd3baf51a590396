import pytest

from larkspur import session
from larkspur.sources import readers as S


def test_corpus_rows_are_whole_files(spark, tmp_path):
    texts = {("train", "pos"): ["good\nfilm <br />", "fine"], ("train", "neg"): ["bad"], ("test", "pos"): ["ok"], ("test", "neg"): [" "]}
    for (split, kind), found in texts.items():
        folder = tmp_path / split / kind
        folder.mkdir(parents=True)
        for i, text in enumerate(found):
            (folder / f"{i}.txt").write_text(text)
        (folder / "ignored.csv").write_text("x")
    corpus = S.read_corpus(spark, str(tmp_path), ["train", "test"], {"pos": 1.0, "neg": 0.0})
    assert corpus.columns == ["file_path", "text_raw", "split", "sentiment", "label"]
    got = sorted((r["split"], r["sentiment"], r["label"], r["text_raw"]) for r in corpus.collect())
    assert got == sorted((s, k, 1.0 if k == "pos" else 0.0, t) for (s, k), found in texts.items() for t in found)
    assert corpus.filter("split = 'train'").first()["file_path"].endswith(".txt")


def test_missing_corpus_folder_is_an_error(spark, tmp_path):
    with pytest.raises(Exception):
        S.read_corpus(spark, str(tmp_path), ["nope"], {"pos": 1.0}).count()


def test_tsv_names_and_types(spark, tmp_path):
    (tmp_path / "a.tsv").write_text("ham\thello, you\nspam\t12\n")
    df = S.read_tsv(spark, str(tmp_path / "a.tsv"), ["label", "message"])
    assert df.dtypes == [("label", "string"), ("message", "string")]
    assert [tuple(r) for r in df.collect()] == [("ham", "hello, you"), ("spam", "12")]
    with pytest.raises(ValueError):
        S.read_tsv(spark, str(tmp_path / "a.tsv"), ["only"])


def test_csv_with_schema_and_inference(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a,b\n1,x\n2,\n")
    path = str(tmp_path / "a.csv")
    assert S.read_csv(spark, path, "a long, b string").dtypes == [("a", "bigint"), ("b", "string")]
    assert S.read_csv(spark, path).dtypes == [("a", "int"), ("b", "string")]
    assert S.read_csv(spark, path, "a long, b string").collect()[1]["b"] is None


def test_shared_folder_comes_from_the_session(spark):
    assert session.scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert session.scratch_path(spark, "x") != session.scratch_path(spark, "x")
