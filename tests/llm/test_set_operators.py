"""Joins, scans, surrogates, vectors and languages on small fixtures, against brute force, with edge cases."""

import math
import re
import time
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from larkspur.llm import credentials, ngram_join, surrogates
from larkspur.llm.common import components
from larkspur.llm.language import fit_languages, with_language
from larkspur.llm.near_vectors import code_distance, code_tables, learn_rotation, near_vectors
from larkspur.llm.ngram_join import ngram_components
from larkspur.llm.shingles import shingle_sets
from larkspur.llm.small_world import Graph, build_graph, nearest, search_graph

DOCS = "doc_id long, text string, t string"
CLASH = ("h", "n", "token", "class", "rep", "base", "weak", "kind", "hit", "lang_pred", "score", "key", "component", "size")


def frame(spark, rows):
    """Documents with other columns named like the ones inside the operators."""
    return spark.createDataFrame([(i, t, "x") for i, t in rows], DOCS).select("doc_id", "text", *[F.col("t").alias(c) for c in CLASH])


def roots(nodes, links):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    draw = np.random.default_rng(5)
    chain = [(i, i + 1) for i in range(100, 160)]
    links = chain + [(1, x) for x in range(2, 60)] + [(7, 7)] + draw.integers(200, 400, (120, 2)).tolist()
    found = components(spark.createDataFrame(links, "a long, b long"))
    nodes = {n for a, b in links if a != b for n in (a, b)}
    expected = roots(nodes, [x for x in links if x[0] != x[1]])
    rows = found.collect()
    assert len(rows) == len(nodes) and {r["node"]: r["component"] for r in rows} == expected
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def plain_shingles(text, width=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def test_shingles():
    texts = ["A b c d e f", "a  B\tc\nd e F", None, "", "  ", "a b", "A B", "é É", "x" * 50_000, "a b c d e " * 2000, "\x00 a", "\x85a b\xa0c d e f"]
    for offset in (0, 3):
        sets = list(shingle_sets(pa.array(texts).slice(offset)))
        plain = [plain_shingles(t) for t in texts[offset:]]
        assert [len(s) for s in sets] == [len(p) for p in plain]
        for i, p in enumerate(plain):
            for j, q in enumerate(plain):
                assert len(np.intersect1d(sets[i], sets[j])) == len(p & q)


def near_copies(draw, words, base, n, changes):
    out = []
    for _ in range(n):
        copy = list(base)
        for at in draw.integers(0, len(copy), changes):
            copy[at] = words[draw.integers(len(words))]
        out.append(" ".join(copy))
    return out


@pytest.mark.parametrize("ordered, long_list, block", [(1_000_000, 64, 1024), (0, 64, 1024), (0, 3, 8), (1_000_000, 0, 1024)])
def test_ngram_join(spark, monkeypatch, ordered, long_list, block):
    monkeypatch.setattr(ngram_join, "_LONG_LIST", long_list)
    monkeypatch.setattr(ngram_join, "_BLOCK", block)
    draw = np.random.default_rng(11)
    words = [f"w{i}" for i in range(400)]
    passage = [words[i] for i in draw.integers(0, 400, 30)]
    texts = [" ".join(words[i] for i in draw.integers(0, 400, draw.integers(1, 80))) for _ in range(120)]
    texts += near_copies(draw, words, [words[i] for i in draw.integers(0, 400, 120)], 60, 3)  # a large group around the threshold
    texts += near_copies(draw, words, [words[i] for i in draw.integers(0, 400, 60)], 12, 1)
    texts += [" ".join(passage + [words[i] for i in draw.integers(0, 400, draw.integers(3, 60))]) for _ in range(60)]  # a passage that many share
    texts += [texts[3]] * 40 + ["a b", "A  B", "a b c", None, "", "  ", "x " * 30_000, "X " * 30_000]
    rows = list(enumerate(texts)) + [(None, texts[3]), (None, None), (7, texts[7]), (8, texts[200])]
    docs = frame(spark, rows).repartition(4)
    sets = [plain_shingles(t) for _, t in rows]
    links = [
        (rows[i][0], rows[j][0]) for i in range(len(rows)) for j in range(i) if rows[i][0] is not None and rows[j][0] is not None and sets[i] and sets[j]
        and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])
    ]
    expected = roots({i for i, _ in rows if i is not None}, links)
    found = ngram_components(docs, ordered=ordered).collect()
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found), key=repr) == sorted(
        ((i, len(s), expected.get(i)) for (i, _), s in zip(rows, sets)), key=repr
    )


def test_ngram_join_without_rows(spark):
    assert ngram_components(frame(spark, [])).count() == 0
    assert [tuple(r) for r in ngram_components(frame(spark, [(1, None), (2, "")])).orderBy("doc_id").collect()] == [(1, 0, 1), (2, 0, 2)]


KEY = "AKIA" + "Q7" * 8
OPAQUE = "aB3" * 8


def test_secrets(spark):
    far = "word " * 60
    texts = {
        1: f'é🎉 token = "{"z" * 6}" x', 2: "Password:abc secret = 12345", 3: f"{KEY} and {OPAQUE}", 4: f"{KEY} {far} {OPAQUE}", 5: OPAQUE,
        6: f"host http://a.example/x user=bob password: hunter22", 7: "see http://a.example/x and 10.0.0.1", 8: "0123456789abcdef" * 2 + "token=" + "ab" * 12,
        9: None, 10: "", 11: "AKIA123", 12: "token=secret=abcdefgh", 13: f"{OPAQUE}{far}user=bob {far}", 14: f"user=bob {'w ' * 60}{OPAQUE}",
    }
    rows = [*texts.items(), (None, texts[3]), (3, texts[3])]
    found = defaultdict(list)
    for row in credentials.find_secrets(frame(spark, rows)).collect():
        found[row["doc_id"]].append((["%s:%d:%d" % tuple(s) for s in row["base"]], ["%s:%d:%d" % tuple(s) for s in row["spans"]]))
    first = [f"access:0:20", "opaque:25:49"]
    assert found[3] == [(first[:1], first)] * 2 and found[None] == [(first[:1], first)]
    assert found[1] == [(["assign:3:18"], ["assign:3:18"])]
    assert found[2] == [([], [])] and found[9] == found[10] == found[11] == found[5] == found[7] == [([], [])]
    assert found[4] == [(["access:0:20"], ["access:0:20"])]
    assert found[6][0][1] == ["endpoint:5:23", "user:24:32", "assign:33:51"]
    assert found[8] == [(["hex:0:32", "assign:32:62", "hex:38:62"],) * 2]
    assert found[12] == [(["assign:0:21"],) * 2]
    assert found[13] == [([], [])]
    assert found[14] == [([], ["user:0:8", "opaque:129:153"])]
    assert credentials.find_secrets(frame(spark, [])).count() == 0


def luhn(number):
    return sum(d * 2 - 9 * (d > 4) if i % 2 else d for i, d in enumerate(map(int, reversed(number)))) % 10 == 0


def test_surrogates(spark):
    rows = [
        (1, "Write to Ann.Lee@mail.example.com or ann.lee@mail.example.com, call +1 (212) 555-0101 or +1 212.555.0101."), (2, "+1 (212) 555-0101 4111111111111111 end"),
        (3, "cards 4111 1111 1111 1111, 4111-1111-1111-1111 and 4111111111111112"), (4, "at 10.20.30.40 and 1.2.3.4.5 and 999.1.1.1"),
        (5, "Mr John Smith met MRS JANE DOE? Mr JOHN SMITH and Ms Jane Doe; Г-н Иванов"), (6, None), (7, ""), (8, "nothing 9.9. here, §2.1"),
        (None, "ANN.LEE@MAIL.EXAMPLE.COM"), (1, "Write to Ann.Lee@mail.example.com or ann.lee@mail.example.com, call +1 (212) 555-0101 or +1 212.555.0101."), (9, "078-05-1120"),
    ]
    out = surrogates.replace_entities(frame(spark, rows), "key")
    assert out.columns == ["doc_id", "text", *CLASH, "n_entities"]
    found = defaultdict(list)
    for row in out.collect():
        found[row["doc_id"]].append((row["text"], row["n_entities"]))
    assert len(found[1]) == 2 and found[1][0] == found[1][1]
    text, n = found[1][0]
    mail, same, phone, dotted = re.fullmatch(r"Write to (\S+) or (\S+), call (\+1 \(\d{3}\) \d{3}-\d{4}) or (\+1 \d{3}\.\d{3}\.\d{4})\.", text).groups()
    assert n == 4 and mail == same != "ann.lee@mail.example.com" and re.fullmatch(r"[a-z]{3}\.[a-z]{3}@[a-z]{4}\.[a-z]{7}\.com", mail)
    assert re.sub(r"\D", "", phone) == re.sub(r"\D", "", dotted) != "12125550101"
    assert found[None] == [(mail.upper(), 1)]
    (second, n2), = found[2]
    assert n2 == 2 and second.startswith(phone + " 4") and luhn(second.split()[-2]) and "4111111111111111" not in second
    (cards, n3), = found[3]
    one, two, kept = re.fullmatch(r"cards (\d{4} \d{4} \d{4} \d{4}), (\d{4}-\d{4}-\d{4}-\d{4}) and (\d{16})", cards).groups()
    assert n3 == 2 and one.replace(" ", "") == two.replace("-", "") == second.split()[-2] and kept == "4111111111111112"
    (addresses, n4), = found[4]
    assert n4 == 1 and re.fullmatch(r"at \d\d\.\d\d\.\d\d\.\d\d and 1\.2\.3\.4\.5 and 999\.1\.1\.1", addresses) and "10.20.30.40" not in addresses
    (names, n5), = found[5]
    man, loud, woman, other = re.fullmatch(r"Mr (\w+ \w+) met MRS JANE DOE\? Mr ([A-Z]+ [A-Z]+) and Ms (\w+ \w+); Г-н ([А-Я][а-я]{5})", names).groups()
    assert n5 == 4 and man.upper() == loud and man.split()[0] in surrogates.GIVEN["m"] and woman.split()[0] in surrogates.GIVEN["f"] and other != "Иванов"
    assert found[6] == [(None, 0)] and found[7] == [("", 0)] and found[8] == [("nothing 9.9. here, §2.1", 0)]
    assert re.fullmatch(r"\d{3}-\d{2}-\d{4}", found[9][0][0]) and found[9][0][0] != "078-05-1120"
    again = surrogates.replace_entities(frame(spark, rows).repartition(3), "key").filter("doc_id = 1").first()["text"]
    assert again == text != surrogates.replace_entities(frame(spark, rows), "other").filter("doc_id = 1").first()["text"]
    assert surrogates.replace_entities(frame(spark, []), "key").count() == 0


def test_surrogates_stay_distinct_in_a_full_format(spark):
    """All addresses with four one-digit octets of which two vary: hardly any value of the format is free."""
    values = [f"{a}.{b}.{c}.{d}" for a in range(1, 10) for b in range(1, 10) for c in range(1, 10) for d in range(1, 10)][:3000]
    entities = spark.createDataFrame([("ip", v) for v in values], "kind string, canonical string")
    found = surrogates.entity_surrogates(entities, "key", attempts=3).collect()
    new = [r["surrogate"] for r in found]
    assert len(found) == len(set(new)) == 3000 and not set(new) & set(values)
    assert all(re.fullmatch(r"\d\.\d\.\d\.\d|\[IP-[0-9a-f]{64}\]", v) for v in new)


def test_languages(spark):
    train = [(i, t, lang) for i, (t, lang) in enumerate([("the cat and the dog", "en"), ("le chat et le chien", "fr"), ("der hund und die katze", "de")] * 30)]
    docs = spark.createDataFrame([*train, (900, None, "en"), (901, "xx", None)], "doc_id long, text string, lang string")
    model = fit_languages(docs)
    assert model.languages == ("de", "en", "fr")
    rows = [(1, "THE dog"), (2, "chiens"), (3, "katzen"), (4, None), (5, ""), (6, "123 !?"), (7, "le " * 50_000), (None, "the"), (8, "日本"), (1, "THE dog")]
    found = defaultdict(list)
    out = with_language(frame(spark, rows), model)
    assert out.columns == ["doc_id", "text", *[c for c in CLASH if c not in ("lang_pred", "score")], "lang_pred", "score"]
    for row in out.collect():
        found[row["doc_id"]].append((row["lang_pred"], row["score"]))
    assert [found[i][0][0] for i in (1, 2, 3, 4, 5, 6, 7, None, 8)] == ["en", "fr", "de", "und", "und", "und", "fr", "en", "de"]
    assert found[4] == [("und", 0.0)] and found[1][0] == found[1][1] and found[8][0][1] == pytest.approx(1 / 3)
    assert all(0 <= s <= 1 for rows in found.values() for _, s in rows)
    nothing = fit_languages(docs.filter("lang is null"))
    assert {r["lang_pred"] for r in with_language(frame(spark, rows), nothing).collect()} == {"und"}
    assert with_language(frame(spark, []), model).count() == 0


def test_very_many_secrets_in_one_text(spark):
    """Time is linear in the matches of a text: 100,000 of them take seconds, and every span is right."""
    n, began = 100_000, time.time()
    df = spark.createDataFrame([(1, "token=abcdefgh " * n), (2, "x token=abcdefgh")], "doc_id long, text string")
    found = {r["doc_id"]: r["base"] for r in credentials.find_secrets(df).collect()}
    assert [(s["kind"], s["start"], s["end"]) for s in found[1]] == [("assign", 15 * i, 15 * i + 14) for i in range(n)]
    assert [(s["start"], s["end"]) for s in found[2]] == [(2, 16)]
    assert time.time() - began < 60


def plain_language(train, text, longest=5):
    """The scoring of the module in plain Python, on all labelled rows."""
    words = {lang: Counter(w for t, a in train if a == lang for w in re.findall(r"[^\W\d_]+", t.lower())) for lang in {a for _, a in train}}
    grams = {lang: {n: Counter() for n in range(1, longest + 1)} for lang in words}
    for lang, counts in words.items():
        for w, times in counts.items():
            for n in range(1, longest + 1):
                padded = f" {w} "
                for i in range(len(padded) - n + 1):
                    grams[lang][n][padded[i : i + n]] += times
    names = sorted(words)
    known = lambda counts, x: any(counts[a][x] for a in names)
    score = lambda counts, x: np.array([math.log10(counts[a][x] / sum(counts[a].values())) if counts[a][x] else -7.0 for a in names])
    total, told = np.zeros(len(names)), 0
    found = re.findall(r"[^\W\d_]+", (text or "").lower())
    for w in found:
        if known(words, w):
            total, told = total + score(words, w), told + 1
            continue
        for n in range(longest, 0, -1):
            of_length = {a: grams[a][n] for a in names}
            padded = f" {w} " if n > 1 else w
            hits = [score(of_length, padded[i : i + n]) for i in range(len(padded) - n + 1) if known(of_length, padded[i : i + n])]
            if hits:
                total, told = total + sum(hits) / len(hits), told + 1
                break
    if not found:
        return "und", 0.0
    mean = total / max(told, 1)
    best = int(np.argmax(mean))
    return names[best], float(1 / np.exp((mean - mean[best]) * np.log(10) * min(told, 8)).sum())


def test_languages_equal_brute_force(spark):
    draw = np.random.default_rng(12)
    letters = {"aa": "abcdef ", "bb": "cdefgh ", "cc": "aeiouxy ", "rare": "qvwz "}
    text = lambda lang, n: "".join(draw.choice(list(letters[lang]), n))
    train = [(text(lang, 60), lang) for lang in ("aa", "bb", "cc") for _ in range(40)] + [(text("rare", 60), "rare")]
    model = fit_languages(spark.createDataFrame([(i, t, a) for i, (t, a) in enumerate(train)], "doc_id long, text string, lang string"))
    rows = [(i, text(lang, n)) for i, (lang, n) in enumerate((a, n) for a in letters for n in (3, 20, 200))] + [(90, "mmm 77"), (91, "qv é"), (92, " ")]
    told = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in with_language(frame(spark, rows), model).collect()}
    for i, t in rows:
        name, score = plain_language(train, t)
        assert told[i][0] == name and told[i][1] == pytest.approx(score, abs=1e-9), t


def test_no_language_is_left_out(spark):
    """300 labels are all learned, and one with three rows beside one with 30,000 keeps its words."""
    name = lambda i: "".join(chr(97 + int(c)) for c in f"{i:03d}")
    many = [(i, f"{name(i % 300)}x {name(i % 300)}yy", f"l{i % 300:03d}") for i in range(900)]
    model = fit_languages(spark.createDataFrame(many, "doc_id long, text string, lang string"))
    assert len(model.languages) == 300
    told = with_language(frame(spark, [(i, f"{name(i)}yy") for i in range(300)]), model).collect()
    assert all(r["lang_pred"] == f"l{r['doc_id']:03d}" for r in told)
    common = spark.range(30_000).selectExpr("id AS doc_id", "concat_ws(' ', 'w' || translate(id, '0123456789', 'abcdefghij'), 'the') AS text", "'common' AS lang")
    rare = spark.createDataFrame([(50_000 + i, f"zq{x} common", "rare") for i, x in enumerate("klm")], "doc_id long, text string, lang string")
    model = fit_languages(common.unionByName(rare), fit_rows=2_000)
    assert {"zqk", "zql", "zqm"} <= set(model.rows)
    assert [r["lang_pred"] for r in with_language(frame(spark, [(1, "zql")]), model).collect()] == ["rare"]


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, lab, "x") for i, v, lab in rows], "vec_id long, embedding array<float>, label int, t string").select(
        "vec_id", "embedding", "label", *[F.col("t").alias(c) for c in ("id", "v", "c", "rep", "links", "shard", "block", "rank", "score", "n")]
    )


def brute_links(rows, threshold):
    good = [(i, np.array(v, "f4").astype("f8"), lab) for i, v, lab in rows if lab is not None and i is not None and usable(v)]
    links = set()
    for x, (i, v, lab) in enumerate(good):
        for j, w, other in good[:x]:
            if lab == other and i != j and v @ w / (np.linalg.norm(v) * np.linalg.norm(w)) >= threshold:
                links.add((i, j))
    return links


def usable(v, d=16):
    return v is not None and len(v) == d and all(x is not None and math.isfinite(x) for x in v) and any(v)


def made_vectors():
    draw = np.random.default_rng(2)
    rows = [(i, draw.normal(size=16).tolist(), int(i % 3)) for i in range(150)]
    centre = draw.normal(size=16)
    rows += [(200 + i, (centre + 0.03 * draw.normal(size=16)).tolist(), 1) for i in range(90)]  # a group of near copies
    rows += [(300 + i, rows[4][1], rows[4][2]) for i in range(40)] + [rows[4], rows[5]]  # exact copies, repeated rows
    bad = [None, [], [0.0] * 16, [float("nan")] + [1.0] * 15, [None] + [1.0] * 15, [float("inf")] + [1.0] * 15, [1.0] * 3]
    return rows + [(400 + i, v, 1) for i, v in enumerate(bad)] + [(500, rows[4][1], None), (None, rows[4][1], 1)]


@pytest.mark.parametrize("block", [1024, 16])
def test_near_vectors(spark, block):
    rows = made_vectors()
    links = brute_links(rows, 0.98)
    ids = {i for i, _, _ in rows}
    n = {i: len({x for pair in links if i in pair for x in pair} - {i}) for i in ids}
    expected = roots(ids - {None}, links)
    found = near_vectors(vectors(spark, rows).repartition(3), block=block).collect()
    assert {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in found} == {i: (n[i], expected.get(i), expected.get(i) == i and i is not None) for i in ids}
    assert len(found) == len(ids)


def test_near_vectors_finds_pairs_at_the_threshold(spark):
    draw = np.random.default_rng(7)
    one, other = (x / np.linalg.norm(x, axis=1, keepdims=True) for x in draw.normal(size=(2, 1_500, 64)))
    other -= (one * other).sum(1, keepdims=True) * one
    other /= np.linalg.norm(other, axis=1, keepdims=True)
    cosine = draw.uniform(0.9801, 0.985, size=(1_500, 1))
    vectors = np.concatenate([one, cosine * one + np.sqrt(1 - cosine**2) * other])
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>, label int")
    found = {r["vec_id"]: r for r in near_vectors(df).collect()}
    assert max(r["n_links"] for r in found.values()) == 1
    linked = sum(found[i]["n_links"] == 1 and found[i + 1_500]["component_id"] == i for i in range(1_500))
    assert linked >= 0.99 * 1_500


def test_near_vectors_without_rows(spark):
    assert near_vectors(vectors(spark, [])).count() == 0
    assert [tuple(r) for r in near_vectors(vectors(spark, [(1, None, 1)])).collect()] == [(1, 0, 1, True)]


def test_rotation_balances_the_bits():
    draw = np.random.default_rng(1)
    sample = draw.normal(size=(2000, 24)) * np.linspace(0.1, 3, 24)
    mean, projection = learn_rotation(sample)
    signs = (sample - mean) @ projection >= 0
    assert np.abs(signs.mean(axis=0) - 0.5).max() < 0.06
    tables = code_tables(64, 40_000, 0.98)
    assert len(tables) == 8 and sorted(sum(tables[:4], [])) == sorted(sum(tables[4:], [])) == list(range(64))


def test_tables_follow_the_rows():
    longest = [max(map(len, code_tables(64, classes, 0.98))) for classes in (100, 5_000, 60_000, 10**6, 10**9)]
    assert longest == [8, 16, 16, 22, 32]  # cuts of 64 bits at the logarithm of the classes
    flip = math.acos(0.98) / math.pi
    for classes in (100, 5_000, 10**6, 10**9):
        missed = math.prod(1 - (1 - flip) ** len(t) - len(t) * flip * (1 - flip) ** (len(t) - 1) for t in code_tables(64, classes, 0.98))
        assert missed <= 0.002
    assert 12 <= code_distance(64, 0.98) <= 20 and code_distance(3, 0.98) <= 3


def test_graph_recall_and_flat_form():
    draw = np.random.default_rng(7)
    points = np.concatenate([draw.normal(size=(20, 16))[draw.integers(0, 20, 1500)] + 0.05 * draw.normal(size=(1500, 16)), draw.normal(size=(500, 16))])
    graph = Graph.unpack(build_graph(points).pack())
    norms, hits = (points * points).sum(1), 0
    for query in points[::40]:
        best = np.argsort(((points - query) ** 2).sum(1), kind="stable")[:10]
        hits += len(set(best.tolist()) & set(search_graph(graph, query, 10, 96, norms)))
    assert hits >= 0.95 * 10 * len(points[::40])


def test_nearest(spark):
    rows = made_vectors()
    good = {i: np.array(v, "f4").astype("f8") for i, v, _ in rows if i is not None and usable(v)}
    found = defaultdict(dict)
    for r in nearest(vectors(spark, rows), F.col("id") % 10 == 0, k=5, shard_rows=70, block=7).collect():
        found[r["query_id"]][r["rank"]] = (r["vec_id"], r["score"])
    assert set(found) == {i for i in good if i % 10 == 0}
    hits = 0
    for query, answer in found.items():
        best = sorted((float(np.sqrt(((good[query] - v) ** 2).sum())), i) for i, v in good.items() if i != query)[:5]
        assert sorted(answer) == [1, 2, 3, 4, 5]
        assert [s for _, s in (answer[r] for r in range(1, 6))] == sorted(s for _, s in answer.values())
        assert all(s == float(np.sqrt(((good[query] - good[i]) ** 2).sum())) for i, s in answer.values())
        hits += len({i for _, i in best} & {i for i, _ in answer.values()})
    assert hits >= 0.95 * 5 * len(found)
    copies = found[300]  # among copies the smaller ids come first
    assert [copies[r] for r in range(1, 6)] == [(i, 0.0) for i in (4, 301, 302, 303, 304)]
    few = nearest(vectors(spark, rows[:3]), F.col("id") == 0, k=5).collect()
    assert len(few) == 2 and nearest(vectors(spark, []), F.col("id") == 0).count() == 0
