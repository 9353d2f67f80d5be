"""Inputs that an operator must not mix up, drop, cap or crash on."""

import collections
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from gridsight.llm import ann, html_text, jaccard
from gridsight.llm.words import hashes

WORDS = [f"w{i}" for i in range(300)]


def prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def thue_morse(n, flip):
    return "".join("ab"[(bin(i).count("1") + flip) % 2] for i in range(n))


def test_words_of_opposite_structure_have_different_hashes():
    words = [thue_morse(1 << k, f) for k in range(4, 13) for f in (0, 1)] + ["a" * n for n in range(1, 40)] + ["abcdefgh" * n for n in range(2, 9)]
    data = np.frombuffer("".join(words).encode(), np.uint8)
    ends = np.cumsum([len(w) for w in words])
    got = hashes(data, ends - [len(w) for w in words], ends)
    assert len(set(got.tolist())) == len(set(words))
    again = np.frombuffer(("x" + words[3] + "yz").encode(), np.uint8)  # the place does not matter, nor what follows
    assert hashes(again, np.array([1]), np.array([1 + len(words[3])]))[0] == got[3]


def test_near_duplicates_of_opposite_words(spark):
    rows = [(1, thue_morse(1024, 0)), (2, thue_morse(1024, 1)), (3, thue_morse(1024, 0))]
    got = jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted(tuple(r) for r in got) == [(1, 1, 1), (2, 1, 2), (3, 1, 1)]


def test_deep_menus_stay_menus():
    article = "<article><p>The first paragraph of the article, which is long enough, has commas, and says something.</p></article>"
    for depth in (10, 600, 5000):
        page = "<body>" + "<div>" * depth + "<nav><ul><li>Menu entry one, with commas, and many words in it to look like text</li></ul></nav>" + article + "</div>" * depth + "</body>"
        assert html_text.main_text(page) == "The first paragraph of the article, which is long enough, has commas, and says something."
    page = "<nav>" + "<div>" * 3000 + "Menu, menu, and more menu" + "</div>" * 3000 + "</nav>" + article
    assert "Menu" not in html_text.main_text(page)


@pytest.mark.parametrize("page", ["<div>" * 20000 + "</p>" * 20000, "<div>" * 20000 + "<li>x" * 20000, "<td>" * 20000 + "</h2>x" * 20000])
def test_deep_pages_take_linear_time(page):
    import time
    start = time.process_time()
    html_text.main_text(page)
    assert time.process_time() - start < 3


@pytest.mark.parametrize("size", [1e200, 1e-200, 1e307])
def test_vectors_of_extreme_length(spark, size):
    rng = np.random.default_rng(4)
    v = rng.normal(size=(30, 6)) * size
    rows = [(i, x.tolist()) for i, x in enumerate(v)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = ann.nearest(df, df.where("vec_id % 10 = 0"), k=5).collect()
    with np.errstate(over="ignore", invalid="ignore"):
        want = []
        for q in (0, 10, 20):
            s = np.zeros(30)
            for i in range(6):
                s += v[q, i] * v[:, i]
            s = np.where(np.isnan(s), -np.inf, s)
            order = sorted((j for j in range(30) if j != q), key=lambda j: (-s[j], j))[:5]
            want += [(q, k + 1, j, s[j]) for k, j in enumerate(order)]
    assert sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got) == want


NAMES = "_id string, _bit int, spans string, email int, ip string, card int, phone string, row string, number int, place int, class string, _number int"


def odd_documents(spark, rows):
    return spark.createDataFrame(
        [(i, t, "en", "s", None if t is None else len(t), "i", 1, "s", 2, "i", 3, "p", "r", 5, 6, "c", 7) for i, t in rows],
        "doc_id bigint, text string, lang string, source string, n_chars bigint, " + NAMES)


def tables(spark, path, rows, toxic=()):
    odd_documents(spark, rows).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i in toxic)) for i, _ in rows if i is not None][:20], "doc_id bigint, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, "a b c d e f g h i j k l")], "item_id bigint, text string").write.parquet(f"{path}/benchmark.parquet")
    return spark.read.parquet(f"{path}/documents.parquet")


@pytest.fixture(scope="module")
def clashing(spark, tmp_path_factory):
    rng = random.Random(1)
    a, b, c, d, e = (prose(rng, 60) for _ in range(5))
    rows = [(1, a), (2, a), (2, b), (3, c), (3, d), (3, d), (4, None), (4, e), (5, e + " tail"), (None, a), (6, "call +1 234 567 8900 or a@b.example.com"), (7, None), (7, None), (8, "x a b c d e f g h i j k l y")]
    path = str(tmp_path_factory.mktemp("clashing"))
    return path, tables(spark, path, rows), (a, b, c, d, e)


def stage(spark, name, docs, path):
    out = dict(corpus_pipeline.STAGES)[name](spark, docs, path)
    assert out.columns == docs.columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
    return collections.Counter((r["doc_id"], r["text"]) for r in out.collect())


def test_doc_ids_on_several_texts_lose_no_text(spark, clashing):
    path, docs, (a, b, c, d, e) = clashing
    got = stage(spark, "near_duplicates", docs, path)
    assert got == collections.Counter({(1, a): 1, (2, b): 1, (3, c): 1, (3, d): 1, (4, None): 1, (4, e): 1, (None, a): 1, (6, docs.where("doc_id = 6").first()["text"]): 1, (7, None): 1, (8, "x a b c d e f g h i j k l y"): 1})


def test_stages_with_columns_of_any_name(spark, clashing):
    path, docs, _ = clashing
    before = collections.Counter((r["doc_id"], r["text"]) for r in docs.collect())
    assert stage(spark, "toxicity", docs, path) == before
    assert before - stage(spark, "decontamination", docs, path) == collections.Counter({(8, "x a b c d e f g h i j k l y"): 1})
    got = dict(corpus_pipeline.STAGES)["redaction"](spark, docs, path)
    assert got.columns == docs.columns
    row = got.where("doc_id = 6").first()
    assert row["text"] == "call [PHONE] or [EMAIL]" and row["n_chars"] == 23 and row["row"] == "r" and row["email"] == 2
    assert got.count() == docs.count()


def test_stages_on_an_empty_table(spark, tmp_path):
    docs = tables(spark, str(tmp_path), [(1, "x")]).limit(0)
    for name, fn in corpus_pipeline.STAGES:
        assert fn(spark, docs, str(tmp_path)).count() == 0, name


def test_toxic_documents_go_and_clean_ones_stay(spark, tmp_path):
    rng = random.Random(12)
    rows, bad = [], set()
    for i in range(300):
        words = prose(rng, 50).split()
        if i % 6 == 0:
            words.insert(7, rng.choice(["zonkhead", "blarghface"]))
            bad.add(i)
        rows.append((i, " ".join(words)))
    docs = tables(spark, str(tmp_path), rows)
    labels = spark.createDataFrame([(i, 1, int(i in bad)) for i, _ in rows], "doc_id bigint, quality int, toxic int")
    labels.write.mode("overwrite").parquet(f"{tmp_path}/labels.parquet")
    left = {i for i, _ in stage(spark, "toxicity", docs, str(tmp_path))}
    assert len(bad & left) <= 5 and len(left) >= 300 - len(bad) - 3
