import zlib

import numpy as np
from pyspark.sql import functions as F

from revlens.llm import lang_id
from revlens.llm.queries import QUERIES


def test_held_out_accuracy(spark, sf_small):
    sf = sf_small.replace("0.001", "0.01")
    rows = QUERIES["op3_language"](spark, sf).collect()
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert len(rows) == len(docs)
    right = held = 0
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1
        if r.held_out:
            held += 1
            right += r.lang_pred == docs[r.doc_id].lang
    assert held > 200 and right / held > 0.98


def test_learning_sums_whole_texts(make_docs):
    model = lang_id.learn(make_docs([(1, "aba aba", "x"), (2, "abc", "y"), (3, None, "z"), (4, "q", None)]))
    assert model.languages == ["x", "y"] and np.allclose(model.likelihood.sum(0), 1)


def test_mixture_of_two_languages(make_docs):
    a, b = "the thing and then ", "les choses sont faites "
    model = lang_id.learn(make_docs([(1, a * 20, "en"), (2, b * 20, "fr")]))
    lang, score, parts = lang_id.infer(model, a * 30 + b * 10)
    assert lang == "en" and set(parts) == {"en", "fr"} and 0.5 < score < 0.85 and abs(sum(parts.values()) - 1) < 1e-6
    assert lang_id.infer(model, a * 30)[2].keys() == {"en"}


def test_edge_cases(make_docs):
    docs, made = lang_id.identify(make_docs([]))
    assert docs.select(made.alias("m")).collect() == []
    docs, made = lang_id.identify(make_docs([(i, "text", None) for i in range(8)]))
    assert {r.m.lang_pred for r in docs.select(made.alias("m")).collect()} == {"und"}
    rows = [(i, "the thing and then " * 5, "en") for i in range(12)] + [(100, None, "en"), (101, "", "en"), (102, "12 !!", "en"),
                                                                       (None, "the thing", None), (103, "the " * 60_000, None), (0, "the thing and", "en")]
    docs = make_docs(rows).withColumns({"lang_pred": F.lit(1), "score": F.lit("s")})
    docs, made = lang_id.identify(docs)
    got = {r.doc_id: r.m for r in docs.select("doc_id", made.alias("m")).collect()}
    assert [got[i].lang_pred for i in (100, 101, 102)] == ["und"] * 3 and got[100].score == 0
    assert got[None].lang_pred == got[103].lang_pred == "en"
