"""Inputs of the fits are made once, and what is summed for them takes one pass."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

import __spark_entry__ as E
from revlens.functions import constants as K
from revlens.functions import lexicon as L
from revlens.operators import calibration as C
from revlens.operators import features as FE
from revlens.operators import lowrank
from revlens.operators import order_stats as O
from revlens.operators import textvec as V


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_lexicon_scores_take_one_fold(spark, sf_small):
    assert optimized(E.queries()["lexicon_scores"](spark, sf_small)).count("aggregate(") == 1
    pool = [w for w, _ in (*K.LEXICON[:12], *K.INTENSIFIERS[:4], *K.DIMINISHERS[:4])] + K.LEXICON_NEGATION_CUES[:6] + ["hardly", "but", "yet", ".", "!", "card"]
    rng = np.random.default_rng(5)
    texts = [" ".join(rng.choice(pool, rng.integers(1, 25))) for _ in range(150)] + ["", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string").coalesce(1)
    t = F.col("t")
    got = df.select(L.score_record(t).alias("s"), L.raw_score(t).alias("raw"), L.negated_score(t).alias("neg"),
                    L.intensified_score(t).alias("int"), L.contrast_score(t).alias("con")).collect()
    assert [tuple(r.s) for r in got] == [(r.raw, r.neg, r.int, r.con) for r in got]
    assert len({tuple(r.s) for r in got}) > 50


def test_fit_frames_are_stored(spark, sf_small):
    from revlens.plans import q_models as Q
    for df in (Q.vectors(spark, sf_small), Q.issue_vectors(spark, sf_small, 64)):
        plan = optimized(df)
        assert "md5" not in plan and "Join" not in plan and "Generate" not in plan
    kept, every = Q.issue_vectors(spark, sf_small, 64), Q.issue_vectors(spark, sf_small, 64, strong=False)
    assert kept.count() == Q.vectors(spark, sf_small, 64).count() < every.count()


def test_chi2_terms_with_repeated_ids_and_a_vocabulary_above_the_cap(spark, monkeypatch):
    from revlens.plans import q_models as Q
    rng = np.random.default_rng(2)
    rows = [(str(i % 50), " ".join(rng.choice(list("abcdefgh"), 4, p=[.3, .2, .1, .1, .1, .1, .05, .05])), float(rng.random() < .4)) for i in range(70)]
    df = spark.createDataFrame(rows, "review_id string, clean_text string, label double").withColumn("tokens", F.split("clean_text", " "))
    w, _ = FE.tfidf(df.select(F.col("review_id").alias("doc_id"), "clean_text"), n_max=1)
    chi = FE.chi2_scores(w, df.select(F.col("review_id").alias("doc_id"), F.col("label").cast("int").alias("y")))
    want = [r["term"] for r in chi.orderBy(F.col("chi2").desc(), "term").limit(5).collect()]
    assert Q.chi2_terms(df, 5) == want
    monkeypatch.setattr(V, "MAX_FEATURES", 3)
    assert Q.chi2_terms(df, 5) == want


def test_term_table_counts_rows_and_occurrences(spark):
    df = spark.createDataFrame([(["a", "b", "a", "a"],), (["b"],), ([],), (None,), (["a", "c", "c"],)], "t array<string>")
    got = {r.term: (r.df, r.cf) for r in V.term_table(df, "t", min_df=1, max_df=1.0).collect()}
    assert got == {"a": (2, 4), "b": (2, 2), "c": (1, 2)}


def test_a_narrow_matrix_is_read_once(spark, monkeypatch):
    a = np.random.default_rng(1).random((40, 9)) * (np.random.default_rng(2).random((40, 9)) < 0.4)
    rows = spark.createDataFrame([(Vectors.dense(r),) for r in a], ["features"]).repartition(3)
    wide = lowrank._gram_pass(rows.select(*[c.alias(n) for c, n in zip(lowrank.B.sparse_entries("features"), ("idx", "val"))]), np.eye(9))
    assert wide == pytest.approx(a.T @ a)
    calls = []
    monkeypatch.setattr(lowrank, "_gram_pass", lambda *x: calls.append(x))
    assert lowrank.truncated_svd(rows, 9, 3, tol=1e-14, max_passes=200).values == pytest.approx(np.linalg.svd(a)[1][:3], rel=1e-6)
    assert not calls


def test_splits_and_folds_do_not_make_their_rows_again(spark):
    df = spark.range(300).select(F.col("id").cast("string").alias("k"), F.lit("x").alias("label"), (F.col("id") % 3 == 0).cast("int").alias("y"),
                                 (F.conv(F.substring(F.md5(F.col("id").cast("string")), 1, 8), 16, 10).cast("double")).alias("u"))
    split = O.exact_split(df, "u", "k", ["y"])
    assert "md5" not in optimized(split) and split.groupBy("split").count().count() == 3
    folds = C.with_folds(df.drop("u"), "k")
    assert "md5" not in optimized(folds)
    assert sorted(r["count"] for r in folds.groupBy("y", "fold").count().collect()) == [33, 33, 34, 66, 67, 67]


def test_sigmoid_of_one_margin(spark):
    a, b = C.sigmoid(spark.createDataFrame([(2.0, 1), (2.0, 0), (2.0, 0)], "m double, y int"), "m", "y")
    assert a == 0.0 and 1 / (1 + np.exp(-b)) == pytest.approx((2 / 3 + 2 * 0.25) / 3)


def test_characters_are_counted_as_their_arrays(spark, monkeypatch):
    """Grams counted in the tasks, in parts of any size, give the table of the exploded arrays."""
    from pyspark.sql import functions as F
    from revlens.operators import textvec as V
    texts = ["abcabcabc", "", "ab", None, "caf\u00e9 \U0001f600\U0001f600\U0001f600 x", "caf\u00e9 abc", "abc", "aaaaaaaa", "abc"]
    docs = spark.createDataFrame([(t,) for t in texts], "plain string").repartition(2)
    want = {tuple(r) for r in V.term_table(docs.select(V.char_ngrams(F.col("plain")).alias("t")), "t", max_df=1.0).collect()}
    assert want
    for held in (1 << 18, 2):
        monkeypatch.setattr(V, "HELD_TERMS", held)
        assert {tuple(r) for r in V.block_table(docs, "plain_char", {}, max_df=1.0).collect()} == want
