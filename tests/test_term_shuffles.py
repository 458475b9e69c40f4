"""Term features: texts are shuffled, not their term rows; fits read what they counted once."""

from collections import Counter

from revlens.operators import features as FE


def test_terms_are_counted_where_a_document_lies(spark):
    docs = spark.createDataFrame([(1, "a b a"), (2, "b"), (1, "b c"), (None, "a"), (None, "a"), (3, ""), (4, None)], "doc_id long, clean_text string")
    tf = FE.term_counts(docs)
    plan = tf._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "hashpartitioning(doc_id" in plan and ", term" not in plan.split("Exchange", 1)[1].split("\n")[0]
    want = Counter()
    for i, t in ((1, "a b a"), (2, "b"), (1, "b c"), (None, "a"), (None, "a")):
        w = t.split()
        want.update((i, x) for x in w + [" ".join(p) for p in zip(w, w[1:])])
    assert {(r["doc_id"], r["term"]): r["tf"] for r in tf.collect()} == dict(want)


def test_prediction_meets_the_model_in_one_join(spark):
    rows = [(1, "good nice", 1), (2, "bad poor", 0), (3, "good good", 1), (4, "bad", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, clean_text string, y int")
    logp, classes = FE.naive_bayes_fit(FE.term_counts(docs, n_max=1), docs)
    new = spark.createDataFrame([(10, "good unseen"), (11, "poor bad"), (12, "unseen")], "doc_id long, clean_text string")
    out = FE.naive_bayes_predict(FE.term_counts(new, n_max=1), logp, classes)
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Join Inner, (term") == 1
    assert {r["doc_id"]: r["pred"] for r in out.collect()} == {10: 1, 11: 0}
