"""Contracts mirrored from the reference's own tests, on literal rows."""

from pyspark.sql import functions as F

from revlens.functions import rules as R
from revlens.functions import text as T
from revlens.operators import labels as LB
from revlens.operators import triage as TR


def test_natural_id_order(spark):
    df = spark.createDataFrame([(x,) for x in ["10", "2", "A-2", "1", "b-1", "3.0", " "]], "id string")
    n = df.select(T.normalize_id(F.col("id")).alias("id"))
    k = T.natural_id_key(F.col("id"))
    got = [r[0] for r in n.orderBy(*k).collect()]
    assert got == ["1", "2", "3", "10", "A-2", "b-1", ""]


def test_queue_priority_picks_2_and_4(spark):
    rows = [("1", "ok", "NEGATIVE", 0.20), ("2", "bad but late delivery", "NEEDS_ATTENTION", 0.49),
            ("3", "refund issue", "NEEDS_ATTENTION", 0.41), ("4", "support not helpful however solved late", "NEEDS_ATTENTION", 0.45)]
    df = spark.createDataFrame(rows, "id string, text string, label string, p double")
    pr = df.select("id", "p", R.queue_priority(T.clean_text(F.col("text")), F.col("label"), F.col("p")).alias("q"))
    top = pr.orderBy(F.col("q").desc(), F.col("p").asc(), F.col("id").asc()).limit(2)
    assert {r["id"] for r in top.collect()} == {"2", "4"}


def _labels(ids_labels):
    from revlens.functions.constants import ISSUE_LABELS
    return [(i, *[("1" if lb in s else "0") for lb in ISSUE_LABELS]) for i, s in ids_labels]


def _frame(spark, rows):
    from revlens.functions.constants import ISSUE_LABELS
    return spark.createDataFrame(_labels(rows), "id string, " + ", ".join(f"{lb} string" for lb in ISSUE_LABELS))


def test_validation_flags_duplicate_conflicts(spark):
    df = _frame(spark, [("1", {"delivery_shipping"}), ("1", {"other"}), ("2", {"customer_service"})])
    rules = {r["rule"]: r for r in LB.validation_rules(df, fail_on_conflicts=True).collect()}
    assert rules["conflicting_ids"]["n_bad"] == 1 and rules["conflicting_ids"]["severity"] == "fatal"
    assert not rules["conflicting_ids"]["passed"]


def test_validation_flags_strict_other(spark):
    df = _frame(spark, [("1", {"other", "delivery_shipping"}), ("2", {"customer_service"})])
    rules = {r["rule"]: r for r in LB.validation_rules(df, strict_other=True).collect()}
    assert rules["other_with_label"]["n_bad"] == 1 and rules["other_with_label"]["severity"] == "fatal"


def test_validate_raises_on_fatal_rules_and_missing_columns(spark):
    import pytest
    from pyspark.sql import functions as F
    good = _frame(spark, [("1", {"other"}), ("2", {"customer_service"})]).withColumns({"rating": F.lit("5"), "text": F.lit("t")})
    assert LB.validate(good).count() == 7
    for rows in ([("", {"other"})], [("1", set())]):
        bad = _frame(spark, rows).withColumns({"rating": F.lit("5"), "text": F.lit("t")})
        with pytest.raises(ValueError, match="validation failed"):
            LB.validate(bad)
    with pytest.raises(ValueError, match="missing columns"):
        LB.validate(good.drop("text", "other"))


def test_label_row_wins_and_the_corpus_fills_gaps(spark):
    rows = spark.createDataFrame([("1", "own", None), ("2", None, "4"), ("3", None, None)], "id string, text string, rating string")
    base = spark.createDataFrame([("1", "base", 1), ("2", "base", 2), ("2", "twin", 2)], "id string, text string, rating int")
    got = sorted((r.id, r.text, r.rating) for r in LB.joined_with_base(rows, base).collect())
    assert got[:3] == [("1", "own", 1.0), ("2", "base", 4.0), ("2", "twin", 4.0)] and got[3][:2] == ("3", "") and got[3][2] is None


def test_distribution_sums_to_total_and_queue_sorted(spark):
    rows = [("a", "NEGATIVE", 0.1, 402.0), ("b", "POSITIVE", 0.9, 104.5), ("c", "UNCERTAIN", None, 210.0),
            ("d", "NEEDS_ATTENTION", 0.45, 311.3)]
    df = spark.createDataFrame(rows, "review_id string, label string, probability double, risk_score double")
    dist = TR.label_distribution(df).collect()
    assert len(dist) == 4 and sum(r["count"] for r in dist) == 4
    q = [r["risk_score"] for r in TR.attention_queue(df).collect()]
    assert q == sorted(q, reverse=True) and len(q) == 3


def test_risk_score_values(spark):
    df = spark.createDataFrame([("NEGATIVE", 0.2), ("UNCERTAIN", None), ("POSITIVE", 1.0)], "l string, p double")
    got = [r[0] for r in df.select(R.risk_score(F.col("l"), F.col("p"))).collect()]
    assert got == [416.0, 210.0, 105.0]


def test_prepend_manual_review(spark):
    batch = spark.createDataFrame([(f"b{i}", i) for i in range(100)], "id string, arrival long")
    manual = spark.createDataFrame([("m1", 5), ("m2", 7)], "id string, arrival long")
    out = [r["id"] for r in TR.prepend_manual(batch, manual, 80).collect()]
    assert len(out) == 80 and out[:2] == ["m2", "m1"] and out[2] == "b99"
