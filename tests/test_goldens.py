"""Golden input → output pairs published with the reference's results."""

import pytest
from pyspark.sql import functions as F

from revlens.functions import lexicon as L
from revlens.functions import text as T
from revlens.operators import stats as S

NEGATION = [("not bad at all", "not NOT_bad NOT_at NOT_all"),
            ("good but not great", "good but not NOT_great"),
            ("can't recommend", "can t NOT_recommend"),
            ("not good, not bad", "not NOT_good not NOT_bad")]
ABBREV = [("idk about this card", "i do not know about this card"),
          ("redeemed w/ ease", "redeemed w ease"),
          ("arrived w/o code", "arrived witho code"),
          ("u r gr8 but late", "you r great but late")]


def _one(spark, rows, expr):
    df = spark.createDataFrame([(x,) for x, _ in rows], "t string")
    return [r[0] for r in df.select(expr(F.col("t"))).collect()]


def test_negation_goldens(spark):
    assert _one(spark, NEGATION, lambda c: T.clean_text(c, negation=True)) == [y for _, y in NEGATION]


def test_abbreviation_goldens(spark):
    assert _one(spark, ABBREV, lambda c: T.clean_text(c, abbrev=True)) == [y for _, y in ABBREV]


@pytest.mark.parametrize("n01,n10,chi2,p", [(497, 477, 0.370637, 0.542657), (442, 500, 3.449045, 0.063288)])
def test_mcnemar_goldens(spark, n01, n10, chi2, p):
    c = spark.createDataFrame([(n01, n10)], "n01 long, n10 long")
    r = S.mcnemar_from_counts(c).first()
    assert r["chi2_cc"] == pytest.approx(chi2, abs=1e-6)
    assert r["p_value"] == pytest.approx(p, abs=2e-6)


def test_lexicon_sanity(spark):
    rows = ["not bad", "very good", "good but late delivery", "extremely bad", "slightly disappointed",
            "not bad at all", "hate it"]
    df = spark.createDataFrame([(x,) for x in rows], "t string")
    out = df.select(L.score_record(F.col("t")).alias("s")).collect()
    got = {t: r["s"] for t, r in zip(rows, out)}
    assert got["not bad"]["afinn_raw"] == -3 and got["not bad"]["afinn_negated"] == 3
    assert got["very good"]["afinn_intensified"] == pytest.approx(4.5)
    assert got["good but late delivery"]["afinn_contrast"] == pytest.approx(3 + 2 * -1)
    assert got["extremely bad"]["afinn_intensified"] == pytest.approx(-6.0)
    assert got["slightly disappointed"]["afinn_intensified"] == pytest.approx(-1.0)
    assert got["hate it"]["afinn_raw"] == -3
