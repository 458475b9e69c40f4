"""Out-of-fold calibration: folds, Platt's fit and isotonic steps by hand."""

import numpy as np
import pytest
from pyspark.ml.linalg import DenseVector
from pyspark.sql import functions as F

import __spark_entry__ as E
from oracle_harness import compare
from revlens.operators import calibration as C


def rows(spark, n=240, seed=0, share=0.4, label="a"):
    rng = np.random.default_rng(seed)
    out = []
    for i in range(n):
        y = int(rng.random() < share)
        out.append((f"r{i}", label, y, DenseVector(rng.standard_normal(2) + y)))
    return spark.createDataFrame(out, ["review_id", "label", "y", "features"])


def sizes(df):
    return {(r.label, r.y, r.fold): r["count"] for r in df.groupBy("label", "y", "fold").count().collect()}


def test_folds_are_stratified_and_follow_the_smaller_class(spark):
    made = [(f"r{i}", lb, int(i < ones)) for lb, ones in (("many", 14), ("two", 2), ("one", 1), ("none", 0)) for i in range(40)]
    df = spark.createDataFrame(made + [("x", "many", None), ("y", None, 1)], "review_id string, label string, y int")
    got = C.with_folds(df, "review_id")
    n = sizes(got)
    assert got.count() == 160
    assert sorted(n[("many", 1, k)] for k in range(3)) == [4, 5, 5] and sorted(n[("many", 0, k)] for k in range(3)) == [8, 9, 9]
    assert n[("two", 1, 0)] == n[("two", 1, 1)] == 1 and ("two", 0, 2) not in n
    assert n[("one", 1, None)] == 1 and n[("none", 0, None)] == 40
    assert C.with_folds(df.limit(0), "review_id").count() == 0
    again = C.with_folds(df.repartition(6), "review_id")
    assert sorted(map(str, again.collect())) == sorted(map(str, got.collect()))


def test_sigmoid_is_platts_fit(spark):
    rng = np.random.default_rng(3)
    y = (rng.random(200) < 0.3).astype(int)
    m = rng.standard_normal(200) * 2 + 3 * y
    a, b = C.sigmoid(spark.createDataFrame([(float(x), int(t)) for x, t in zip(m, y)], "m double, y int"), "m", "y")
    n1 = y.sum()
    t = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (200 - n1 + 2))
    w = np.zeros(2)
    x = np.stack([m, np.ones(200)], axis=1)
    for _ in range(50):  # Newton steps
        p = 1 / (1 + np.exp(-x @ w))
        w += np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x, x.T @ (t - p))
    assert (a, b) == pytest.approx(tuple(w), abs=1e-3)


def test_mean_of_folds(spark):
    df = C.with_folds(rows(spark), "review_id").checkpoint()
    fitted = C.fit(df)
    assert fitted.note == "calibrated;cv=3"
    got = fitted.transform(df.select("review_id", "features", "y", "fold")).collect()
    margin = np.array([[m.coefficients.dot(r.features) + m.intercept for m in fitted.models] for r in got])
    want = np.mean([1 / (1 + np.exp(-(a * margin[:, i] + b))) for i, (a, b) in enumerate(fitted.calibrators["sigmoid"])], axis=0)
    assert [r.p_sigmoid for r in got] == pytest.approx(want)
    assert [r.p_raw for r in got] == pytest.approx((1 / (1 + np.exp(-margin))).mean(axis=1))
    assert all(0 <= r.p_isotonic <= 1 for r in got)
    # A fold's model never saw the fold: it is the fit of the other rows.
    other = C.LogisticRegression(labelCol="y", maxIter=30, regParam=1e-3).fit(df.where("fold != 1"))
    assert other.coefficients.toArray() == pytest.approx(fitted.models[1].coefficients.toArray(), abs=1e-9)


def test_labels_that_cannot_be_calibrated(spark):
    few = C.with_folds(rows(spark, 30).where("y = 0").unionByName(rows(spark, 90, 1).where("y = 1").limit(1)), "review_id")
    assert C.fit(few).note == "trained;cv=0"
    same = C.fit(few).transform(few).where("p_raw <> p_sigmoid or p_raw <> p_isotonic")
    assert same.count() == 0
    one = C.with_folds(rows(spark, 30).where("y = 0"), "review_id")
    assert C.fit(one).note == "constant" and C.fit(one).transform(one).agg(F.max("p_sigmoid")).first()[0] == 0.0
    assert C.fit(one.limit(0)).constant == 0.0


def test_fold_twin(spark, sf_small):
    got = compare(spark, E.queries()["calibration_folds"], E.oracle_sql()["calibration_folds"], sf_small)
    assert got["cols_match"] and got["hash_match"] and got["spark_rows"], got
