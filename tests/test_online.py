"""Averaged perceptron and SGD against plain loops over rows."""

import math

import numpy as np
import pytest
from pyspark.ml.linalg import SparseVector
from pyspark.sql import functions as F

from revlens.operators import online as O

WIDTH = 12


def rows(spark, n=300, seed=0, noise=0.0):
    rng = np.random.default_rng(seed)
    truth = rng.standard_normal(WIDTH)
    out = []
    for i in range(n):
        idx = sorted(rng.choice(WIDTH, 4, replace=False).tolist())
        x = rng.random(4) + 0.1
        y = float(truth[idx] @ x > 0) if rng.random() >= noise else float(rng.random() < 0.5)
        out.append((f"r{i}", y, SparseVector(WIDTH, idx, (x / np.linalg.norm(x)).tolist())))
    return spark.createDataFrame(out, ["review_id", "label", "features"])


def stored(df, shards):
    made = O.dealt(df, "review_id", "label", "features", shards, 42).collect()
    by = {}
    for r in sorted(made, key=lambda r: (r.shard, r.place)):
        x = np.zeros(WIDTH + 1)
        x[r.idx], x[-1] = r.val, 1.0
        by.setdefault(r.shard, []).append((r.y, r.weight, x))
    return list(by.values())


def plain_perceptron(shards, passes):
    w, history = np.zeros(WIDTH + 1), []
    for _ in range(passes):
        ends = []
        for rows_ in shards:
            v = w.copy()
            for y, c, x in rows_:
                s = 1 if y else -1
                if s * (v @ x) <= 0:
                    v = v + s * c * x
                history.append(v)
            ends.append(v)
        w = np.mean(ends, axis=0)
    return np.mean(history, axis=0)


def plain_sgd(shards, passes):
    w = np.zeros(WIDTH + 1)
    for e in range(passes):
        ends = []
        for rows_ in shards:
            v = w.copy()
            for i, (y, c, x) in enumerate(rows_):
                rate = 1 / (0.1 + 1e-4 * (e * len(rows_) + i))
                p = 1 / (1 + math.exp(-(v @ x)))
                v[:-1] *= 1 - rate * 1e-4
                v -= rate * c * (p - y) * x
            ends.append(v)
        w = np.mean(ends, axis=0)
    return w


@pytest.mark.parametrize("shards", [1, 5])
def test_equal_to_plain_loops(spark, shards):
    df = rows(spark, 120, noise=0.1)
    by = stored(df, shards)
    p = O.averaged_perceptron(df, WIDTH, max_passes=4, patience=99, shards=shards)
    assert p.weights == pytest.approx(plain_perceptron(by, 4), abs=1e-9)
    s = O.sgd_log_loss(df, WIDTH, max_passes=3, patience=99, shards=shards)
    assert s.weights == pytest.approx(plain_sgd(by, 3), abs=1e-9)


@pytest.mark.parametrize("fit", [O.averaged_perceptron, O.sgd_log_loss])
def test_any_partitioning_and_accuracy(spark, fit):
    df = rows(spark)
    one, many = (fit(df.repartition(p), WIDTH, shards=4, max_passes=15) for p in (1, 7))
    assert one.weights == pytest.approx(many.weights, abs=1e-9)
    right = df.where((one.score(df) > 0) == (F.col("label") == 1)).count()
    assert right >= 0.95 * 300


def test_stops_when_the_loss_stands(spark):
    df = rows(spark, 60, seed=2)
    assert len(O.sgd_log_loss(df, WIDTH, tol=10.0, patience=3).losses) == 4


def test_edge_rows(spark):
    df = rows(spark, 80)
    odd = df.unionByName(spark.createDataFrame([("n1", None, SparseVector(WIDTH, [0], [1.0])), ("n2", 1.0, None)], df.schema))
    assert O.averaged_perceptron(odd, WIDTH, 3).weights == pytest.approx(O.averaged_perceptron(df, WIDTH, 3).weights)
    zero = spark.createDataFrame([("z", 1.0, SparseVector(WIDTH, [], []))], df.schema)
    fitted = O.averaged_perceptron(df.unionByName(zero), WIDTH, 3)
    assert zero.select(fitted.score(zero)).first()[0] == pytest.approx(fitted.weights[-1])
    for bad in (df.limit(0), df.where("label = 1")):
        with pytest.raises(ValueError):
            O.averaged_perceptron(bad, WIDTH)


def test_one_deal_serves_both_models(spark, monkeypatch):
    df = rows(spark, 200, seed=3, noise=0.1)
    apart = [fit(df, WIDTH, 3, shards=4).weights for fit in (O.averaged_perceptron, O.sgd_log_loss)]
    made = O.deal(df, shards=4, entries=40)  # a few rows a record
    assert sum(made.sizes.values()) == 200 and made.packed.count() > 8
    monkeypatch.setattr(O, "dealt", lambda *a: pytest.fail("dealt once"))
    for fit, want in zip((O.averaged_perceptron, O.sgd_log_loss), apart):
        assert fit(made, WIDTH, 3).weights == pytest.approx(want, abs=1e-12)
