import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from oracle_harness import compare
from revlens.operators import stats as S


def exact_quantile(n, p):
    k, term = 0, math.exp(-n)
    total = term
    while total < p:
        k += 1
        term *= n / k
        total += term
    return k


def test_quantile_is_at_most_one_off(spark):
    rnd = random.Random(1)
    rows = [(n, rnd.random()) for n in (33, 50, 100, 500) for _ in range(200)] + [(n, p) for n in (33, 700) for p in (1e-9, 0.02425, 0.5, 1 - 1e-9)]
    got = spark.createDataFrame(rows, "n long, p double").select("n", "p", S.poisson_quantile(F.col("n"), F.col("p")).alias("k")).collect()
    off = [abs(r.k - exact_quantile(r.n, r.p)) for r in got]
    assert max(off) <= 1 and np.mean(off) < 0.02


@pytest.mark.parametrize("n", [0, 1, 5, 32, 33, 1000, 10**9])
def test_draws_have_the_moments_of_poisson(spark, n):
    df = spark.range(4000).select(S.poisson(F.lit(n).cast("long"), F.concat(F.lit("t"), F.col("id").cast("string")), F.lit("k")).alias("w"))
    w = np.array([r.w for r in df.collect()], float)
    assert w.mean() == pytest.approx(n, abs=4 * math.sqrt(n / 4000) + 1e-9)
    assert w.var() == pytest.approx(n, rel=0.12, abs=1e-9)


def test_interval_is_that_of_drawing_rows(spark):
    rnd = random.Random(2)
    rows = [(i, int(rnd.random() < 0.8), int(rnd.random() < 0.7)) for i in range(400)]
    df = spark.createDataFrame(rows, "review_id long, y int, p int")
    got = {r.metric: r for r in S.bootstrap_ci(df, "y", "p").collect()}
    y, p = np.array([r[1] for r in rows]), np.array([r[2] for r in rows])
    rng, vals = np.random.default_rng(3), []
    for _ in range(4000):
        w = rng.poisson(1, len(y))
        tp, fn = w[(y == 0) & (p == 0)].sum(), w[(y == 0) & (p == 1)].sum()
        vals.append(tp / (tp + fn))
    assert got["recall_0"].point_estimate == pytest.approx(((y == 0) & (p == 0)).sum() / (y == 0).sum(), abs=1e-6)
    assert [got["recall_0"].ci_low, got["recall_0"].ci_high] == pytest.approx(list(np.quantile(vals, [0.025, 0.975])), abs=0.02)


def test_empty_and_null_rows(spark):
    df = spark.createDataFrame([(None, 1), (0, None)], "y int, p int")
    assert [r.point_estimate for r in S.bootstrap_ci(df, "y", "p", replicates=5).collect()] in ([], [0.0] * 3)


@pytest.mark.parametrize("name", ["bootstrap_ci", "paired_bootstrap", "evaluation_report"])
def test_queries_equal_sql(spark, sf_small, name):
    r = compare(spark, E.queries()[name], E.oracle_sql()[name], sf_small)
    assert r["cols_match"] and r["hash_match"], r
