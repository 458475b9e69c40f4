import math
import random
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from oracle_harness import compare
from revlens.operators import order_stats as O


def frame(spark, values, groups=None):
    rows = [(g, v) for v, g in zip(values, groups or ["a"] * len(values))]
    return spark.createDataFrame(rows, "g string, v double").repartition(3)


def test_every_rank_of_awkward_values(spark, monkeypatch):
    rnd = random.Random(1)
    tiny = sys.float_info.min
    values = ([float("inf"), float("-inf"), 1.7976931348623157e308, -1.7976931348623157e308, 0.0, -0.0, 1e-300, 2e-300, tiny, -tiny, 5e-324, 1e300, -1e300, 1.0, math.nextafter(1.0, 2)] + [0.25] * 40
              + [10.0 ** rnd.randint(-300, 300) * rnd.choice((-1, 1)) for _ in range(60)])
    monkeypatch.setattr(O, "BUCKETS", 7)
    _, found = O.select_ranks(frame(spark, values), "v", lambda g, n: range(0, n, 4), ["g"])
    want = sorted(values)
    assert {k: v for (_, k), (v, _) in found.items()} == {k: want[k] for k in range(0, len(want), 4)}
    assert all(below == sum(x < v for x in values) for v, below in found.values())


def test_quantiles_are_numpys(spark):
    rnd = random.Random(2)
    values = [rnd.gauss(0, 1) for _ in range(501)] + [0.5] * 20
    groups = [rnd.choice("abc") for _ in values]
    got = O.quantiles(frame(spark, values, groups), "v", [0.0, 0.3, 0.5, 0.999, 1.0], ["g"])
    for g in "abc":
        own = [v for v, x in zip(values, groups) if x == g]
        assert np.allclose(got[(g,)], np.quantile(own, [0.0, 0.3, 0.5, 0.999, 1.0]), rtol=0, atol=1e-12)
    whole = O.quantiles(frame(spark, values), "v", [0.3])
    assert whole[()] == pytest.approx([np.quantile(values, 0.3)])


def test_nulls_empty_tables_and_limits(spark, monkeypatch):
    assert O.quantiles(frame(spark, [None, float("nan")]), "v", [0.5], ["g"]) == {}
    assert O.quantiles(frame(spark, []), "v", [0.5]) == {}
    assert O.quantiles(frame(spark, [None, 3.0]), "v", [0.0, 1.0]) == {(): [3.0, 3.0]}
    assert O.quantiles(frame(spark, [1.0, 2.0], [None, "a"]), "v", [0.5], ["g"]) == {(None,): [1.0], ("a",): [2.0]}
    with pytest.raises(ValueError):
        O.quantiles(frame(spark, [1.0]), "v", [1.5])
    monkeypatch.setattr(O, "MAX_SOUGHT", 2)
    with pytest.raises(ValueError):
        O.select_ranks(frame(spark, [1.0, 2.0, 3.0], ["a", "b", "c"]), "v", lambda g, n: [0], ["g"])


@pytest.mark.parametrize("ties", [False, True])
def test_splits_have_exact_sizes(spark, ties):
    rnd = random.Random(3)
    rows = [(f"r{i}", rnd.choice(("x", "x", "y", None)), rnd.choice((0.1, 0.2, 0.3)) if ties else rnd.random()) for i in range(200)]
    rows += [("one", "z", 0.5), ("null", "x", None)]
    df = spark.createDataFrame(rows, "id string, y string, u double").repartition(4)
    got = {r.id: r.split for r in O.exact_split(df, "u", "id", ["y"]).collect()}
    assert len(got) == len(rows) and got["null"] == "test" and got["one"] == "test"
    for y in ("x", "y", None, "z"):
        own = sorted((u, i) for i, c, u in rows if c == y and u is not None)
        a, b = O.split_sizes(len(own), (0.7, 0.8))
        for place, (_, i) in enumerate(own):
            assert got[i] == ("train" if place < a else "val" if place < b else "test")


def test_extreme_cuts(spark):
    df = spark.createDataFrame([(str(i), "x", i / 10) for i in range(10)], "id string, y string, u double")
    for cuts, n in (((0.0, 0.0), (0, 0, 10)), ((1.0, 1.0), (10, 0, 0)), ((0.0, 1.0), (0, 10, 0))):
        got = [r.split for r in O.exact_split(df, "u", "id", ["y"], cuts=cuts).collect()]
        assert tuple(got.count(s) for s in ("train", "val", "test")) == n


@pytest.mark.parametrize("name", ["exact_split_sizes", "hybrid_routing"])
def test_queries_equal_sql(spark, sf_small, name):
    r = compare(spark, E.queries()[name], E.oracle_sql()[name], sf_small)
    assert r["cols_match"] and r["hash_match"] and r["spark_rows"] > 0, r
