"""Bootstrap draws: one md5 weight a row and replicate."""

import hashlib

import pytest
from pyspark.sql import functions as F

from revlens.operators import draws as R
from revlens.operators import stats as S


def weight(rep, key):
    u = int(hashlib.md5(f"boot{rep}|{key}".encode()).hexdigest()[:8], 16) / 4294967296.0
    return next((k for k, c in enumerate(S.POISSON1_CDF) if u < c), len(S.POISSON1_CDF))


def test_hex_digits_draw_as_the_uniform(spark):
    df = spark.range(3000).select(F.substring(F.md5(F.col("id").cast("string")), 1, 8).alias("d"))
    df = df.union(spark.createDataFrame([("00000000",), ("5e2d58d7",), ("5e2d58d8",), ("5e2d58d9",), ("fffffffc",), ("fffffffd",), ("ffffffff",)], "d string"))
    x = F.conv("d", 16, 10).cast("bigint") / F.lit(4294967296.0)
    assert df.where(S.poisson1_hex(F.col("d")) != S.poisson1(x)).count() == 0


def test_every_row_is_drawn_in_every_replicate(spark):
    rows = [(f"r{i}", i % 2, i % 3 // 2, i % 5 // 3) for i in range(60)] + [("r0", 0, 0, 1), ("n", None, 0, 0), (None, 0, 0, 0)]
    df = spark.createDataFrame(rows, "review_id string, y int, a int, b int")
    got = {r["rep"]: r for r in S.replicate_counts(df, "y", "a", "b", replicates=7).collect()}
    assert sorted(got) == list(range(8))
    for rep, r in got.items():
        for s, at in (("a", 2), ("b", 3)):
            w = [(x[1], x[at], 1 if rep == 0 else weight(rep, x[0]) if x[0] is not None else None) for x in rows]
            for name, cell in (("tp0", (0, 0)), ("fp0", (1, 0)), ("fn0", (0, 1))):
                known = sum(v for y, p, v in w if (y, p) == cell and v is not None)
                free = sum(1 for y, p, v in w if (y, p) == cell and v is None)  # a null id: md5 of the replicate alone
                assert r[f"{name}_{s}"] == known + free * weight_of_null(rep)


def weight_of_null(rep):
    u = int(hashlib.md5(f"boot{rep}".encode()).hexdigest()[:8], 16) / 4294967296.0
    return next((k for k, c in enumerate(S.POISSON1_CDF) if u < c), len(S.POISSON1_CDF))


def test_intervals_agree_whether_counts_are_shared(spark):
    df = spark.createDataFrame([(i, i % 2, i % 3 // 2, i % 7 // 4) for i in range(90)], "review_id long, y int, a int, b int")
    counts = S.replicate_counts(df, "y", "a", "b", replicates=20)
    one = [tuple(r) for r in S.bootstrap_ci(df, "y", "a", replicates=20).orderBy("metric").collect()]
    assert one == [tuple(r) for r in S.bootstrap_ci(df, "y", "a", counts=counts).orderBy("metric").collect()]
    assert one[0][1] == pytest.approx(one[0][1]) and all(r[2] <= r[1] <= r[3] for r in one)


def test_draws_are_md5_for_ids_of_any_length():
    ids = [b"", "\u00e9\U0001f600".encode() * 9, *[bytes([97 + n % 26]) * n for n in (1, 7, 45, 46, 47, 50, 51, 55, 56, 63, 64, 120, 300)]]
    reps, seen = [1, 9, 10, 57, 100, 999, 1000, 12345], set()
    for rows, made in R.first_words(ids, b"boot", reps):
        for rep, words in made:
            for i, w in zip(rows, words, strict=True):
                assert int(w) == int(hashlib.md5(b"boot%d|" % rep + ids[i]).hexdigest()[:8], 16)
                seen.add((rep, int(i)))
    assert len(seen) == len(reps) * len(ids)


def test_rows_are_not_exploded_by_replicate(spark):
    """Rows are dealt to all cores and counted where they are: no row a replicate."""
    df = spark.createDataFrame([("r", 0, 0, 1)], "review_id string, y int, a int, b int").coalesce(1)
    plan = S.replicate_counts(df, "y", "a", "b")._jdf.queryExecution().executedPlan().toString()
    assert "explode" not in plan and "RoundRobinPartitioning" in plan
