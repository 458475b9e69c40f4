"""Exact order statistics of a column, by group, without sorting it.

The k-th smallest value is found by histogram refinement: the values
between the current bounds are counted in ``BUCKETS`` buckets, cumulative
counts name the bucket that holds the rank, and the next round looks into
that bucket alone, between the smallest and the largest value found in it.
It ends when these are equal.  Buckets are of equal width in turn of the
value and of its logarithm, so values of very different magnitude need few
rounds too.  A round is one scan and one aggregate with map-side combine; at
most ``BUCKETS`` rows a sought rank are shuffled and one row of each comes to
the driver.

Groups are few (classes, models): there are ``MAX_SOUGHT`` sought ranks at
most, more are an error.  Null values and NaN are no part of any order.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructField, StructType

from ..session import stored

BUCKETS = 1024
MAX_SOUGHT = 10_000


def _narrow(df: DataFrame, key: Sequence[str], value: str) -> DataFrame:
    """The group and value columns alone."""
    v = F.col(value).cast("double")
    return df.select(F.struct(*[F.col(c) for c in key], F.lit(0).alias("_all")).alias("g"), v.alias("v")).where(v.isNotNull() & ~F.isnan(v))


def _scale(v: Column, round_no: int) -> Column:
    """A monotone scale: the value, or its signed logarithm every third round."""
    if round_no % 3 != 2:
        return v
    size = F.log(F.abs(v)) + F.lit(750.0)  # above 0 for every double
    return F.when(v > 0, size).when(v < 0, -size).otherwise(F.lit(0.0))


def select_ranks(df: DataFrame, value: str, ranks: Callable[[tuple, int], Sequence[int]],
                 by: Sequence[str] = (), is_stored: bool = False) -> tuple[dict, dict]:
    """({group: rows}, {(group, rank): (value, rows below it)}) for the 0-based
    ranks that ``ranks(group, rows)`` asks for; ranks outside are left out.
    ``is_stored``: ``df`` is a stored table, which every round may read."""
    rows = _narrow(df, by, value)
    rows = rows if is_stored else stored(rows)
    spark = df.sparkSession
    start = rows.groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    first = start.limit(MAX_SOUGHT + 1).collect()
    groups = {tuple(r["g"])[:-1]: r for r in first}
    sought = {(g, k): (r["lo"], r["hi"], 0) for g, r in groups.items() for k in set(ranks(g, r["n"])) if 0 <= k < r["n"]}
    if max(len(groups), len(sought)) > MAX_SOUGHT:
        raise ValueError(f"more than {MAX_SOUGHT} groups or ranks: order statistics are for few groups")
    if not sought:
        return {g: r["n"] for g, r in groups.items()}, {}
    names = list(sought)
    at = {g: groups[g]["g"] for g, _ in names}
    round_no = 0
    while any(lo < hi for lo, hi, _ in sought.values()):
        open_ = [(i, at[g], k, *sought[g, k]) for i, (g, k) in enumerate(names) if sought[g, k][0] < sought[g, k][1]]
        state = spark.createDataFrame(open_, _state_type(rows)).hint("broadcast")  # at most MAX_SOUGHT rows
        if round_no in (1, 2):  # later rounds read only what lies between open bounds
            open_rows = (rows["g"] == state["sg"]) & (F.col("v") >= F.col("lo")) & (F.col("v") <= F.col("hi"))
            rows = stored(rows.join(state, open_rows, "left_semi"))
        inside = rows.join(state, (rows["g"] == state["sg"]) & (F.col("v") >= F.col("lo")) & (F.col("v") <= F.col("hi")))
        x, lo, hi = (_scale(F.col(c), round_no) for c in ("v", "lo", "hi"))
        # Where the scale does not tell the bounds apart (or overflows), the smallest value goes alone.
        wide = (hi > lo) & (hi - lo < F.lit(float("inf")))
        bucket = F.when(wide, F.least(F.lit(BUCKETS - 1), F.floor((x - lo) / (hi - lo) * BUCKETS).cast("int"))).otherwise(
            (F.col("v") > F.col("lo")).cast("int"))
        cells = inside.groupBy("i", "k", "below", bucket.alias("b")).agg(
            F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
        upto = F.sum("n").over(Window.partitionBy("i").orderBy("b").rowsBetween(Window.unboundedPreceding, -1))
        placed = cells.withColumn("before", F.col("below") + F.coalesce(upto, F.lit(0)))
        for r in placed.where("k >= before AND k < before + n").select("i", "lo", "hi", "before").collect():
            sought[names[r["i"]]] = (r["lo"], r["hi"], r["before"])
        round_no += 1
    return {g: r["n"] for g, r in groups.items()}, {key: (lo, below) for key, (lo, _, below) in sought.items()}


def _state_type(rows: DataFrame) -> StructType:
    return StructType([StructField("i", IntegerType()), StructField("sg", rows.schema["g"].dataType), StructField("k", LongType()),
                       StructField("lo", DoubleType()), StructField("hi", DoubleType()), StructField("below", LongType())])


def quantiles(df: DataFrame, value: str, fractions: Sequence[float], by: Sequence[str] = ()) -> dict[tuple, list[float]]:
    """Exact quantiles by group, linear between the neighbouring order
    statistics (NumPy's and SQL's continuous definition)."""
    if any(not 0.0 <= q <= 1.0 for q in fractions):
        raise ValueError("a fraction is in [0, 1]")

    def ends(n: int, q: float) -> tuple[int, int, float]:
        h = (n - 1) * q
        low = min(math.floor(h), n - 1)
        return low, min(low + 1, n - 1), h - low

    sizes, found = select_ranks(df, value, lambda g, n: [k for q in fractions for k in ends(n, q)[:2]], by)
    out = {}
    for g, n in sizes.items():
        out[g] = []
        for q in fractions:
            low, high, part = ends(n, q)
            a, b = found[g, low][0], found[g, high][0]
            out[g].append(a + (b - a) * part)
    return out


def split_sizes(n: int, cuts: Sequence[float]) -> list[int]:
    """Rows before each cut of ``n`` rows (never more than n)."""
    return [min(n, math.floor(n * c + 1e-9)) for c in cuts]


def exact_split(df: DataFrame, draw: str, tie: str, by: Sequence[str], names: Sequence[str] = ("train", "val", "test"),
                cuts: Sequence[float] = (0.7, 0.8), sizes: Callable[[Mapping | tuple, int], Sequence[int]] | None = None, is_stored: bool = False) -> DataFrame:
    """SPL-2: split every group of ``by`` at exact row counts, in the order of
    (``draw``, ``tie``).  Cut values are order statistics of ``draw``; only
    rows that share a cut's value are ranked among themselves, by ``tie``
    (rows alike in both may go either way).  Rows with a null draw or null
    group go to the last split."""
    places = sizes or (lambda g, n: split_sizes(n, cuts))
    # The row at place m is the first after the cut; at m = n nothing is.
    df = df if is_stored else stored(df)  # the cuts and both parts of the result read it
    totals, found = select_ranks(df, draw, places, by, is_stored=True)
    spark = df.sparkSession
    table = []
    for g, n in totals.items():
        at = list(places(g, n))
        if sorted(at) != at or len(at) != len(names) - 1:
            raise ValueError(f"{len(names) - 1} ascending cuts are needed")
        table.append((*g, [float(found[g, m][0]) if m < n else math.inf for m in at],
                      [m - found[g, m][1] if m < n else 0 for m in at]))
    key_type = ", ".join(f"`_k{i}` {df.schema[c].dataType.simpleString()}" for i, c in enumerate(by))
    cut = spark.createDataFrame(table, f"{key_type}, _at array<double>, _ties array<long>").hint("broadcast")
    on = None
    for i, c in enumerate(by):
        same = df[c].eqNullSafe(cut[f"_k{i}"])
        on = same if on is None else on & same
    j = df.join(cut, on, "left")
    v = F.col(draw).cast("double")
    tied = F.array_contains("_at", v)
    rank = F.row_number().over(Window.partitionBy(*[F.col(f"_k{i}") for i in range(len(by))], v).orderBy(tie)) - 1
    columns = [F.col(c) for c in df.columns]

    def name(tie_rank):
        out = F.lit(names[-1])
        for i in reversed(range(len(names) - 1)):
            before = v < F.col("_at")[i]
            if tie_rank is not None:
                before = before | ((v == F.col("_at")[i]) & (tie_rank < F.col("_ties")[i]))
            out = F.when(before, names[i]).otherwise(out)
        return out

    free = j.where(~F.coalesce(tied, F.lit(False))).select(*columns, name(None).alias("split"))
    ranked = j.where(F.coalesce(tied, F.lit(False))).withColumn("_rank", rank)
    return free.unionByName(ranked.select(*columns, name(F.col("_rank")).alias("split")))
