"""Resampling and significance (STA-1..3), plus similarity scoring (MOD-15,
HIT-1) on embedding arrays.

Bootstrap: every row gets a Poisson(1) weight per replicate from md5 of
(replicate, row id) by inverse CDF.  Tasks draw for batches of rows at once
(``draws``) and give their counts by replicate, so only B x (a few counts) a
task cross the shuffle; the quantiles are exact over B values a metric.  Both bootstraps draw the same weights, so one stored table
of replicate counts (``replicate_counts``) serves them in a report.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import let
from ..session import stored
from ..sources.fixtures import u
from ..sources.tables import fence
from . import draws

# Poisson(1) cumulative probabilities P(K <= k), k = 0..11.
POISSON1_CDF = [math.exp(-1.0) * sum(1.0 / math.factorial(j) for j in range(k + 1)) for k in range(12)]


def poisson1(uv: Column) -> Column:
    """Inverse-CDF Poisson(1) draw from a uniform column."""
    expr = None
    for k, c in enumerate(POISSON1_CDF):
        expr = F.when(uv < F.lit(c), F.lit(k)) if expr is None else expr.when(uv < F.lit(c), F.lit(k))
    return expr.otherwise(F.lit(len(POISSON1_CDF)))


def poisson1_hex(digits: Column) -> Column:
    """``poisson1`` of the uniform 0.d1..d8 in base 16: fixed-width lower-case digits order as their values do."""
    expr = None
    for k, c in enumerate(POISSON1_CDF):
        below = digits < F.lit(f"{math.ceil(c * 4294967296.0):08x}")
        expr = F.when(below, F.lit(k)) if expr is None else expr.when(below, F.lit(k))
    return expr.otherwise(F.lit(len(POISSON1_CDF)))


def metric_from_counts(name: str, tp0: Column, fp0: Column, fn0: Column) -> Column:
    def r(n, d):
        return F.when(d > 0, n.cast("double") / d.cast("double")).otherwise(F.lit(0.0))
    if name == "recall_0":
        return r(tp0, tp0 + fn0)
    if name == "precision_0":
        return r(tp0, tp0 + fp0)
    if name == "f2_0":
        return r(5 * tp0, 5 * tp0 + 4 * fn0 + fp0)
    raise ValueError(name)


METRICS = ["recall_0", "precision_0", "f2_0"]


SMALL_CELL = 32  # up to here a cell's draw is the sum of its rows' Poisson(1) draws

# FIXED VALUES: rational approximation of the normal quantile (P. J. Acklam, relative error below 1.2e-9).
QUANTILE_A = [-3.969683028665376e+01, 2.209460984245205e+02, -2.759285104469687e+02, 1.383577518672690e+02,
              -3.066479806614716e+01, 2.506628277459239e+00]
QUANTILE_B = [-5.447609879822406e+01, 1.615858368580409e+02, -1.556989798598866e+02, 6.680131188771972e+01,
              -1.328068155288572e+01]
QUANTILE_C = [-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e+00, -2.549732539343734e+00,
              4.374664141464968e+00, 2.938163982698783e+00]
QUANTILE_D = [7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e+00, 3.754408661907416e+00]
QUANTILE_LOW = 0.02425


def normal_quantile(p: Column) -> Column:
    def poly(cs, x):
        out = F.lit(cs[0])
        for c in cs[1:]:
            out = out * x + F.lit(c)
        return out

    def tail(q):
        return poly(QUANTILE_C, q) / (poly(QUANTILE_D, q) * q + F.lit(1.0))

    mid = p - F.lit(0.5)
    r = mid * mid
    return (F.when(p < QUANTILE_LOW, tail(F.sqrt(F.lit(-2.0) * F.log(p))))
            .when(p > 1.0 - QUANTILE_LOW, -tail(F.sqrt(F.lit(-2.0) * F.log(F.lit(1.0) - p))))
            .otherwise(poly(QUANTILE_A, r) * mid / (poly(QUANTILE_B, r) * r + F.lit(1.0))))


def poisson_quantile(n: Column, p: Column) -> Column:
    """Quantile of Poisson(n) for n above ``SMALL_CELL``: Cornish-Fisher to the third order, at most 1 off."""
    def at(z):
        n1 = F.sqrt(n.cast("double"))
        x = n.cast("double") + n1 * z + (z * z - F.lit(1.0)) / F.lit(6.0) + (z - z * z * z) / (F.lit(72.0) * n1)
        return F.greatest(F.lit(0), F.floor(x + F.lit(0.5)).cast("bigint"))

    return let(normal_quantile(p), at)


def poisson(n: Column, tag: Column, key: Column) -> Column:
    """A Poisson(n) draw from md5 of (tag, key)."""
    def draw(i):
        return u(F.concat(tag, F.lit("_"), i.cast("string")), key) + F.lit(0.5 / 4294967296.0)

    rows = F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.least(n, F.lit(SMALL_CELL))).cast("int")), draw)
    few = F.aggregate(rows, F.lit(0).cast("bigint"), lambda a, x: a + poisson1(x).cast("bigint"))
    many = let(draw(F.lit(0)), lambda p: poisson_quantile(n, p))
    return F.when(n <= 0, F.lit(0).cast("bigint")).when(n <= SMALL_CELL, few).otherwise(many)


def replicate_counts(df: DataFrame, y: str, pred_a: str, pred_b: str | None = None, replicates: int = 1000,
                     id_col: str = "review_id") -> DataFrame:
    """tp0, fp0 and fn0 of decision a (``_a``) and b (``_b``) by ``rep``: 0 holds the rows as they are, 1 to
    ``replicates`` their drawn weights.  Without an id column rows are told apart by their place."""
    key = F.col(id_col) if id_col in df.columns else F.monotonically_increasing_id()
    b = F.col(pred_b) if pred_b else F.lit(None).cast("int")
    rows = df.select(key.cast("string").alias("id"), F.col(y).cast("int").alias("y"), F.col(pred_a).cast("int").alias("a"),
                     b.cast("int").alias("b"))
    rows = fence(rows, *rows.columns).where("y IN (0, 1) AND (a IN (0, 1) OR b IN (0, 1))")  # other rows count nowhere
    a, b = (F.when(F.col(c).isin(0, 1), F.col(c)).otherwise(2) for c in "ab")
    cells = rows.select("id", (F.col("y") * 9 + a * 3 + b).alias("cell"))
    # A row costs a thousand digests: dealt to all cores, however few tasks its source is read in.
    dealt = cells.repartition(3 * cells.sparkSession.sparkContext.defaultParallelism)
    made = dealt.mapInPandas(_drawn(replicates), "rep int, " + ", ".join(f"{c} long" for c in COUNTS))
    return made.groupBy("rep").agg(*[F.sum(c).alias(c) for c in COUNTS])


COUNTS = [f"{c}_{p}" for p in "ab" for c in ("tp0", "fp0", "fn0")]


def _drawn(replicates: int):
    """A task's counts by replicate; a cell is 9 y + 3 a + b, 2 for a decision that is neither 0 nor 1."""
    cuts = [math.ceil(c * 4294967296.0) for c in POISSON1_CDF]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((replicates + 1, 18), dtype=np.int64)
        for f in frames:
            ids = [None if x is None else x.encode() for x in f["id"]]
            total += draws.cell_counts(ids, f["cell"].to_numpy(np.int64), 18, b"boot", replicates, cuts)
        if total[0].any():
            y_a_b = total.reshape(-1, 2, 3, 3)
            by = {"a": y_a_b.sum(axis=3), "b": y_a_b.sum(axis=2)}
            cols = {f"{name}_{p}": by[p][:, y, d] for p in "ab" for name, y, d in (("tp0", 0, 0), ("fp0", 1, 0), ("fn0", 0, 1))}
            yield pd.DataFrame({"rep": np.arange(replicates + 1, dtype=np.int32)} | cols)

    return run


def _point(counts: DataFrame, values: Sequence[tuple[str, Column]], name: str) -> DataFrame:
    """One row a metric of the rows as they are; without a row that counts, of zero counts."""
    zero = counts.sparkSession.range(1).select(F.lit(0).alias("_rep"))
    point = zero.join(counts, F.col("_rep") == F.col("rep"), "left").na.fill(0)
    return point.select(F.inline(F.array(*[F.struct(F.lit(m).alias("metric"), F.round(v, 6).alias(name)) for m, v in values])))


def bootstrap_ci(df: DataFrame, y: str, pred: str, replicates: int = 1000, metrics=METRICS, id_col: str = "review_id",
                 counts: DataFrame | None = None) -> DataFrame:
    """STA-1: point estimate and 95 % percentile interval per metric.  ``counts``: stored ``replicate_counts`` of ``df``."""
    if counts is None:
        counts = stored(replicate_counts(df, y, pred, replicates=replicates, id_col=id_col))  # a row a replicate
    reps = counts.where("rep > 0").select(*[F.col(f"{c}_a").alias(c) for c in ("tp0", "fp0", "fn0")])
    vals = reps.select(F.inline(F.array(*[F.struct(F.lit(m).alias("metric"), metric_from_counts(
        m, F.col("tp0"), F.col("fp0"), F.col("fn0")).alias("v")) for m in metrics])))
    ci = vals.groupBy("metric").agg(F.round(F.percentile("v", 0.025), 6).alias("ci_low"),
                                    F.round(F.percentile("v", 0.975), 6).alias("ci_high"))
    pts = _point(counts, [(m, metric_from_counts(m, F.col("tp0_a"), F.col("fp0_a"), F.col("fn0_a"))) for m in metrics], "point_estimate")
    return pts.join(ci, "metric")


def paired_bootstrap(df: DataFrame, y: str, pred_a: str, pred_b: str, replicates: int = 1000, metrics=METRICS,
                     id_col: str = "review_id", counts: DataFrame | None = None) -> DataFrame:
    """STA-2: CI of metric(a) − metric(b) with shared draws.  ``counts``: stored ``replicate_counts`` of ``df``."""
    if counts is None:
        counts = stored(replicate_counts(df, y, pred_a, pred_b, replicates, id_col))  # a row a replicate
    reps = counts.where("rep > 0")

    def diff(m):
        return (metric_from_counts(m, F.col("tp0_a"), F.col("fp0_a"), F.col("fn0_a"))
                - metric_from_counts(m, F.col("tp0_b"), F.col("fp0_b"), F.col("fn0_b")))

    vals = reps.select(F.inline(F.array(*[F.struct(F.lit(m).alias("metric"), diff(m).alias("v")) for m in metrics])))
    ci = vals.groupBy("metric").agg(F.round(F.percentile("v", 0.025), 6).alias("ci_low"),
                                    F.round(F.percentile("v", 0.975), 6).alias("ci_high"))
    return _point(counts, [(m, diff(m)) for m in metrics], "point_diff").join(ci, "metric")


def erfc(x: Column) -> Column:
    """Complementary error function for x ≥ 0 (Abramowitz & Stegun 7.1.26,
    absolute error < 1.5e-7); plain arithmetic, so it stays in codegen."""
    t = F.lit(1.0) / (F.lit(1.0) + F.lit(0.3275911) * x)
    poly = t * (F.lit(0.254829592) + t * (F.lit(-0.284496736) + t * (F.lit(1.421413741)
                + t * (F.lit(-1.453152027) + t * F.lit(1.061405429)))))
    return poly * F.exp(-(x * x))


def mcnemar(df: DataFrame, y: str, pred_a: str, pred_b: str) -> DataFrame:
    """STA-3: continuity-corrected McNemar; p = erfc(sqrt(χ²/2))."""
    a_ok = F.col(pred_a) == F.col(y)
    b_ok = F.col(pred_b) == F.col(y)
    c = df.agg(F.count_if(a_ok & ~b_ok).alias("n01"), F.count_if(~a_ok & b_ok).alias("n10"))
    return mcnemar_from_counts(c)


def mcnemar_from_counts(c: DataFrame) -> DataFrame:
    den = F.col("n01") + F.col("n10")
    chi = F.when(den == 0, F.lit(0.0)).otherwise(
        F.pow(F.abs(F.col("n01") - F.col("n10")) - F.lit(1.0), 2) / den.cast("double"))
    out = c.select("n01", "n10", chi.alias("chi2_cc"))
    p = F.when(den_zero(out), F.lit(1.0)).otherwise(erfc(F.sqrt(F.col("chi2_cc") / 2.0)))
    return out.select("n01", "n10", F.round("chi2_cc", 6).alias("chi2_cc"), F.round(p, 6).alias("p_value"))


def den_zero(df: DataFrame) -> Column:
    return (F.col("n01") + F.col("n10")) == 0


# --------------------------------------------------------------------------
# MOD-15 / HIT-1 on embedding arrays
# --------------------------------------------------------------------------

def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0),
                       lambda acc, v: acc + v)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def normalize(a: Column) -> Column:
    return let(norm(a), lambda n: F.transform(a, lambda x: F.when(n > 0, x.cast("double") / n).otherwise(F.lit(0.0))))
