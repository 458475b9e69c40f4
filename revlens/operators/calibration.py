"""MOD-11: probability calibration out of fold.

The rows of each class are dealt to min(3, rows of the smaller class) folds of
equal size (exact cuts of a row hash, ``order_stats.exact_split``).  For every
fold a model is fitted on the others and scores the fold; a calibrator is
fitted on these scores.  A new row's probability is the mean of the folds'
calibrated ones.

* sigmoid: logistic regression on the margin, with Platt's smoothed targets:
  a row counts as class 1 with weight t and as class 0 with 1 - t.
* isotonic: on the probability, in steps of 1/10 000.  Rows of a step are
  counted first, so the regression sees at most 10 001 weighted points.

A label whose smaller class has fewer than two rows cannot be calibrated: its
model is fitted on all rows, or is a constant for one class, and ``note`` says so.
Null labels or vectors take no part; an empty table gives a constant 0.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stored
from .order_stats import exact_split

MAX_FOLDS = 3
STEPS = 10_000
MAX_STEPS = 100  # of the sigmoid fit; a few are needed
METHODS = ("sigmoid", "isotonic")


def fold_draw(key: str, tag: Column) -> Column:
    """52 bits of a digest of the label and the row, a double without loss."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", tag, key)), 1, 13), 16, 10).cast("bigint").cast("double")


def fold_count(smaller: int, folds: int = MAX_FOLDS) -> int:
    """Folds for a class of that many rows; 0 where there is nothing to hold out."""
    return min(folds, smaller) if smaller >= 2 else 0


def with_folds(rows: DataFrame, key: str, label: str = "label", y: str = "y", folds: int = MAX_FOLDS) -> DataFrame:
    """``rows`` (one a key and label) with ``fold``, 0 .. folds - 1, or null for a
    label without folds: in every (label, class) the sizes differ by one at most."""
    # Stored: the counts, every round of the cuts and the result read the rows.
    rows = stored(rows.where(F.col(y).isin(0, 1) & F.col(label).isNotNull()).withColumn("_draw", fold_draw(key, F.col(label))))
    counts = {(r["l"], int(r["y"])): r["n"] for r in
              rows.groupBy(F.col(label).alias("l"), F.col(y).alias("y")).agg(F.count(F.lit(1)).alias("n")).collect()}
    of = {lb: fold_count(min(counts.get((lb, c), 0) for c in (0, 1)), folds) for lb, _ in counts}

    def places(group, n):
        k = of[group[0]]
        return [n * (i + 1) // k if i < k else n for i in range(folds - 1)] if k else [n] * (folds - 1)

    if not counts:
        return rows.drop("_draw").withColumn("fold", F.lit(None).cast("int"))
    split = exact_split(rows, "_draw", key, [label, y], names=[str(i) for i in range(folds)], sizes=places, is_stored=True)
    known = [lb for lb, k in of.items() if k]
    return split.withColumn("fold", F.when(F.col(label).isin(known), F.col("split").cast("int"))).drop("split", "_draw")


@dataclass
class Calibrated:
    """Fitted folds of one label."""

    constant: float | None = None
    models: list = field(default_factory=list)
    calibrators: dict[str, list] = field(default_factory=dict)

    @property
    def note(self) -> str:
        if self.constant is not None:
            return "constant"
        return f"calibrated;cv={len(self.models)}" if self.calibrators else "trained;cv=0"

    def transform(self, rows: DataFrame, features: str = "features") -> DataFrame:
        """``rows`` with p_raw and, for each method, its mean over folds."""
        kept = [F.col(c) for c in rows.columns]
        names = ["p_raw", *[f"p_{m}" for m in METHODS]]
        if self.constant is not None:
            return rows.select(*kept, *[F.lit(self.constant).alias(c) for c in names])
        out, made = rows, {c: [] for c in names}
        for i, model in enumerate(self.models):
            out, raw, margin = _scored(out, model, features, i)
            made["p_raw"].append(F.col(raw))
            if not self.calibrators:
                made["p_sigmoid"].append(F.col(raw))
                made["p_isotonic"].append(F.col(raw))
                continue
            slope, shift = self.calibrators["sigmoid"][i]
            made["p_sigmoid"].append(1.0 / (1.0 + F.exp(-(F.lit(slope) * F.col(margin) + F.lit(shift)))))
            iso = self.calibrators["isotonic"][i].copy().setFeaturesCol(raw).setPredictionCol(f"_iso{i}")
            out = iso.transform(out)
            made["p_isotonic"].append(F.col(f"_iso{i}"))
        return out.select(*kept, *[(sum(made[c][1:], made[c][0]) / len(made[c])).alias(c) for c in names])


def _scored(rows: DataFrame, model, features: str, i: int) -> tuple[DataFrame, str, str]:
    raw, margin = f"_raw{i}", f"_margin{i}"
    m = (model.copy().setFeaturesCol(features).setRawPredictionCol(f"_rp{i}").setProbabilityCol(f"_pp{i}")
         .setPredictionCol(f"_pr{i}"))
    out = m.transform(rows).withColumns({raw: vector_to_array(f"_pp{i}")[1], margin: vector_to_array(f"_rp{i}")[1]})
    return out.drop(f"_rp{i}", f"_pp{i}", f"_pr{i}"), raw, margin


def sigmoid(scores: DataFrame, margin: str, y: str) -> tuple[float, float]:
    """(slope, shift) of Platt's logistic regression with smoothed targets, by
    Newton steps: a pass gives the loss, its gradient and its second derivatives,
    six numbers.  ``scores`` are read several times: give a stored table."""
    x, one = F.col(margin), F.col(y) == 1
    c = scores.agg(F.count_if(one).alias("a"), F.count_if(~one).alias("b"), F.min(x).alias("lo"), F.max(x).alias("hi")).first()
    high, low = (c["a"] + 1.0) / (c["a"] + 2.0), 1.0 / (c["b"] + 2.0)
    n = c["a"] + c["b"]
    t = F.when(one, high).otherwise(low)
    mean = (c["a"] * high + c["b"] * low) / n
    start = np.array([0.0, math.log(mean / (1.0 - mean))])
    if c["lo"] == c["hi"]:
        return 0.0, float(start[1])

    def look(w):
        z = F.lit(float(w[0])) * x + F.lit(float(w[1]))
        p = 1.0 / (1.0 + F.exp(-z))
        h = p * (1.0 - p)
        r = scores.agg(F.sum(F.greatest(z, F.lit(0.0)) + F.log1p(F.exp(-F.abs(z))) - t * z), F.sum((p - t) * x), F.sum(p - t),
                       F.sum(h * x * x), F.sum(h * x), F.sum(h)).first()
        return r[0], np.array(r[1:3]), np.array([[r[3], r[4]], [r[4], r[5]]])

    w, (loss, grad, hess) = start, look(start)
    for _ in range(MAX_STEPS):
        step = np.linalg.lstsq(hess, grad, rcond=None)[0]
        gain = float(grad @ step)
        if not gain > 1e-12 * n:
            break
        for halved in range(20):  # shorter, until the loss falls
            new = w - step / 2 ** halved
            at = look(new)
            if at[0] <= loss:
                break
        else:
            break
        w, (loss, grad, hess) = new, at
    return float(w[0]), float(w[1])


def isotonic(scores: DataFrame, raw: str, y: str):
    points = (scores.groupBy((F.round(F.col(raw) * STEPS) / STEPS).alias("_x"))
              .agg(F.avg(F.col(y).cast("double")).alias("_y"), F.count(F.lit(1)).cast("double").alias("_w")))
    return IsotonicRegression(featuresCol="_x", labelCol="_y", weightCol="_w").fit(points)


def fit(rows: DataFrame, y: str = "y", fold: str = "fold", features: str = "features", max_iter: int = 30,
        reg: float = 1e-3) -> Calibrated:
    """One label's folds.  ``rows`` are read several times: give a stored table."""
    rows = rows.where(F.col(features).isNotNull() & F.col(y).isNotNull()).withColumn(y, F.col(y).cast("double"))
    found = rows.agg(F.collect_set(y).alias("classes"), F.collect_set(fold).alias("folds")).first()  # at most 2 and 3 values
    if len(found["classes"]) < 2:
        return Calibrated(constant=found["classes"][0] if found["classes"] else 0.0)
    estimator = LogisticRegression(featuresCol=features, labelCol=y, maxIter=max_iter, regParam=reg)
    folds = sorted(found["folds"])
    if not folds:
        return Calibrated(models=[estimator.fit(rows)])
    out = Calibrated(calibrators={m: [] for m in METHODS})
    for k in folds:
        model = estimator.fit(rows.where(F.col(fold) != k))
        scores, raw, margin = _scored(rows.where(F.col(fold) == k), model, features, 0)
        scores = stored(scores.select(raw, margin, y))
        out.models.append(model)
        out.calibrators["sigmoid"].append(sigmoid(scores, margin, y))
        out.calibrators["isotonic"].append(isotonic(scores, raw, y))
    return out
