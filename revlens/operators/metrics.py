"""Metrics, tuning and routing (MET-*, TUN-*, RTE-*, AGG-2..6).

Every metric is a handful of conditional counts, computed with partial
aggregation per partition, so only (group × a few longs) cross the
shuffle.  Fixed grids (bands, thresholds, blend weights) are applied by a
map-side ``inline`` of a literal array of structs, or, for thresholds, by
bucketing each score once and taking reverse cumulative sums over at most
21 buckets: no join against the grid, no rows × grid shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions.rules import abstain_decision


def _ratio(num: Column, den: Column) -> Column:
    """Division with sklearn's zero_division=0."""
    return F.when(den > 0, num.cast("double") / den.cast("double")).otherwise(F.lit(0.0))


def confusion_counts(y: Column, pred: Column) -> list[Column]:
    return [F.count_if((y == 1) & (pred == 1)).alias("tp1"), F.count_if((y == 0) & (pred == 1)).alias("fp1"),
            F.count_if((y == 1) & (pred == 0)).alias("fn1"), F.count_if((y == 0) & (pred == 0)).alias("tn1")]


def binary_from_counts(tp1: Column, fp1: Column, fn1: Column, tn1: Column, nd: int = 6) -> list[Column]:
    """MET-1 from the four counts (class 0 is the minority of interest)."""
    tp0, fp0, fn0 = tn1, fn1, fp1
    n = tp1 + fp1 + fn1 + tn1
    p0, r0 = _ratio(tp0, tp0 + fp0), _ratio(tp0, tp0 + fn0)
    p1, r1 = _ratio(tp1, tp1 + fp1), _ratio(tp1, tp1 + fn1)
    f1_0 = _ratio(2 * tp0, 2 * tp0 + fn0 + fp0)
    f1_1 = _ratio(2 * tp1, 2 * tp1 + fn1 + fp1)
    f2_0 = _ratio(5 * tp0, 5 * tp0 + 4 * fn0 + fp0)
    cols = [("accuracy", _ratio(tp1 + tn1, n)), ("f1", f1_1), ("precision_0", p0), ("recall_0", r0),
            ("f1_0", f1_0), ("f2_0", f2_0), ("precision_1", p1), ("recall_1", r1), ("f1_1", f1_1)]
    return [F.round(c, nd).alias(k) for k, c in cols]


def long_models(df: DataFrame, models: dict[str, str], keep: Sequence[str]) -> DataFrame:
    """Unpivot model probability columns into (model, prob) rows (map-side)."""
    rows = F.array(*[F.struct(F.lit(m).alias("model"), F.col(c).cast("double").alias("prob"))
                     for m, c in models.items()])
    return df.select(*keep, F.inline(rows))


def binary_metrics(df: DataFrame, y: str = "y", prob: str = "prob", by: Sequence[str] = ("model", "split"),
                   threshold: float = 0.5) -> DataFrame:
    """MET-1 for every group at once (one groupBy)."""
    pred = (F.col(prob) >= threshold).cast("int")
    c = df.where(F.col(y).isNotNull()).groupBy(*by).agg(*confusion_counts(F.col(y), pred))
    n = F.col("tp1") + F.col("fp1") + F.col("fn1") + F.col("tn1")
    return c.select(*by, n.alias("n"), *binary_from_counts(F.col("tp1"), F.col("fp1"), F.col("fn1"), F.col("tn1")))


def confusion_matrix(df: DataFrame, y: str = "y", prob: str = "prob", by: Sequence[str] = ("model", "split"),
                     threshold: float = 0.5) -> DataFrame:
    """MET-2: 2×2 counts per group, zero-filled (fixed cells, unpivoted)."""
    pred = (F.col(prob) >= threshold).cast("int")
    c = df.where(F.col(y).isNotNull()).groupBy(*by).agg(*confusion_counts(F.col(y), pred))
    cells = F.array(*[F.struct(F.lit(t).alias("y_true"), F.lit(p).alias("y_pred"), F.col(n).alias("count"))
                      for t, p, n in ((1, 1, "tp1"), (0, 1, "fp1"), (1, 0, "fn1"), (0, 0, "tn1"))])
    return c.select(*by, F.inline(cells))


def selective_from_decisions(y: Column, dec: Column, nd: int = 6) -> list[Column]:
    """MET-3 aggregates; NULL metrics when nothing is covered."""
    cov = dec != -1
    n = F.count(F.lit(1))
    ncov = F.count_if(cov)
    tp0 = F.count_if(cov & (y == 0) & (dec == 0))
    fp0 = F.count_if(cov & (y == 1) & (dec == 0))
    fn0 = F.count_if(cov & (y == 0) & (dec == 1))
    neg = F.count_if(cov & (y == 0))
    some = ncov > 0
    return [
        F.round(ncov / n, nd).alias("coverage"),
        F.round(F.lit(1.0) - ncov / n, nd).alias("uncertain_rate"),
        F.round(F.when(some, _ratio(tp0, tp0 + fp0)), nd).alias("selective_precision_0"),
        F.round(F.when(some, _ratio(tp0, tp0 + fn0)), nd).alias("selective_recall_0"),
        F.round(F.when(some, _ratio(5 * tp0, 5 * tp0 + 4 * fn0 + fp0)), nd).alias("selective_f2_0"),
        F.round(F.when(some & (neg > 0), fn0 / neg), nd).alias("fnr_covered_0"),
    ]


def with_bands(df: DataFrame, prob: str, clean: str, nnz: str | None, bands=K.BAND_PAIRS,
               min_nnz: int = K.MIN_NNZ_DEFAULT) -> DataFrame:
    """Decisions for each (lo, hi) band, one output row per band (map-side
    ``inline`` of a fixed-size literal grid)."""
    structs = []
    for lo, hi in bands:
        dec, why = abstain_decision(F.col(prob), F.col(clean), F.col(nnz) if nnz else None, lo, hi, min_nnz)
        structs.append(F.struct(F.lit(lo).alias("lo"), F.lit(hi).alias("hi"), dec.alias("decision"),
                                why.alias("reason")))
    return df.select("*", F.inline(F.array(*structs)))


def band_sweep(df: DataFrame, y: str = "y", by: Sequence[str] = ("model", "split")) -> DataFrame:
    """TUN-3: selective metrics and fallback rate for each band."""
    d = df.where(F.col(y).isNotNull())
    fallback = F.count_if(F.col("reason").isin("too_short", "sparse_vector")) / F.count(F.lit(1))
    return d.groupBy(*by, "lo", "hi").agg(*selective_from_decisions(F.col(y), F.col("decision")),
                                          F.round(fallback, 6).alias("fallback_rate"))


def recommended_band(sweep: DataFrame, by: Sequence[str] = ("model",), min_precision: float = 0.50) -> DataFrame:
    """TOP-6: feasible (precision_0 ≥ min) first, then recall, coverage;
    arg-max per group with ``max_by`` over a struct key (no window)."""
    feas = (F.col("selective_precision_0") >= min_precision).cast("int")
    key = F.struct(feas.alias("f"), F.coalesce(F.col("selective_recall_0"), F.lit(-1.0)).alias("r"),
                   F.col("coverage").alias("c"), (-F.col("lo")).alias("l"), (-F.col("hi")).alias("h"))
    best = F.max_by(F.struct("lo", "hi", "coverage", "selective_recall_0", "selective_precision_0"), key)
    return sweep.groupBy(*by).agg(best.alias("b")).select(*by, "b.*")


# --------------------------------------------------------------------------
# multi-label (long form: review_id, label, truth, score)
# --------------------------------------------------------------------------

def multilabel_metrics(df: DataFrame, pred: Column, truth: str = "truth", by: Sequence[str] = ("model",),
                       rid: str = "review_id", nd: int = 6) -> DataFrame:
    """MET-4: micro/macro F1, subset accuracy, Hamming loss, cardinalities.

    Two aggregation levels: per (group, label) counts and per (group,
    review) exact-match flags, both partial-aggregated."""
    t = F.col(truth)
    d = df.withColumn("_pred", pred.cast("int"))
    per_label = d.groupBy(*by, "label").agg(
        F.count_if((t == 1) & (F.col("_pred") == 1)).alias("tp"), F.count_if((t == 0) & (F.col("_pred") == 1)).alias("fp"),
        F.count_if((t == 1) & (F.col("_pred") == 0)).alias("fn"))
    lab = per_label.groupBy(*by).agg(
        F.sum("tp").alias("tp"), F.sum("fp").alias("fp"), F.sum("fn").alias("fn"),
        F.avg(_ratio(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn"))).alias("macro_f1"),
        F.count(F.lit(1)).alias("n_labels"))
    per_row = d.groupBy(*by, rid).agg(F.min((t == F.col("_pred")).cast("int")).alias("exact"),
                                      F.sum(t).alias("card_t"), F.sum("_pred").alias("card_p"))
    rows = per_row.groupBy(*by).agg(F.avg("exact").alias("subset_accuracy"), F.count(F.lit(1)).alias("n_rows"),
                                    F.avg("card_t").alias("cardinality_true"), F.avg("card_p").alias("cardinality_pred"))
    j = lab.join(rows, list(by))
    return j.select(
        *by, F.round(_ratio(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")), nd).alias("micro_f1"),
        F.round("macro_f1", nd).alias("macro_f1"), F.round("subset_accuracy", nd).alias("subset_accuracy"),
        F.round((F.col("fp") + F.col("fn")) / (F.col("n_rows") * F.col("n_labels")), nd).alias("hamming_loss"),
        F.round("cardinality_true", nd).alias("cardinality_true"),
        F.round("cardinality_pred", nd).alias("cardinality_pred"))


def multilabel_rows(df: DataFrame, hits: str, n_labels: int, by: Sequence[str] = ("model",), nd: int = 6,
                    extra: Sequence[Column] = ()) -> DataFrame:
    """MET-4 from one row a review that holds its labels, always in the same
    order, as an array of (t: truth, p: predicted 0/1): one aggregate of
    counts, nothing is shuffled by review."""
    at = [F.col(hits)[i] for i in range(n_labels)]
    counts = [c for i, x in enumerate(at) for c in (
        F.count_if((x["t"] == 1) & (x["p"] == 1)).alias(f"tp{i}"), F.count_if((x["t"] == 0) & (x["p"] == 1)).alias(f"fp{i}"),
        F.count_if((x["t"] == 1) & (x["p"] == 0)).alias(f"fn{i}"))]
    g = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"), F.avg(F.forall(hits, lambda x: x["t"] == x["p"]).cast("int")).alias("subset_accuracy"),
        *counts, *extra)

    def total(name):
        return sum((F.col(f"{name}{i}") for i in range(n_labels)), F.lit(0))

    tp, fp, fn = total("tp"), total("fp"), total("fn")
    f1 = [_ratio(2 * F.col(f"tp{i}"), 2 * F.col(f"tp{i}") + F.col(f"fp{i}") + F.col(f"fn{i}")) for i in range(n_labels)]
    more = [c for c in g.columns if c not in {*by, "n_rows", "subset_accuracy"} and not c[:2] in ("tp", "fp", "fn")]
    return g.select(*by, F.round(_ratio(2 * tp, 2 * tp + fp + fn), nd).alias("micro_f1"),
                    F.round(sum(f1, F.lit(0.0)) / n_labels, nd).alias("macro_f1"), F.round("subset_accuracy", nd).alias("subset_accuracy"),
                    F.round((fp + fn) / (F.col("n_rows") * n_labels), nd).alias("hamming_loss"),
                    F.round((tp + fn) / F.col("n_rows"), nd).alias("cardinality_true"),
                    F.round((tp + fp) / F.col("n_rows"), nd).alias("cardinality_pred"), *more)


def per_label_metrics(df: DataFrame, pred: Column, truth: str = "truth", by: Sequence[str] = ("model",),
                      nd: int = 6) -> DataFrame:
    """MET-5: precision, recall, F1, support, predicted positives, frequency."""
    t, p = F.col(truth), pred.cast("int")
    c = df.groupBy(*by, "label").agg(
        F.count_if((t == 1) & (p == 1)).alias("tp"), F.count_if((t == 0) & (p == 1)).alias("fp"),
        F.count_if((t == 1) & (p == 0)).alias("fn"), F.count(F.lit(1)).alias("n"))
    return c.select(*by, "label",
                    F.round(_ratio(F.col("tp"), F.col("tp") + F.col("fp")), nd).alias("precision"),
                    F.round(_ratio(F.col("tp"), F.col("tp") + F.col("fn")), nd).alias("recall"),
                    F.round(_ratio(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")), nd).alias("f1"),
                    (F.col("tp") + F.col("fn")).alias("support"),
                    (F.col("tp") + F.col("fp")).alias("predicted_positive"),
                    F.round((F.col("tp") + F.col("fn")) / F.col("n"), nd).alias("frequency"))


GRID = [i / 20.0 for i in range(2, 19)]  # 0.10 .. 0.90 step 0.05 (exact i/20)


def grid_bucket(score: Column, lo_i: int = 2, hi_i: int = 18) -> Column:
    """Number of grid thresholds i/20 (lo_i..hi_i) that are ≤ score, minus 1
    plus lo_i, i.e. the largest i with i/20 ≤ score (lo_i-1 if none).
    floor(score·20) is corrected by exact comparisons with i/20."""
    b = F.floor(score * 20.0).cast("int")
    b = F.when(score < b / F.lit(20.0), b - 1).when(score >= (b + 1) / F.lit(20.0), b + 1).otherwise(b)
    return F.least(F.lit(hi_i), F.greatest(F.lit(lo_i - 1), b))


def tune_thresholds(df: DataFrame, score: str = "score", truth: str = "truth", by: Sequence[str] = ("label",)) -> DataFrame:
    """TUN-1: per label the grid threshold with the best F1; ties → nearest
    .5, then lowest; labels with a single class → .5.

    Histogram form: one groupBy (label, bucket) of positive/negative
    counts, then reverse cumulative sums over ≤ 18 buckets per label."""
    t = F.col(truth)
    hist = df.groupBy(*by, grid_bucket(F.col(score)).alias("b")).agg(
        F.count_if(t == 1).alias("pos"), F.count_if(t == 0).alias("neg"))
    # expand each label to the 17 grid points from its histogram (tiny)
    w = Window.partitionBy(*by).orderBy(F.col("b").desc()).rowsBetween(Window.unboundedPreceding, 0)
    cum = hist.select(*by, "b", F.sum("pos").over(w).alias("tp"), F.sum("neg").over(w).alias("fp"),
                      F.sum("pos").over(Window.partitionBy(*by)).alias("P"),
                      F.sum("neg").over(Window.partitionBy(*by)).alias("N"))
    grid = F.array(*[F.lit(i) for i in range(2, 19)])
    g = cum.groupBy(*by).agg(F.max("P").alias("P"), F.max("N").alias("N"),
                             F.map_from_entries(F.collect_list(F.struct("b", F.struct("tp", "fp")))).alias("m"))
    pts = g.select(*by, "P", "N", F.explode(grid).alias("i"), "m")
    # tp at threshold i = cumulative count of the smallest bucket ≥ i
    keys = F.array_sort(F.filter(F.map_keys("m"), lambda k: k >= F.col("i")))
    first = F.try_element_at(keys, F.lit(1))
    tp = F.coalesce(F.try_element_at("m", first)["tp"], F.lit(0))
    fp = F.coalesce(F.try_element_at("m", first)["fp"], F.lit(0))
    f1 = _ratio(2 * tp, 2 * tp + fp + (F.col("P") - tp))
    scored = pts.select(*by, "P", "N", (F.col("i") / 20.0).alias("threshold"), f1.alias("f1"))
    key = F.struct(F.col("f1").alias("f"), (-F.abs(F.col("threshold") - 0.5)).alias("d"),
                   (-F.col("threshold")).alias("t"))
    best = scored.groupBy(*by).agg(F.max_by(F.struct("threshold", "f1"), key).alias("b"),
                                   F.max("P").alias("P"), F.max("N").alias("N"))
    single = (F.col("P") == 0) | (F.col("N") == 0)
    return best.select(*by, F.when(single, F.lit(0.5)).otherwise(F.col("b.threshold")).alias("threshold"),
                       F.round(F.when(single, F.lit(None).cast("double")).otherwise(F.col("b.f1")), 6).alias("f1"))


ALPHAS = [i / 10.0 for i in range(0, 11)]


def tune_blend(df: DataFrame, a: str = "score", b: str = "score2", truth: str = "truth", threshold: float = 0.5,
               by: Sequence[str] = ("label",)) -> DataFrame:
    """TUN-2: per label α ∈ {0, .1, …, 1} maximising (F2, recall,
    precision, −|α−.5|) of α·a + (1−α)·b ≥ threshold."""
    t = F.col(truth)
    rows = F.array(*[F.struct(F.lit(al).alias("alpha"),
                              ((F.lit(al) * F.col(a) + F.lit(1.0 - al) * F.col(b)) >= threshold).alias("hit"))
                     for al in ALPHAS])
    ex = df.select(*by, t.alias("_t"), F.inline(rows))
    c = ex.groupBy(*by, "alpha").agg(F.count_if((F.col("_t") == 1) & F.col("hit")).alias("tp"),
                                     F.count_if((F.col("_t") == 0) & F.col("hit")).alias("fp"),
                                     F.count_if((F.col("_t") == 1) & ~F.col("hit")).alias("fn"))
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    m = c.select(*by, "alpha", _ratio(5 * tp, 5 * tp + 4 * fn + fp).alias("f2"), _ratio(tp, tp + fn).alias("recall"),
                 _ratio(tp, tp + fp).alias("precision"))
    key = F.struct("f2", "recall", "precision", (-F.abs(F.col("alpha") - 0.5)).alias("d"))
    best = m.groupBy(*by).agg(F.max_by(F.struct("alpha", "f2", "recall", "precision"), key).alias("b"))
    return best.select(*by, "b.alpha", F.round("b.f2", 6).alias("f2"), F.round("b.recall", 6).alias("recall"),
                       F.round("b.precision", 6).alias("precision"))


DELTAS = [-0.10, -0.05, 0.0, 0.05, 0.10]


def threshold_stability(df: DataFrame, thresholds: DataFrame, score: str = "score", truth: str = "truth") -> DataFrame:
    """TUN-4: micro/macro F1 when every tuned threshold moves by Δ
    (clipped to [.05, .95]).  ``thresholds`` has one row per label (≤ the
    fixed label count), so it is broadcast."""
    j = df.join(F.broadcast(thresholds.select("label", F.col("threshold").alias("_th"))), "label")
    rows = F.array(*[F.struct(F.lit(dl).alias("delta"),
                              (F.col(score) >= F.least(F.lit(0.95), F.greatest(F.lit(0.05), F.col("_th") + F.lit(dl))))
                              .alias("hit")) for dl in DELTAS])
    ex = j.select("label", F.col(truth).alias("_t"), F.inline(rows))
    per = ex.groupBy("delta", "label").agg(F.count_if((F.col("_t") == 1) & F.col("hit")).alias("tp"),
                                           F.count_if((F.col("_t") == 0) & F.col("hit")).alias("fp"),
                                           F.count_if((F.col("_t") == 1) & ~F.col("hit")).alias("fn"))
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    agg = per.groupBy("delta").agg(F.sum("tp").alias("tp"), F.sum("fp").alias("fp"), F.sum("fn").alias("fn"),
                                   F.avg(_ratio(2 * tp, 2 * tp + fp + fn)).alias("macro_f1"))
    return agg.select(F.round("delta", 2).alias("delta"),
                      F.round(_ratio(2 * tp, 2 * tp + fp + fn), 6).alias("micro_f1"),
                      F.round("macro_f1", 6).alias("macro_f1"))


def stability_summary(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """AGG-19: mean and sample std of a metric by group."""
    return df.groupBy(*by).agg(F.round(F.avg(value), 6).alias(f"mean_{value}"),
                               F.round(F.stddev_samp(value), 6).alias(f"std_{value}"))
