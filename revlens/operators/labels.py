"""Label-quality jobs over annotation batches (LBL-*, WIN-1/2, AGG-7..10).

Dedup keeps, per id and per column, the newest non-null value (file
mtime, then row order) with ``max_by`` in one ``groupBy(id)``: a hash
aggregate with partial merge, no sort of whole groups and no window over
a hot id.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from ..functions import constants as K
from ..functions.text import normalize_id
from ..sources.tables import fence


def coerce_label(c: Column) -> Column:
    """LBL-4: numeric value of a label cell (NULL when unparsable)."""
    return F.trim(c.cast("string")).try_cast("double")


def with_coerced_labels(df: DataFrame, labels=K.ISSUE_LABELS) -> DataFrame:
    """Adds ``_v_<label>`` (double or NULL) and ``labels_complete``."""
    # Fenced: filters and sums read every value several times and must not parse it again.
    out = fence(df.select("*", *[coerce_label(F.col(lb)).alias(f"_v_{lb}") for lb in labels]), *[f"_v_{lb}" for lb in labels])
    ok = F.lit(True)
    for lb in labels:
        ok = ok & F.coalesce(F.col(f"_v_{lb}").isin(0.0, 1.0), F.lit(False))
    return out.withColumn("labels_complete", ok)


def status_norm(c: Column) -> Column:
    return F.lower(F.trim(F.coalesce(c, F.lit(""))))


def filtered_batches(df: DataFrame, include_pending: bool = False, keep_incomplete: bool = False,
                     labels=K.ISSUE_LABELS) -> DataFrame:
    """LBL-2 filters: id normalized and non-blank, finished statuses,
    complete 0/1 labels; label columns become ints."""
    d = fence(df.withColumn("id", normalize_id(F.col("id"))), "id").where(F.col("id") != "")
    if not include_pending:
        d = d.where(status_norm(F.col("annotation_status")).isin(*K.DONE_STATUSES))
    d = with_coerced_labels(d, labels)
    if not keep_incomplete:
        d = d.where(F.col("labels_complete"))
    return d.select(*[c for c in d.columns if c not in labels and not c.startswith("_v_")],
                    *[F.col(f"_v_{lb}").cast("int").alias(lb) for lb in labels])


def dedup_newest(df: DataFrame, key: str = "id", order: Sequence[str] = ("source_mtime", "row_order"),
                 columns: Sequence[str] | None = None) -> DataFrame:
    """WIN-1: per key and per column the newest non-null value."""
    columns = [c for c in (columns or df.columns) if c != key]
    rank = F.struct(*[F.col(o) for o in order])
    aggs = [F.max_by(F.col(c), F.when(F.col(c).isNotNull(), rank)).alias(c) for c in columns]
    return df.groupBy(key).agg(*aggs)


def conflicts(df: DataFrame, key: str = "id", labels=K.ISSUE_LABELS) -> DataFrame:
    """WIN-2: rows of ids whose label vectors differ (NULL counts as a
    value), found by the smallest and largest value of every label then a
    semi join: one aggregate, no row for each label (distinct counts of
    several columns multiply the rows)."""
    whole = {f.name for f in df.schema.fields if isinstance(f.dataType, IntegralType)}
    aggs, bad = [], F.lit(False)
    for lb in labels:
        v = F.col(lb) if lb in whole else F.coalesce(F.col(lb).cast("string"), F.lit("<null>"))
        aggs += [F.min(v).alias(f"_a_{lb}"), F.max(v).alias(f"_z_{lb}"), F.count(v).alias(f"_n_{lb}")]
        bad = bad | F.coalesce(F.col(f"_a_{lb}") != F.col(f"_z_{lb}"), F.lit(False)) | F.col(f"_n_{lb}").between(1, F.col("_rows") - 1)
    ids = df.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"), *aggs).where(bad).select(key)
    return df.join(ids, key, "left_semi")


def group_quality(df: DataFrame, group_col: str, labels=K.ISSUE_LABELS) -> DataFrame:
    """AGG-9: rows, valid, zero-label and contradiction counts/rates, mean
    cardinality and prevalence drift (mean |group − global| prevalence).

    Global prevalence is derived from the per-group sums with a window
    over the grouped table (one row per group, not per input row)."""
    d = with_coerced_labels(df, labels)
    g = F.coalesce(F.trim(F.col(group_col).cast("string")), F.lit(""))
    g = F.when(g == "", "unknown").otherwise(g)
    bins = {lb: F.when(F.col(f"_v_{lb}").isin(0.0, 1.0), F.col(f"_v_{lb}")).otherwise(F.lit(0.0)) for lb in labels}
    card = sum((bins[lb] for lb in labels), F.lit(0.0))
    others = sum((bins[lb] for lb in labels if lb != "other"), F.lit(0.0))
    w = d.select(g.alias(group_col), F.col("labels_complete").cast("int").alias("_valid"),
                 (card == 0).cast("int").alias("_zero"),
                 ((bins["other"] == 1) & (others > 0)).cast("int").alias("_contra"),
                 card.alias("_card"), *[bins[lb].alias(f"_b_{lb}") for lb in labels])
    s = w.groupBy(group_col).agg(
        F.count(F.lit(1)).alias("rows"), F.sum("_valid").alias("valid_rows"), F.sum("_zero").alias("zero_label_rows"),
        F.sum("_contra").alias("contradiction_rows"), F.avg("_card").alias("avg_label_cardinality"),
        *[F.sum(f"_b_{lb}").alias(f"_s_{lb}") for lb in labels])
    everyone = Window.partitionBy()
    drift = sum((F.abs(F.col(f"_s_{lb}") / F.col("rows")
                       - F.sum(f"_s_{lb}").over(everyone) / F.sum("rows").over(everyone)) for lb in labels),
                F.lit(0.0)) / len(labels)
    rows = F.greatest(F.col("rows"), F.lit(1))
    return s.select(
        group_col, "rows", "valid_rows", F.round(F.col("valid_rows") / rows, 6).alias("valid_rate"),
        "zero_label_rows", F.round(F.col("zero_label_rows") / rows, 6).alias("zero_label_rate"),
        "contradiction_rows", F.round(F.col("contradiction_rows") / rows, 6).alias("contradiction_rate"),
        F.round("avg_label_cardinality", 6).alias("avg_label_cardinality"),
        F.round(drift, 6).alias("label_prevalence_drift"))


REQUIRED = ("id", "rating", "text")


def validation_rules(df: DataFrame, strict_other: bool = False, fail_on_conflicts: bool = False,
                     labels=K.ISSUE_LABELS) -> DataFrame:
    """LBL-3: (rule, severity, n_bad, passed) in one pass: rows are counted by
    (id, label vector), which gives the row rules and the id rules alike.

    Missing ids, non-binary cells and rows without a label are fatal; a
    contradiction with ``other`` and conflicting duplicates are fatal on
    request only."""
    d = with_coerced_labels(fence(df.withColumn("id", normalize_id(F.col("id"))), "id"), labels)
    nonbin = F.lit(False)
    for lb in labels:
        nonbin = nonbin | ~F.coalesce(F.col(f"_v_{lb}").isin(0.0, 1.0), F.lit(False))
    bins = [F.when(F.col(f"_v_{lb}") == 1.0, 1).otherwise(0) for lb in labels]
    card = sum(bins[1:], bins[0])
    other = F.when(F.col("_v_other") == 1.0, 1).otherwise(0)
    vec = F.concat_ws(",", *[F.coalesce(F.col(f"_v_{lb}").cast("string"), F.lit("nan")) for lb in labels])
    marks = d.select("id", vec.alias("vec"), nonbin.alias("non_binary"), (card == 0).alias("zero_label"),
                     ((other == 1) & (card > 1)).alias("other_with_label"))
    row_rules = ["non_binary", "zero_label", "other_with_label"]
    per_vec = fence(marks, *marks.columns).groupBy("id", "vec").agg(F.count(F.lit(1)).alias("n"), *[F.count_if(c).alias(c) for c in row_rules])
    per_id = per_vec.groupBy("id").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("k"), *[F.sum(c).alias(c) for c in row_rules])
    named, several = F.col("id") != "", F.col("n") > 1
    one = per_id.agg(F.sum(F.when(F.col("id") == "", F.col("n"))).alias("missing_id"), *[F.sum(c).alias(c) for c in row_rules],
                     F.count_if(named & several).alias("duplicate_ids"), F.sum(F.when(named & several, F.col("n"))).alias("duplicate_rows"),
                     F.count_if(named & (F.col("k") > 1)).alias("conflicting_ids"))
    rules = [("missing_id", "fatal"), ("non_binary", "fatal"), ("zero_label", "fatal"),
             ("other_with_label", "fatal" if strict_other else "warn"), ("duplicate_ids", "warn"), ("duplicate_rows", "warn"),
             ("conflicting_ids", "fatal" if fail_on_conflicts else "warn")]
    out = one.select(F.inline(F.array(*[F.struct(F.lit(n).alias("rule"), F.lit(s).alias("severity"),
                                                 F.coalesce(F.col(n), F.lit(0)).cast("bigint").alias("n_bad")) for n, s in rules])))
    return out.withColumn("passed", F.col("n_bad") == 0)


def validate(df: DataFrame, strict_other: bool = False, fail_on_conflicts: bool = False,
             labels=K.ISSUE_LABELS) -> DataFrame:
    """The rule table of ``df``; raises on missing columns and on a fatal rule that fails."""
    missing = [c for c in (*REQUIRED, *labels) if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    rules = validation_rules(df, strict_other, fail_on_conflicts, labels)
    failed = [f"{r['rule']}: {r['n_bad']}" for r in rules.where("severity = 'fatal' and not passed").collect()]  # <= 7 rows
    if failed:
        raise ValueError("validation failed: " + ", ".join(failed))
    return rules


def joined_with_base(rows: DataFrame, base: DataFrame, key: str = "id") -> DataFrame:
    """JOIN-1: label rows left-joined to the corpus.  The label row's text
    and rating win, the corpus fills their gaps, a text still missing is
    empty; an id that the corpus holds several times gives as many rows."""
    b = base.select(F.col(key).alias("_key"), F.col("text").alias("_text"), F.col("rating").cast("string").alias("_rating"))
    j = rows.join(b, rows[key] == b["_key"], "left")
    return (j.withColumns({"text": F.coalesce("text", "_text", F.lit("")),
                           "rating": F.coalesce("rating", "_rating").try_cast("double")})
            .drop("_key", "_text", "_rating"))


def drop_counts(df: DataFrame, strict_other: bool = False, labels=K.ISSUE_LABELS) -> DataFrame:
    """LBL-5: rows dropped before training, in the order of the steps:
    invalid cells, then no label, then (if strict) contradictions."""
    d = with_coerced_labels(df, labels)
    bins = {lb: F.coalesce(F.col(f"_v_{lb}") == 1.0, F.lit(False)) for lb in labels}
    card = sum((bins[lb].cast("int") for lb in labels), F.lit(0))
    ok = F.col("labels_complete")
    zero = ok & (card == 0)
    contra = ok & bins["other"] & (card > 1) if strict_other else F.lit(False)
    return d.agg(F.count(F.lit(1)).alias("rows"), F.count_if(~ok).alias("dropped_invalid"), F.count_if(zero).alias("dropped_unlabelled"),
                 F.count_if(contra).alias("dropped_contradiction"), F.count_if(ok & ~zero & ~contra).alias("kept"))


def label_frequency(df: DataFrame, labels=K.ISSUE_LABELS) -> DataFrame:
    """AGG-7: per label positives and prevalence among complete rows."""
    d = with_coerced_labels(df, labels).select("labels_complete", F.array(*[F.col(f"_v_{lb}") for lb in labels]).alias("_v"))
    ok = F.col("labels_complete")
    one = fence(d).agg(F.count_if(ok).alias("_n"), *[F.count_if(ok & (F.col("_v")[i] == 1.0)).alias(f"_p{i}") for i in range(len(labels))])
    rows = F.array(*[F.struct(F.lit(lb).alias("label"), F.col(f"_p{i}").alias("positives"),
                              F.round(F.col(f"_p{i}") / F.greatest(F.col("_n"), F.lit(1)), 6).alias("prevalence"))
                     for i, lb in enumerate(labels)])
    return one.select(F.inline(rows))
