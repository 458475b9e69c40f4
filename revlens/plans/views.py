"""Shared derived views used by several registered queries (Spark side)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import rules as R
from ..sources.fixtures import reviews, scored_reviews
from ..sources.tables import fence


def stage1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews with the rating + keyword stage-1 label (RUL-2, RUL-13)."""
    rv = reviews(spark, sf_dir).withColumn("_cmp", R.complaint_signal(F.col("text")))
    rv = rv.withColumn("stage1_prob", R.stage1_prob(F.col("rating"), F.col("_cmp")))
    return rv.withColumn("label", R.stage1_label(F.col("stage1_prob"), F.col("_cmp"))).drop("_cmp")


EMPTY_ROWS = "array<struct<label:string,confidence:double,threshold:double>>"


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch form of the single-review triage (MOD-14 re-aimed to a
    table): blank texts dropped (TXT-10), cascade (RUL-7), issue
    resolution without a trained issue model (RUL-8/9), summary and count
    (RUL-21), risk (RUL-16).  One projection chain, no shuffle."""
    sr = scored_reviews(spark, sf_dir)
    t = R.strip_ws(F.col("text"))
    base = fence(sr.withColumn("text", t), "text").where(F.col("text") != "")
    casc = R.with_triage_cascade(base)
    rows = R.resolve_issue_labels(F.array().cast(EMPTY_ROWS), F.col("c.issue_tags"))
    staged = casc.select("*", rows.alias("issue_rows"))
    out = staged.select(
        "review_id", "l_orderkey", "l_partkey", "l_suppkey", "rating", "text", "clean_text", "p", "p2",
        "nnz", "y", "split",
        F.col("c.label").alias("label"), F.col("c.probability").alias("probability"),
        F.col("c.confidence").alias("confidence"),
        F.coalesce(F.col("c.reason"), F.lit("-")).alias("reason"),
        F.col("c.mixed_signal").alias("mixed_signal"),
        F.col("c.issue_tags").alias("issue_tags"), "issue_rows",
        R.issue_summary(F.col("issue_rows"), F.col("c.issue_tags")).alias("issue_summary"),
        F.when(F.size("issue_rows") > 0, F.size("issue_rows")).otherwise(F.size("c.issue_tags"))
        .alias("issue_count"),
        R.risk_score(F.col("c.label"), F.col("c.probability")).alias("risk_score"),
    )
    # Consumers filter on the cascade outputs (label, issue rows); the
    # fence keeps those filters from re-running the cascade.
    return fence(out, *out.columns)
