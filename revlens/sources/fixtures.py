"""Derived review views over the driver tables (FIXTURES.md §B).

The driver tables carry no review vocabulary, so every review operator
runs on views derived row-by-row from ``lineitem``: one review per line
item, phrases chosen by md5 digits.  The views are pure projections /
``explode``s of the scan (no shuffle), so they scale with ``lineitem``
and stay inside one codegen stage.  md5 is the only source of variation,
which lets the DuckDB oracle rebuild identical rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions.rules import keyword_label_hits
from ..functions.text import clean_text, tokens_ws
from .tables import fence, table

# FIXED VALUES of the derived test view (FIXTURES.md B1), index 1..16.
NEG_PHRASES = [
    "delivery was late", "code not working", "customer service was rude", "still no refund",
    "very disappointed", "total waste of money", "looks like a scam", "not good",
    "card arrived broken", "extremely slow shipping", "meh", "2/10", "i can't redeem the pin",
    "confusing and difficult to use", "didnt work at all", "overpriced, not worth it",
]
POS_PHRASES = [
    "great gift card", "fast delivery", "love it", "works perfectly", "easy to redeem",
    "very good value", "not bad at all", "thx u made it easy", "never had a problem",
    "absolutely amazing", "gr8", "10/10", "no issues whatsoever", "badass card",
    "really nice and quick", "see www.example.com/cards it is great",
]
NEU_PHRASES = [
    "it is ok", "idk", "gift card", "arrived", "hmm", "average, nothing special",
    "somewhat slow but fine", "bought it for my mom", "3/5", "imo fair", "it was a café gift",
    "balance checked", "not sure yet", "rather simple", "used w/o a receipt", "hard to say",
]
CONNECTORS = [" but ", " and ", ". ", ", however ", " ", " although ", "! ", " yet "]
STATUSES = ["done", "reviewed", "pending", "", "Final"]

TWO32 = 4294967296.0


def hex8(hx: Column, start: int) -> Column:
    """Integer value of 8 hex digits of an md5 string."""
    return F.conv(F.substring(hx, start, 8), 16, 10).cast("bigint")


def h(tag: Column | str, key: Column) -> Column:
    """h(x) = first 8 hex digits of md5(tag|key) as an integer."""
    t = F.lit(tag) if isinstance(tag, str) else tag
    return hex8(F.md5(F.concat_ws("|", t, key)), 1)


def u(tag: Column | str, key: Column) -> Column:
    """Uniform in [0,1) from md5(tag|key)."""
    return h(tag, key) / F.lit(TWO32)


def _arr(xs):
    return F.array(*[F.lit(x) for x in xs])


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B1: one review per ``lineitem`` row."""
    li = fence(table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate"))
    rid = F.concat_ws("-", *[F.col(c).cast("string") for c in
                             ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")])
    hx = F.md5(F.concat_ws("|", F.lit("reviews"), rid))
    s1 = li.select(
        rid.alias("review_id"), "l_orderkey", "l_partkey", "l_suppkey",
        F.col("l_shipdate").cast("timestamp").alias("review_ts"),
        (hex8(hx, 1) % 100).alias("_r"), hex8(hx, 9).alias("_h2"),
        hex8(hx, 17).alias("_h3"), hex8(hx, 25).alias("_h4"))
    r = F.col("_r")
    rating = F.when(r < 8, 1).when(r < 10, 2).when(r < 12, 3).when(r < 17, 4).otherwise(5)
    s2 = s1.withColumn("rating", rating)
    tone = (F.when(F.col("_h4") % 100 < 15, F.expr("(_h4 div 100) % 3"))
            .when(F.col("rating") <= 2, F.lit(0)).when(F.col("rating") == 3, F.lit(1))
            .otherwise(F.lit(2)).cast("bigint"))
    s3 = s2.withColumn("tone", tone)
    lists = F.array(_arr(NEG_PHRASES), _arr(NEU_PHRASES), _arr(POS_PHRASES))
    opening = F.element_at(F.element_at(lists, (F.col("tone") + 1).cast("int")),
                           (F.col("_h2") % 16 + 1).cast("int"))
    close_tone = F.when(F.expr("(_h3 div 160) % 10") < 7, F.col("tone")).otherwise(F.lit(1))
    closing = F.element_at(F.element_at(lists, (close_tone + 1).cast("int")),
                           (F.expr("(_h4 div 300) % 16") + 1).cast("int"))
    conn = F.element_at(_arr(CONNECTORS), (F.expr("(_h3 div 20) % 8") + 1).cast("int"))
    text = (F.when(F.expr("(_h2 div 16) % 40") == 0, F.lit(None).cast("string"))
            .when(F.col("_h3") % 20 == 0, opening)
            .otherwise(F.concat(opening, conn, closing)))
    out = s3.select("review_id", "l_orderkey", "l_partkey", "l_suppkey", "review_ts",
                    "rating", "tone", text.alias("text"))
    # A filter on the text or rating must not rebuild the review from its digest in every clause.
    return fence(out, *out.columns)


def scored_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B2: reviews plus clean text, strong label ``y``, two model
    probabilities ``p`` / ``p2``, ``nnz`` and a hash split."""
    rv = reviews(spark, sf_dir)
    rid = F.col("review_id")
    base = F.when(F.col("tone") == 0, F.lit(0.25)).when(F.col("tone") == 1, F.lit(0.55)).otherwise(F.lit(0.85))

    def clamp(x):
        return F.least(F.lit(0.999), F.greatest(F.lit(0.001), x))

    clean = clean_text(F.col("text"))
    us = u("split", rid)
    return rv.select(
        "review_id", "l_orderkey", "l_partkey", "l_suppkey", "rating", "tone", "text",
        clean.alias("clean_text"),
        F.when(F.col("rating") <= 2, F.lit(0)).when(F.col("rating") >= 4, F.lit(1))
        .otherwise(F.lit(None).cast("int")).alias("y"),
        clamp(base + (u("p1", rid) - F.lit(0.5)) * F.lit(0.6)).alias("p"),
        clamp(base + (u("p2", rid) - F.lit(0.5)) * F.lit(0.8)).alias("p2"),
        F.size(F.array_distinct(tokens_ws(clean))).alias("nnz"),
        F.when(us < 0.7, "train").when(us < 0.8, "val").otherwise("test").alias("split"),
    )


def with_issue_truth(df: DataFrame, text_col: str = "text", labels=K.ISSUE_LABELS) -> DataFrame:
    """Adds ``_hit_<label>`` (keyword rule on clean text) and
    ``_truth_<label>`` (hit XOR a 3 % md5 flip; ``other`` = no specific
    truth).  Staged in separate projections so the wide keyword tests are
    evaluated once per row."""
    rid = F.col("review_id")
    specific = [lb for lb in labels if lb != "other"]
    staged = df.withColumn("_clean", clean_text(F.col(text_col)))
    hits = dict(keyword_label_hits(F.col("_clean")))
    staged = staged.select("*", *[hits[lb].alias(f"_hit_{lb}") for lb in specific])
    any_hit = F.lit(False)
    for lb in specific:
        any_hit = any_hit | F.col(f"_hit_{lb}")
    staged = staged.withColumn("_hit_other", ~any_hit)
    staged = fence(staged, *[f"_hit_{lb}" for lb in labels])
    staged = staged.select("*", *[(F.col(f"_hit_{lb}") != (u(F.lit("t_" + lb), rid) < 0.03)).alias(f"_truth_{lb}")
                                  for lb in specific])
    any_truth = F.lit(False)
    for lb in specific:
        any_truth = any_truth | F.col(f"_truth_{lb}")
    return staged.withColumn("_truth_other", ~any_truth)


def issue_rows(spark: SparkSession, sf_dir: str, of: DataFrame | None = None) -> DataFrame:
    """B3 before its unpivot: one row a review with ``score_<label>``,
    ``score2_<label>`` and ``truth_<label>``; columns that nobody reads cost nothing.
    ``of``: the reviews that are scored, if not all."""
    rv = with_issue_truth((reviews(spark, sf_dir) if of is None else of).select("review_id", "text"))
    rid = F.col("review_id")

    def score(tag, lb):
        x = (F.lit(0.10) + F.lit(0.55) * F.col(f"_hit_{lb}").cast("double")
             + F.lit(0.35) * u(F.lit(tag + lb), rid))
        return F.least(F.lit(0.99), F.greatest(F.lit(0.01), x))

    # Staged, so that the long form is made of plain columns: together they are a method too long for the JVM to compile.
    out = rv.select("review_id", *[F.col(f"_truth_{lb}").cast("int").alias(f"truth_{lb}") for lb in K.ISSUE_LABELS],
                    *[score(tag, lb).alias(f"{name}_{lb}") for tag, name in (("s_", "score"), ("s2_", "score2"))
                      for lb in K.ISSUE_LABELS])
    return fence(out, *out.columns)


def issue_scores(spark: SparkSession, sf_dir: str, of: DataFrame | None = None) -> DataFrame:
    """B3: long table (review_id, label, score, score2, truth), of the reviews ``of``, if not all."""
    rows = F.array(*[F.struct(F.lit(lb).alias("label"), *[F.col(f"{c}_{lb}").alias(c) for c in ("score", "score2", "truth")])
                     for lb in K.ISSUE_LABELS])
    return issue_rows(spark, sf_dir, of).select("review_id", F.inline(rows))


def label_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B4: annotation batch rows (what the CSV batch files would hold).

    Every review, written 1..3 times to batch files
    with provenance (file, mtime, row order), annotator, status, an id
    spelt ``x`` / ``x.0`` / `` x `` and nine string label cells derived
    from the B3 truth with 5 % flips, 2 % blanks and 1 % invalid ``2``.
    """
    rv = reviews(spark, sf_dir).select("review_id", "rating", "text")
    rid = F.col("review_id")
    n_copies = (F.lit(1) + h("n", rid) % 3).cast("int")
    # What the copies of a review share is made once, before they are dealt out.
    truths = with_issue_truth(rv).select("review_id", "rating", "text", h("id", rid).cast("string").alias("_ann"), n_copies.alias("_n"),
                                         *[F.col(f"_truth_{lb}").cast("int").alias(f"_truth_{lb}") for lb in K.ISSUE_LABELS])
    truths = fence(truths, *truths.columns)
    ex = truths.select("*", F.explode(F.sequence(F.lit(1), F.col("_n"))).alias("copy"))
    c = F.col("copy").cast("string")

    def hc(tag):
        return h(F.concat(F.lit(tag), c), rid)

    # Draws are staged and fenced: the cells read each of them several times.
    ex = ex.select("*", (hc("w") % 3).alias("_w"), *[u(F.concat(F.lit(f"l_{lb}_"), c), rid).alias(f"_u_{lb}") for lb in K.ISSUE_LABELS])
    ex = fence(ex, "_w", *[f"_u_{lb}" for lb in K.ISSUE_LABELS])
    ann_id = F.col("_ann")
    spelt = (F.when(F.col("_w") == 0, ann_id).when(F.col("_w") == 1, F.concat(ann_id, F.lit(".0")))
             .otherwise(F.concat(F.lit(" "), ann_id, F.lit(" "))))
    label_cols = []
    for lb in K.ISSUE_LABELS:
        v = F.col(f"_u_{lb}")
        t = F.col(f"_truth_{lb}")
        cell = (F.when(v < 0.01, F.lit("2")).when(v < 0.03, F.lit(None).cast("string"))
                .when(v < 0.08, (F.lit(1) - t).cast("string")).otherwise(t.cast("string")))
        label_cols.append(cell.alias(lb))
    mtime = (F.lit("2024-01-01 00:00:00").cast("timestamp")
             + F.make_dt_interval(hours=(hc("m") % 1000).cast("int")))
    out = ex.select(
        rid, spelt.alias("id"), F.col("rating").cast("string").alias("rating"), "text",
        F.concat(F.lit("batch_"), (hc("f") % 7).cast("string"), F.lit(".csv")).alias("source_file"),
        mtime.alias("source_mtime"),
        (hc("o") % 100000).alias("row_order"),
        F.concat(F.lit("a"), (hc("a") % 5).cast("string")).alias("annotator"),
        F.element_at(_arr(STATUSES), (hc("st") % 5 + 1).cast("int")).alias("annotation_status"),
        *label_cols,
    )
    return fence(out, *out.columns)
