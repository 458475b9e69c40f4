"""Registered queries over the review views: text, lexicon, rules, triage
and the dashboard aggregates.  Each Spark builder has a DuckDB twin."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions import lexicon as L
from ..functions import rules as R
from ..functions import text as T
from ..operators import triage as TR
from ..sources.fixtures import reviews, with_issue_truth
from ..sources.tables import fence, table
from . import duck as D
from .registry import register
from .views import predictions, stage1

RV = D.reviews_cte
SC = D.scored_cte
PR = D.predictions_cte


def _w(*ctes):
    return D.with_ctes(*[c() for c in ctes])


# --------------------------------------------------------------------------
# AGG-13 / AGG-12 / AGG-1 / AGG-15
# --------------------------------------------------------------------------

def _dist_sql(src_ctes, src: str) -> str:
    vals = ", ".join(f"({D.q(x)}, {i})" for i, x in enumerate(K.SENTIMENT_LABELS))
    return _w(*src_ctes) + f""",
c AS (SELECT label, count(*) AS n FROM {src} GROUP BY label),
tot AS (SELECT count(*) AS total FROM {src}),
lbl AS (SELECT * FROM (VALUES {vals}) t(label, position))
SELECT lbl.label, coalesce(c.n, 0)::BIGINT AS count,
       floor(coalesce(c.n, 0)::DOUBLE * 100.0::DOUBLE / greatest(tot.total, 1)::DOUBLE * 10.0::DOUBLE + 0.5::DOUBLE) / 10.0::DOUBLE AS share_percent
FROM lbl LEFT JOIN c USING (label), tot"""


@register("label_distribution", lambda: _dist_sql((RV, D.stage1_cte), "stage1"))
def q_label_distribution(spark, d):
    """Flagship: reviews → clean/keyword rules → stage-1 labels → label
    distribution with zero fill (RUL-2, RUL-13, AGG-13)."""
    return TR.label_distribution(stage1(spark, d))


@register("cascade_label_distribution", lambda: _dist_sql((RV, SC, PR), "predictions"))
def q_cascade_label_distribution(spark, d):
    return TR.label_distribution(predictions(spark, d))


@register("overview_counts", lambda: _w(RV, SC, PR) + """
SELECT count(*)::BIGINT AS total,
       (count(*) FILTER (WHERE label = 'NEGATIVE') + count(*) FILTER (WHERE label = 'NEEDS_ATTENTION'))::BIGINT AS flagged,
       count(*) FILTER (WHERE label = 'NEGATIVE')::BIGINT AS negative,
       count(*) FILTER (WHERE label = 'NEEDS_ATTENTION')::BIGINT AS needs_attention,
       count(*) FILTER (WHERE label = 'UNCERTAIN')::BIGINT AS uncertain,
       count(*) FILTER (WHERE label = 'POSITIVE')::BIGINT AS positive
FROM predictions""")
def q_overview_counts(spark, d):
    return TR.overview_counts(predictions(spark, d))


@register("data_overview", lambda: _w(RV) + """
SELECT count(*)::BIGINT AS n_rows,
       count(*) FILTER (WHERE text IS NULL)::BIGINT AS null_text,
       count(*) FILTER (WHERE rating IS NULL)::BIGINT AS null_rating,
       count(*) FILTER (WHERE rating IN (4, 5))::BIGINT AS n_positive,
       count(*) FILTER (WHERE rating IN (1, 2))::BIGINT AS n_negative,
       count(*) FILTER (WHERE rating = 3)::BIGINT AS n_three_star,
       round(count(*) FILTER (WHERE rating IN (4, 5))::DOUBLE
             / nullif(count(*) FILTER (WHERE rating IN (1, 2)), 0)::DOUBLE, 6) AS imbalance_ratio
FROM reviews""")
def q_data_overview(spark, d):
    """AGG-1: row and null counts, strong-label counts, imbalance ratio."""
    rv = reviews(spark, d)
    r = F.col("rating")
    pos, neg = F.count_if(r.isin(4, 5)), F.count_if(r.isin(1, 2))
    return rv.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("text").isNull()).alias("null_text"),
                  F.count_if(r.isNull()).alias("null_rating"), pos.alias("n_positive"), neg.alias("n_negative"),
                  F.count_if(r == 3).alias("n_three_star"),
                  F.round(pos * 1.0 / F.when(neg > 0, neg), 6).alias("imbalance_ratio"))


@register("rating_histogram", lambda: _w(RV) + """,
c AS (SELECT rating, count(*) AS n FROM reviews GROUP BY rating)
SELECT s.rating::INT AS rating, coalesce(c.n, 0)::BIGINT AS count
FROM (SELECT unnest(range(1, 6)) AS rating) s LEFT JOIN c ON c.rating = s.rating""")
def q_rating_histogram(spark, d):
    """AGG-1: rating histogram 1..5 with zero fill (fixed stars → one
    conditional-count aggregate, unpivoted)."""
    c = TR.fixed_label_counts(reviews(spark, d), F.col("rating"), [1, 2, 3, 4, 5])
    return c.select(F.col("label").cast("int").alias("rating"), "count")


@register("star_summary", lambda: _w(RV) + """
SELECT round(avg(rating::DOUBLE), 6) AS avg_rating, count(rating)::BIGINT AS n,
""" + ",\n".join(f"count(*) FILTER (WHERE rating = {s})::BIGINT AS stars_{s}" for s in range(1, 6)) + ",\n"
    + ",\n".join(f"floor(count(*) FILTER (WHERE rating = {s})::DOUBLE * 100.0::DOUBLE / greatest(count(rating), 1)::DOUBLE + 0.5::DOUBLE)::INT AS pct_{s}"
                 for s in range(1, 6)) + "\nFROM reviews")
def q_star_summary(spark, d):
    """AGG-15."""
    return TR.star_summary(reviews(spark, d))


# --------------------------------------------------------------------------
# TXT-*
# --------------------------------------------------------------------------

@register("clean_text", lambda: _w(RV) + f"""
SELECT review_id, {D.clean('text')} AS clean_text, {D.token_count(D.clean('text'))} AS token_count
FROM reviews""")
def q_clean_text(spark, d):
    """TXT-1/2/5: cleaned text and its token count."""
    rv = reviews(spark, d)
    c = T.clean_text(F.col("text"))
    return rv.select("review_id", c.alias("clean_text")).withColumn("token_count", T.token_count(F.col("clean_text")))


@register("abbrev_norm", lambda: _w(RV) + f"""
SELECT review_id, {D.clean('text', abbrev=True)} AS abbrev_text FROM reviews""")
def q_abbrev_norm(spark, d):
    """TXT-3: cleaning with abbreviation expansion."""
    return reviews(spark, d).select("review_id", T.clean_text(F.col("text"), abbrev=True).alias("abbrev_text"))


@register("negation_tags", lambda: _w(RV) + f"""
SELECT review_id, {D.clean('text', negation=True)} AS negation_text FROM reviews""")
def q_negation_tags(spark, d):
    """TXT-4: cleaning with negation tagging (window 3)."""
    return reviews(spark, d).select("review_id", T.clean_text(F.col("text"), negation=True).alias("negation_text"))


def _contrast_sql():
    toks = D.tokens_ws("ct")
    mk = D.qin(K.TAGGER_CONTRAST_MARKERS)
    flags = ", ".join(f"list_contains(tk, {D.q(m)})::INT AS has_{m}" for m in K.TAGGER_CONTRAST_MARKERS)
    return _w(RV) + f""",
a AS (SELECT review_id, {D.clean('text')} AS ct FROM reviews),
b AS (SELECT review_id, ct, {toks} AS tk FROM a),
c AS (SELECT *, coalesce(list_position(list_transform(tk, lambda t: t IN {mk}), true), 0) AS ix FROM b)
SELECT review_id,
       CASE WHEN ix = 0 THEN trim(ct) ELSE array_to_string(list_slice(tk, 1, ix - 1), ' ') END AS left_clause,
       CASE WHEN ix = 0 THEN '' ELSE array_to_string(list_slice(tk, ix + 1, len(tk)), ' ') END AS right_clause,
       {flags}
FROM c"""


@register("contrast_split", _contrast_sql)
def q_contrast_split(spark, d):
    """TXT-6/7: clause split at the first contrast marker and 0/1 flags."""
    rv = reviews(spark, d).select("review_id", T.clean_text(F.col("text")).alias("ct"))
    sp = T.contrast_split(F.col("ct"))
    return rv.select("review_id", sp["left"].alias("left_clause"), sp["right"].alias("right_clause"),
                     *T.contrast_flags(F.col("ct")))


@register("text_snippets", lambda: _w(RV) + """
SELECT review_id, CASE WHEN length(s) > 40 THEN substr(s, 1, 37) || '...' ELSE s END AS snippet
FROM (SELECT review_id, trim(replace(coalesce(text, ''), chr(10), ' ')) AS s FROM reviews)""")
def q_text_snippets(spark, d):
    """TXT-9 with a 40-character cut (the operator default is 180)."""
    return reviews(spark, d).select("review_id", T.snippet(F.col("text"), 40).alias("snippet"))


# --------------------------------------------------------------------------
# LEX-*
# --------------------------------------------------------------------------

def _lex_sql():
    return _w(RV) + f""",
s AS (SELECT review_id, {D.lex_raw('text')} AS r, {D.lex_negated('text')} AS n,
             {D.lex_intensified('text')} AS i, {D.lex_contrast('text')} AS c FROM reviews)
SELECT review_id, round(r, 6) AS afinn_raw, round(n, 6) AS afinn_negated, round(i, 6) AS afinn_intensified,
       round(c, 6) AS afinn_contrast,
       round(greatest(r, 0.0), 6) AS sent_pos_raw, round(abs(least(r, 0.0)), 6) AS sent_neg_raw,
       round(greatest(n, 0.0), 6) AS sent_pos_negated, round(abs(least(n, 0.0)), 6) AS sent_neg_negated,
       round(greatest(i, 0.0), 6) AS sent_pos_intensified, round(abs(least(i, 0.0)), 6) AS sent_neg_intensified
FROM s"""


@register("lexicon_scores", _lex_sql)
def q_lexicon_scores(spark, d):
    """LEX-1..6: four lexicon scores and the six non-negative features."""
    rv = reviews(spark, d)
    rec = rv.select("review_id", L.score_record(F.col("text")).alias("s"))
    s = F.col("s")
    out = [F.round(s[k], 6).alias(k) for k in ("afinn_raw", "afinn_negated", "afinn_intensified", "afinn_contrast")]
    for name, key in (("raw", "afinn_raw"), ("negated", "afinn_negated"), ("intensified", "afinn_intensified")):
        out.append(F.round(F.greatest(s[key], F.lit(0.0)), 6).alias(f"sent_pos_{name}"))
        out.append(F.round(F.abs(F.least(s[key], F.lit(0.0))), 6).alias(f"sent_neg_{name}"))
    return rec.select("review_id", *out)


def _doc_lex_sql():
    return f"""WITH s AS (SELECT doc_id, {D.lex_raw('text')} AS r, {D.lex_negated('text')} AS n,
             {D.lex_intensified('text')} AS i, {D.lex_contrast('text')} AS c FROM documents)
SELECT doc_id, round(r, 6) AS afinn_raw, round(n, 6) AS afinn_negated, round(i, 6) AS afinn_intensified,
       round(c, 6) AS afinn_contrast FROM s"""


@register("document_lexicon_scores", _doc_lex_sql)
def q_document_lexicon_scores(spark, d):
    """LEX-1..4 on whole ``documents``, whatever their length."""
    docs = fence(table(spark, d, "documents").select("doc_id", "text"))
    s = F.col("s")
    return (docs.select("doc_id", L.score_record(F.col("text")).alias("s"))
            .select("doc_id", *[F.round(s[k], 6).alias(k) for k in
                                ("afinn_raw", "afinn_negated", "afinn_intensified", "afinn_contrast")]))


@register("conversation_clean_text", lambda: f"""SELECT conv_id, turn, {D.clean('text')} AS clean_text,
{D.token_count(D.clean('text'))}::INT AS n_tokens FROM conversations""")
def q_conversation_clean_text(spark, d):
    """TXT-1/2/5 on every turn of ``conversations``."""
    ct = table(spark, d, "conversations").select("conv_id", "turn", T.clean_text(F.col("text")).alias("clean_text"))
    return ct.withColumn("n_tokens", T.token_count(F.col("clean_text")))


@register("lexicon_by_rating", lambda: _w(RV) + f"""
SELECT rating, count(*)::BIGINT AS n, round(avg({D.lex_raw('text')}), 6) AS avg_raw,
       round(avg({D.lex_negated('text')}), 6) AS avg_negated
FROM reviews GROUP BY rating""")
def q_lexicon_by_rating(spark, d):
    """LEX-1/2 aggregated per star rating (relational check of the lexicon
    against the stars)."""
    rv = reviews(spark, d)
    return rv.groupBy("rating").agg(F.count(F.lit(1)).alias("n"),
                                    F.round(F.avg(L.raw_score(F.col("text"))), 6).alias("avg_raw"),
                                    F.round(F.avg(L.negated_score(F.col("text"))), 6).alias("avg_negated"))


# --------------------------------------------------------------------------
# RUL-1..4
# --------------------------------------------------------------------------

def _tags_sql():
    kw = dict(K.ISSUE_KEYWORDS)
    specific = [lb for lb, _ in K.ISSUE_KEYWORDS]
    items = ", ".join(f"CASE WHEN {D.keyword_hit('ct', kw[lb])} THEN {D.q(lb)} END" for lb in specific)
    return _w(RV) + f""",
a AS (SELECT review_id, {D.clean('text')} AS ct FROM reviews),
b AS (SELECT review_id, list_filter([{items}], lambda x: x IS NOT NULL) AS hits FROM a)
SELECT review_id, CASE WHEN len(hits) > 0 THEN array_to_string(hits, '|') ELSE 'other' END AS suggested_tags,
       len(hits) > 0 AS complaint_signal
FROM b"""


@register("issue_tags", _tags_sql)
def q_issue_tags(spark, d):
    """RUL-1/2 on the cleaned text: pipe-joined suggested labels."""
    rv = reviews(spark, d).select("review_id", T.clean_text(F.col("text")).alias("ct"))
    tags = R.keyword_tags(F.col("ct"))
    return rv.select("review_id", R.labels_to_pipe(tags).alias("suggested_tags"),
                     R.complaint_signal(F.col("ct")).alias("complaint_signal"))


@register("complaint_unnegated", lambda: _w(RV) + f""",
a AS (SELECT review_id, lower(coalesce(text, '')) AS tl FROM reviews)
SELECT review_id, {D.has_complaint('tl')} AS has_complaint,
       array_to_string({D.complaint_groups('tl')}, '|') AS complaint_groups,
       {D.complaint_count('tl')} AS complaint_count
FROM a""")
def q_complaint_unnegated(spark, d):
    """RUL-3/4: complaint words without a negation in the 15 characters
    before them; categories and distinct keyword count."""
    rv = reviews(spark, d).select("review_id", F.lower(F.coalesce(F.col("text"), F.lit(""))).alias("tl"))
    return rv.select("review_id", R.has_complaint(F.col("tl")).alias("has_complaint"),
                     F.array_join(R.complaint_groups(F.col("tl")), "|").alias("complaint_groups"),
                     R.complaint_count(F.col("tl")).alias("complaint_count"))


# --------------------------------------------------------------------------
# RUL-7..21 / TOP-1 / AGG-11,14,16
# --------------------------------------------------------------------------

@register("triage_cascade", lambda: _w(RV, SC, PR) + """
SELECT review_id, label, round(probability, 6) AS probability, confidence, reason, mixed_signal,
       issue_summary, issue_count, risk_score
FROM predictions""")
def q_triage_cascade(spark, d):
    """RUL-5..9, RUL-16, RUL-21 over every non-blank review."""
    p = predictions(spark, d)
    return p.select("review_id", "label", F.round("probability", 6).alias("probability"), "confidence",
                    "reason", "mixed_signal", "issue_summary", "issue_count", "risk_score")


@register("risk_score", lambda: _w(RV, SC, PR) + """,
n AS (SELECT review_id, risk_score, greatest(0, least(100, floor(risk_score / 4.2 + 0.5)::INT)) AS normalized_risk
      FROM predictions)
SELECT review_id, risk_score, normalized_risk,
       CASE WHEN normalized_risk >= 85 THEN 'Critical' WHEN normalized_risk >= 60 THEN 'High' ELSE 'Monitor' END AS risk_tier,
       CASE WHEN normalized_risk >= 80 THEN 'new' WHEN normalized_risk >= 55 THEN 'in_progress' ELSE 'resolved' END AS workflow_state
FROM n""")
def q_risk_score(spark, d):
    """RUL-16/17/19: raw and normalized risk, tier, initial ticket state."""
    p = predictions(spark, d).select("review_id", "risk_score")
    n = R.normalized_risk(F.col("risk_score"))
    return p.select("review_id", "risk_score", n.alias("normalized_risk"), R.risk_tier(n).alias("risk_tier"),
                    R.workflow_state(n).alias("workflow_state"))


def _playbook_sql():
    vals = ", ".join(f"({D.q(a)}, {D.q(b)}, {D.q(c)})" for a, b, c in K.PLAYBOOK)
    labels = D.qlist(K.ISSUE_LABELS)
    return _w(RV, SC, PR) + f""",
pb AS (SELECT * FROM (VALUES {vals}) t(primary_issue, owner, outcome)),
k AS (SELECT review_id, risk_score,
             list_filter(list_transform(string_split(trim(issue_summary), ','), lambda s: trim(split_part(trim(s), ':', 1))),
                         lambda s: s <> '' AND list_contains({labels}, s)) AS keys
      FROM predictions),
m AS (SELECT review_id, coalesce(keys[1], 'other') AS primary_issue,
             greatest(0, least(100, floor(risk_score / 4.2 + 0.5)::INT)) AS nr FROM k)
SELECT m.review_id, m.primary_issue, coalesce(pb.owner, {D.q(K.PLAYBOOK_DEFAULT[0])}) AS owner,
       coalesce(pb.outcome, {D.q(K.PLAYBOOK_DEFAULT[1])}) AS outcome,
       CASE WHEN nr >= 85 THEN 'Respond in 2h' WHEN nr >= 60 THEN 'Respond in 8h' ELSE 'Monitor in 24h' END AS sla
FROM m LEFT JOIN pb ON pb.primary_issue = m.primary_issue"""


@register("playbook_route", _playbook_sql)
def q_playbook_route(spark, d):
    """RUL-18/21: primary issue from the summary string → owner, outcome
    (the fixed 7-row routing table), SLA by risk."""
    p = predictions(spark, d).select("review_id", "risk_score", "issue_summary")
    keys = R.parse_issue_keys(F.col("issue_summary"))
    primary = F.coalesce(F.try_element_at(keys, F.lit(1)), F.lit("other"))
    base = p.select("review_id", primary.alias("issue"), R.normalized_risk(F.col("risk_score")).alias("_nr"))
    out = TR.with_playbook(base, F.col("issue"), F.col("_nr"))
    return out.select("review_id", F.col("issue").alias("primary_issue"), "owner", "outcome", "sla")


@register("attention_queue", lambda: _w(RV, SC, PR) + """
SELECT review_id, label, round(probability, 6) AS probability, issue_summary, risk_score
FROM predictions WHERE label IN ('NEGATIVE', 'NEEDS_ATTENTION', 'UNCERTAIN')
ORDER BY risk_score DESC, probability ASC NULLS LAST, review_id ASC LIMIT 20""")
def q_attention_queue(spark, d):
    """TOP-1: top 20 flagged reviews by risk (a top-k is the feature)."""
    p = predictions(spark, d)
    q = TR.attention_queue(p, 20)
    return q.select("review_id", "label", F.round("probability", 6).alias("probability"), "issue_summary",
                    "risk_score")


@register("issue_summary", lambda: _w(RV, SC, PR) + """
SELECT r AS label, count(*)::BIGINT AS count, round(avg(0.75::DOUBLE), 3) AS avg_confidence
FROM (SELECT unnest(issue_labels) AS r FROM predictions) GROUP BY r""")
def q_issue_summary(spark, d):
    """AGG-11: resolved issue labels → count and mean confidence."""
    return TR.issue_summary(predictions(spark, d), "issue_rows")


@register("issue_mix", lambda: _w(RV, SC, PR) + f""",
k AS (SELECT list_filter(list_transform(string_split(trim(issue_summary), ','), lambda s: trim(split_part(trim(s), ':', 1))),
                         lambda s: s <> '' AND list_contains({D.qlist(K.ISSUE_LABELS)}, s)) AS keys FROM predictions)
SELECT l AS label, (SELECT count(*) FILTER (WHERE list_contains(keys, l)) FROM k)::BIGINT AS count
FROM (SELECT unnest({D.qlist(K.ISSUE_LABELS)}) AS l)""")
def q_issue_mix(spark, d):
    """AGG-14: rows per issue label parsed from the summaries, zero-filled."""
    p = predictions(spark, d).select(R.parse_issue_keys(F.col("issue_summary")).alias("issue_keys"))
    return TR.issue_mix(p)


@register("mismatch_by_stars", lambda: _w(RV, SC, PR) + """
SELECT CASE WHEN rating >= 4 THEN 'high_star' ELSE 'low_star' END AS star_bucket, count(*)::BIGINT AS total,
       count(*) FILTER (WHERE label <> 'POSITIVE' OR issue_count > 0)::BIGINT AS risk,
       count(*) FILTER (WHERE NOT (label <> 'POSITIVE' OR issue_count > 0))::BIGINT AS clean,
       count(*) FILTER (WHERE (label <> 'POSITIVE' OR issue_count > 0) AND rating >= 4)::BIGINT AS hidden_risk
FROM predictions GROUP BY 1""")
def q_mismatch_by_stars(spark, d):
    """AGG-16: star bucket × NLP risk, hidden risk among 4-5 stars."""
    p = predictions(spark, d)
    stars = R.normalized_rating(F.col("rating"))
    return TR.mismatch_summary(p, stars, F.col("label"), F.col("issue_count"))


@register("mismatch_by_segment", lambda: _w(RV, SC, PR) + """,
per_order AS (
  SELECT l_orderkey, CASE WHEN rating >= 4 THEN 'high_star' ELSE 'low_star' END AS star_bucket,
         count(*) AS total, count(*) FILTER (WHERE label <> 'POSITIVE' OR issue_count > 0) AS risk
  FROM predictions GROUP BY 1, 2)
SELECT c.c_mktsegment AS segment, star_bucket, sum(total)::BIGINT AS total, sum(risk)::BIGINT AS risk,
       sum(total - risk)::BIGINT AS clean
FROM per_order po JOIN orders o ON o.o_orderkey = po.l_orderkey JOIN customer c ON c.c_custkey = o.o_custkey
GROUP BY 1, 2""")
def q_mismatch_by_segment(spark, d):
    """AGG-16 by customer market segment (JOIN-5): pre-aggregate per order
    before joining orders and customer, so the join input shrinks to one
    row per (order, bucket); join strategy is left to the size-checked
    broadcast threshold and AQE."""
    p = predictions(spark, d)
    stars = R.normalized_rating(F.col("rating"))
    risk = TR.has_nlp_risk(F.col("label"), F.col("issue_count"))
    per_order = (p.groupBy("l_orderkey", F.when(stars >= 4, "high_star").otherwise("low_star").alias("star_bucket"))
                 .agg(F.count(F.lit(1)).alias("total"), F.count_if(risk).alias("risk")))
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    cust = table(spark, d, "customer").select("c_custkey", "c_mktsegment")
    j = (per_order.join(orders, per_order.l_orderkey == orders.o_orderkey)
         .join(cust, orders.o_custkey == cust.c_custkey))
    return (j.groupBy(F.col("c_mktsegment").alias("segment"), "star_bucket")
            .agg(F.sum("total").alias("total"), F.sum("risk").alias("risk"),
                 F.sum(F.col("total") - F.col("risk")).alias("clean")))


@register("fallback_predictions", lambda: _w(RV, D.issue_scores_cte) + f""",
b AS (SELECT r.review_id, r.rating AS stars, {' + '.join(f"t._truth_{lb}::INT" for lb in K.ISSUE_LABELS)} AS issues,
             concat_ws(', ', {', '.join(f"CASE WHEN t._truth_{lb} THEN {D.q(lb)} END" for lb in K.ISSUE_LABELS)}) AS names
      FROM reviews r JOIN is_t t ON r.review_id = t.review_id)
SELECT review_id,
       CASE WHEN stars >= 4 THEN 'POSITIVE' WHEN stars = 3 THEN 'UNCERTAIN' WHEN stars = 2 THEN 'NEEDS_ATTENTION' ELSE 'NEGATIVE' END AS label,
       round(stars::DOUBLE / 5.0::DOUBLE, 6) AS probability, issues::INT AS issue_count,
       CASE WHEN issues = 0 THEN '-' ELSE names END AS issue_summary,
       greatest(0, (6 - stars) * 70 + 18 * issues)::INT AS risk_score
FROM b""")
def q_fallback_predictions(spark, d):
    """RUL-12/20/21: predictions from the dataset alone (p = stars/5; issue
    count and summary from the review's issue flags; risk from stars and
    count)."""
    rated = with_issue_truth(reviews(spark, d).select("review_id", "rating", "text"))
    flags = fence(rated.select("review_id", "rating", F.array(*[F.col(f"_truth_{lb}").cast("int") for lb in K.ISSUE_LABELS]).alias("flags")),
                  "flags")
    stars = R.normalized_rating(F.col("rating"))
    issues = F.aggregate("flags", F.lit(0), lambda total, f: total + f)
    return flags.select("review_id", R.sentiment_from_rating(F.col("rating")).alias("label"),
                        F.round(stars / 5.0, 6).alias("probability"), issues.alias("issue_count"),
                        R.summary_from_flags([F.col("flags")[i] for i in range(len(K.ISSUE_LABELS))]).alias("issue_summary"),
                        F.greatest(F.lit(0), (F.lit(6) - stars) * 70 + 18 * issues).cast("int").alias("risk_score"))


@register("queue_priority", lambda: _w(RV, D.stage1_cte) + f""",
a AS (SELECT review_id, label, stage1_prob, {D.clean('text')} AS ct FROM stage1
      WHERE label IN ('NEGATIVE', 'NEEDS_ATTENTION')),
b AS (SELECT *, 1.0 - least(1.0, abs(stage1_prob - 0.5) * 2.0)
               + CASE WHEN label = 'NEEDS_ATTENTION' THEN 0.15 ELSE 0.05 END
               + CASE WHEN {' OR '.join(f"contains(' ' || lower(ct) || ' ', {D.q(m)})" for m in K.QUEUE_CONTRAST_MARKERS)} THEN 0.10 ELSE 0.0 END
               + CASE WHEN {D.token_count('ct')} < 3 THEN -0.20 ELSE 0.0 END AS s FROM a)
SELECT review_id, label, stage1_prob, greatest(0.0, round(s, 6)) AS queue_priority FROM b""")
def q_queue_priority(spark, d):
    """RUL-13/15: queue-only stage-1 rows and their annotation priority."""
    s = stage1(spark, d).where(F.col("label").isin("NEGATIVE", "NEEDS_ATTENTION"))
    ct = T.clean_text(F.col("text"))
    return s.select("review_id", "label", "stage1_prob",
                    R.queue_priority(ct, F.col("label"), F.col("stage1_prob")).alias("queue_priority"))


@register("issue_attachment", lambda: _w(RV, SC, PR) + """
SELECT CASE WHEN label IN ('NEGATIVE', 'NEEDS_ATTENTION') THEN 'missing' ELSE 'not_applicable' END AS issue_model_status,
       label, count(*)::BIGINT AS n, sum(issue_count)::BIGINT AS issues
FROM predictions GROUP BY 1, 2""")
def q_issue_attachment(spark, d):
    """RUL-8: issue-model status per cascade label (no trained issue model
    in the batch path → ``missing`` for flagged rows) with issue counts."""
    p = predictions(spark, d)
    st = R.issue_attachment_status(F.col("label"), model_trained=False)
    return p.groupBy(st.alias("issue_model_status"), "label").agg(F.count(F.lit(1)).alias("n"),
                                                                  F.sum("issue_count").alias("issues"))


@register("model_stage1_distribution", lambda: _dist_sql((RV, SC), "m1s").replace(
    "c AS (SELECT label", "m1s AS (SELECT CASE WHEN p <= 0.40 THEN 'NEGATIVE' WHEN " + D.keyword_hit("text", [
        p for _, ps in K.ISSUE_KEYWORDS for p in ps]) + " THEN 'NEEDS_ATTENTION' WHEN p >= 0.60 THEN 'POSITIVE' "
    "ELSE 'UNCERTAIN' END AS label FROM scored_reviews),\nc AS (SELECT label", 1))
def q_model_stage1_distribution(spark, d):
    """RUL-14: stage-1 labels from a model probability and the raw-text
    complaint signal, as a zero-filled distribution."""
    from ..sources.fixtures import scored_reviews
    sr = scored_reviews(spark, d).withColumn("_cmp", R.complaint_signal(F.col("text")))
    return TR.label_distribution(sr.select(R.stage1_from_model(F.col("p"), F.col("_cmp")).alias("label")))
