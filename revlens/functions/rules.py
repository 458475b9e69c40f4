"""Rule and decision operators as Spark column expressions (RUL-*, DEC-*).

All of them are ``CASE`` trees, ``rlike`` tests and array higher-order
functions over columns of one row, so they evaluate inside the scan's
codegen stage with no shuffle and no Python.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import constants as K
from .text import keyword_padded, token_count, tokens_ws

WS = r"[\t\n\x0B\f\r ]"


def strip_ws(c: Column) -> Column:
    """Python ``str.strip()`` for ASCII whitespace."""
    return F.regexp_replace(F.coalesce(c, F.lit("")), f"^{WS}+|{WS}+$", "")


# --------------------------------------------------------------------------
# RUL-1 / RUL-2: issue keyword tags
# --------------------------------------------------------------------------

def phrase_pattern(phrases: Sequence[str]) -> str:
    """`` (?:p1|p2|…) `` — true iff some `` phrase `` occurs in the padded
    text, i.e. the OR of the substring tests, in one regex scan."""
    return " (?:" + "|".join(re.escape(p) for p in phrases) + ") "


def keyword_label_hits(c: Column, keywords=K.ISSUE_KEYWORDS) -> list[tuple[str, Column]]:
    padded = keyword_padded(c)
    return [(label, padded.rlike(phrase_pattern(phrases))) for label, phrases in keywords]


def keyword_tags(c: Column, keywords=K.ISSUE_KEYWORDS, fallback: str = "other") -> Column:
    """RUL-1: labels whose phrase occurs as ``" phrase "`` in ``" text "``;
    ``[fallback]`` when none."""
    hits = F.filter(F.array(*[F.when(h, F.lit(lbl)) for lbl, h in keyword_label_hits(c, keywords)]),
                    lambda x: x.isNotNull())
    return F.when(F.size(hits) > 0, hits).otherwise(F.array(F.lit(fallback)))


def labels_to_pipe(arr: Column) -> Column:
    return F.concat_ws("|", arr)


def complaint_signal(c: Column, keywords=K.ISSUE_KEYWORDS) -> Column:
    """RUL-2: any specific (non-``other``) keyword label."""
    return keyword_padded(c).rlike(phrase_pattern([p for _, ps in keywords for p in ps]))


# --------------------------------------------------------------------------
# RUL-3 / RUL-4: complaint words not preceded by a negation phrase
# --------------------------------------------------------------------------

def unnegated_pattern(words: Sequence[str], negations=K.COMPLAINT_NEGATIONS,
                      lookback: int = K.COMPLAINT_LOOKBACK) -> str:
    """One Java regex with a bounded negative look-behind per negation
    phrase: the phrase must lie wholly inside the ``lookback`` characters
    before the match start."""
    behind = "".join(
        f"(?<!{re.escape(n)}.{{0,{lookback - len(n)}}})" for n in negations if len(n) <= lookback)
    alt = "(?:" + "|".join(re.escape(w) for w in words) + ")"
    # The look-ahead fails fast at most positions, so the look-behinds only
    # run where a complaint word starts.
    return "(?s)(?=" + alt + ")" + behind


def real_complaint(text_lower: Column, words: Sequence[str]) -> Column:
    """RUL-3 (``text_lower`` must already be lower case)."""
    return F.coalesce(text_lower.rlike(unnegated_pattern(words)), F.lit(False))


def all_complaint_words(groups=K.COMPLAINT_GROUPS) -> list[str]:
    return [w for _, ws in groups for w in ws]


def slang_positive(text_lower: Column) -> Column:
    hit = F.lit(False)
    for s in K.SLANG_EXCLUSIONS:
        hit = hit | text_lower.contains(s)
    return hit


def has_complaint(text_lower: Column) -> Column:
    return real_complaint(text_lower, all_complaint_words()) & ~slang_positive(text_lower)


def complaint_groups(text_lower: Column, groups=K.COMPLAINT_GROUPS) -> Column:
    """RUL-4: complaint categories hit (empty unless ``has_complaint``)."""
    arr = F.filter(F.array(*[F.when(real_complaint(text_lower, ws), F.lit(g)) for g, ws in groups]),
                   lambda x: x.isNotNull())
    return F.when(has_complaint(text_lower), arr).otherwise(F.array().cast("array<string>"))


def complaint_count(text_lower: Column, groups=K.COMPLAINT_GROUPS) -> Column:
    """RUL-4: number of complaint words present as substrings."""
    total = F.lit(0)
    for w in all_complaint_words(groups):
        total = total + text_lower.contains(w).cast("int")
    return total


def contrast_substring(text_lower: Column, markers=K.CASCADE_CONTRAST_MARKERS) -> Column:
    hit = F.lit(False)
    for m in markers:
        hit = hit | text_lower.contains(m)
    return hit


# --------------------------------------------------------------------------
# DEC-1..3: abstention rule
# --------------------------------------------------------------------------

def abstain_decision(p: Column, clean: Column, nnz: Column | None,
                     lo: float = K.DEFAULT_THRESHOLDS[0], hi: float = K.DEFAULT_THRESHOLDS[1],
                     min_nnz: int = K.MIN_NNZ_DEFAULT) -> tuple[Column, Column]:
    """DEC-1 (DEC-2 with ``nnz=None``): (decision -1/0/1, reason)."""
    n_tok = token_count(clean)
    short = (n_tok < 2) | (F.trim(clean) == "")
    sparse = (nnz < F.lit(min_nnz)) if nnz is not None else F.lit(False)
    decision = (F.when(short | sparse, F.lit(-1))
                .when(p >= F.lit(hi), F.lit(1)).when(p <= F.lit(lo), F.lit(0)).otherwise(F.lit(-1)))
    reason = (F.when(short, F.lit("too_short")).when(sparse, F.lit("sparse_vector"))
              .when((p >= F.lit(hi)) | (p <= F.lit(lo)), F.lit(None).cast("string"))
              .otherwise(F.lit("threshold_band")))
    return decision, reason


def decision_name(decision: Column) -> Column:
    """DEC-3."""
    return (F.when(decision == 1, "POSITIVE").when(decision == 0, "NEGATIVE").otherwise("UNCERTAIN"))


def sigmoid(x: Column) -> Column:
    """DEC-6: clip to ±20 then logistic."""
    z = F.least(F.lit(20.0), F.greatest(F.lit(-20.0), x.cast("double")))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


# --------------------------------------------------------------------------
# RUL-5..7: triage cascade
# --------------------------------------------------------------------------

RATIO_RE = r"^([0-9]+)[\t\n\x0B\f\r ]*/[\t\n\x0B\f\r ]*([0-9]+)$"


def with_triage_cascade(df, text: str = "text", p: str = "p", nnz: str = "nnz", clean: str = "clean_text",
                        lo: float = K.DEFAULT_THRESHOLDS[0], hi: float = K.DEFAULT_THRESHOLDS[1],
                        min_nnz: int = K.MIN_NNZ_DEFAULT, out: str = "c"):
    """RUL-7: ordered cascade → struct column ``out`` (label, probability,
    confidence, reason, issue_tags, mixed_signal); ``p`` is the model's
    positive probability.

    The row tests (complaint regex, contrast, groups, ratio, abstention)
    are staged as columns first: each is referenced by several cascade
    branches, and staging keeps Catalyst from re-evaluating them per
    branch.
    """
    from pyspark.sql import DataFrame  # noqa: F401
    pc = F.col(p)
    st = df.withColumn("_tl", F.lower(F.coalesce(F.col(text), F.lit(""))))
    st = st.withColumn("_tc", F.lower(strip_ws(F.col(text))))
    num = F.regexp_extract(F.col("_tc"), RATIO_RE, 1).try_cast("double")
    den = F.regexp_extract(F.col("_tc"), RATIO_RE, 2).try_cast("double")
    decision, reason = abstain_decision(pc, F.col(clean), F.col(nnz), lo, hi, min_nnz)
    st = st.withColumn(
        "_cmp", real_complaint(F.col("_tl"), all_complaint_words()) & ~slang_positive(F.col("_tl")))
    # the seven per-group scans only matter for rows with a complaint
    groups = F.filter(F.array(*[F.when(real_complaint(F.col("_tl"), ws), F.lit(g)) for g, ws in K.COMPLAINT_GROUPS]),
                      lambda x: x.isNotNull())
    st = st.select(
        "*",
        contrast_substring(F.col("_tl")).alias("_ctr"),
        complaint_count(F.col("_tl")).alias("_ncw"),
        F.when(F.col("_cmp"), groups).otherwise(F.array().cast("array<string>")).alias("_grp0"),
        F.col("_tc").rlike(RATIO_RE).alias("_isratio"),
        F.when(den > 0, num / den).otherwise(F.lit(0.5)).alias("_ratio"),
        decision.alias("_dec"), reason.alias("_why"))
    empty = F.array().cast("array<string>")
    cmp_, ctr, grp, dec = F.col("_cmp"), F.col("_ctr"), F.when(F.col("_cmp"), F.col("_grp0")).otherwise(empty), F.col("_dec")

    def rec(label, prob, conf, why, tags, mixed):
        return F.struct((F.lit(label) if isinstance(label, str) else label).alias("label"),
                        prob.cast("double").alias("probability"),
                        (F.lit(conf) if isinstance(conf, str) else conf).alias("confidence"),
                        (F.lit(why) if isinstance(why, str) or why is None else why).cast("string").alias("reason"),
                        tags.alias("issue_tags"), mixed.alias("mixed_signal"))

    ratio = F.col("_ratio")
    ratio_label = F.when(ratio >= 0.7, "POSITIVE").when(ratio <= 0.4, "NEGATIVE").otherwise("NEEDS_ATTENTION")
    tc = F.col("_tc")
    cascade = (
        F.when(tc.isin(*K.SINGLE_WORD_POSITIVE),
               rec("POSITIVE", F.when(tc.isin(*K.SINGLE_WORD_OK), F.lit(0.55)).otherwise(F.lit(0.75)), "Medium",
                   None, empty, F.lit(False)))
        .when(tc.isin(*K.SINGLE_WORD_NEGATIVE), rec("NEGATIVE", F.lit(0.15), "Medium", None, empty, F.lit(False)))
        .when(F.col("_isratio"), rec(ratio_label, ratio, "Medium", "rating_detected", empty, F.lit(False)))
        .when(pc <= F.lit(K.CASCADE_NEGATIVE_CUTOFF), rec("NEGATIVE", pc, "High", None, grp, ctr & cmp_))
        .when((pc >= F.lit(K.CASCADE_CONFIDENT_POSITIVE)) & cmp_ & (F.col("_ncw") == 1) & ~ctr,
              rec("POSITIVE", pc, "High", "very_confident_positive", grp, F.lit(False)))
        .when(cmp_, rec("NEEDS_ATTENTION", pc, "Medium", "has_complaint_keyword", grp, ctr & cmp_))
        .otherwise(rec(decision_name(dec), F.when(dec != -1, pc),
                       F.when(dec != -1, F.lit("High")).otherwise(F.lit("Low")), F.col("_why"), empty,
                       F.lit(False))))
    return st.withColumn(out, cascade).drop("_tl", "_tc", "_cmp", "_ctr", "_ncw", "_grp0", "_isratio", "_ratio",
                                            "_dec", "_why")


def issue_attachment_status(label: Column, model_trained: bool = False) -> Column:
    """RUL-8: issue model status for a cascade label."""
    flagged = label.isin("NEGATIVE", "NEEDS_ATTENTION")
    return F.when(flagged, F.lit("trained" if model_trained else "missing")).otherwise("not_applicable")


def resolve_issue_labels(trained: Column, tags: Column) -> Column:
    """RUL-9: keep trained labels when specific; else map rule tags.

    ``trained``: array<struct<label,confidence,threshold>>; ``tags``:
    array<string> of complaint groups.
    """
    mapping = F.create_map(*[x for k, v in K.ISSUE_TAG_TO_LABEL for x in (F.lit(k), F.lit(v))])
    specific_trained = F.exists(trained, lambda r: (r["label"] != "") & (r["label"] != "other"))
    mapped = F.array_distinct(F.filter(
        F.transform(tags, lambda t: F.try_element_at(mapping, F.lower(F.trim(t)))), lambda x: x.isNotNull()))
    specific_rule = F.filter(mapped, lambda x: x != "other")
    best_other = F.array_max(F.transform(F.filter(trained, lambda r: r["label"] == "other"),
                                         lambda r: r["confidence"].cast("double")))
    conf = F.when(best_other.isNull(), F.lit(0.75)).otherwise(
        F.greatest(F.lit(0.55), F.least(F.lit(0.95), best_other - F.lit(0.05))))
    rule_rows = F.transform(specific_rule, lambda lbl: F.struct(
        lbl.alias("label"), conf.alias("confidence"), F.lit(0.5).alias("threshold")))
    return F.when(specific_trained | (F.size(specific_rule) == 0), trained).otherwise(rule_rows)


# --------------------------------------------------------------------------
# RUL-11..21: triage helpers
# --------------------------------------------------------------------------

def taxonomy_category(text: Column) -> Column:
    """RUL-11: error-taxonomy cascade on a raw text."""
    raw = F.coalesce(text, F.lit(""))
    padded = F.concat(F.lit(" "), F.lower(raw), F.lit(" "))
    n_tok = F.size(tokens_ws(F.trim(F.regexp_replace(raw, r"[\t\n\x0B\f\r ]+", " "))))
    punct = F.length(raw) - F.length(F.regexp_replace(raw, r"[!?.,;:]", ""))
    alpha = F.length(raw) - F.length(F.regexp_replace(raw, r"\p{L}", ""))

    def any_sub(words):
        h = F.lit(False)
        for w in words:
            h = h | padded.contains(w)
        return h

    return (F.when(n_tok < 3, "short_text")
            .when(any_sub(K.TAXONOMY_SLANG), "slang_or_abbrev")
            .when(any_sub(K.TAXONOMY_NEGATION), "negation_pattern")
            .when(any_sub(K.TAXONOMY_CONTRAST), "contrast_pattern")
            .when(any_sub(K.TAXONOMY_DOMAIN), "domain_issue_term")
            .when(punct >= F.greatest(F.lit(3), F.floor(alpha * 0.3).cast("int")), "punctuation_heavy")
            .otherwise("other"))


def sentiment_from_rating(rating: Column) -> Column:
    """RUL-12."""
    r = normalized_rating(rating)
    return F.when(r >= 4, "POSITIVE").when(r == 3, "UNCERTAIN").when(r == 2, "NEEDS_ATTENTION").otherwise("NEGATIVE")


def stars_from_label(label: Column, p: Column) -> Column:
    """RUL-12 (inverse)."""
    return (F.when(label == "POSITIVE", 5).when(label == "NEGATIVE", 1).when(label == "NEEDS_ATTENTION", 2)
            .when(label == "UNCERTAIN", 3).when(p.isNull() | F.isnan(p), 3)
            .otherwise(F.greatest(F.lit(1), F.least(F.lit(5), F.floor(p * 5 + 0.5).cast("int")))))


def normalized_rating(raw: Column) -> Column:
    """SRC-6: clamp(round(x), 1, 5), unparsable → 3 (half to even)."""
    d = raw.cast("string").try_cast("double")
    r = F.when(d.isNull() | F.isnan(d), F.lit(3.0)).otherwise(F.bround(d, 0))
    return F.greatest(F.lit(1), F.least(F.lit(5), r)).cast("int")


def normalized_flag(raw: Column) -> Column:
    """SRC-7: ``>= 1`` → 1, anything else or unparsable → 0."""
    d = F.trim(raw.cast("string")).try_cast("double")
    return F.coalesce((d >= 1).cast("int"), F.lit(0))


def stage1_prob(rating: Column, complaint: Column) -> Column:
    """RUL-13 probability: rating ≤2 → .20; complaint → .45; ≥4 → .80; else .50."""
    r = F.coalesce(rating.cast("double"), F.lit(3.0))
    return (F.when(r <= 2.0, F.lit(0.20)).when(complaint, F.lit(0.45))
            .when(r >= 4.0, F.lit(0.80)).otherwise(F.lit(0.50)))


def stage1_label(p: Column, complaint: Column) -> Column:
    """RUL-13 label from the stage-1 probability."""
    return (F.when(p <= 0.40, "NEGATIVE").when(complaint, "NEEDS_ATTENTION")
            .when(p >= 0.60, "POSITIVE").otherwise("UNCERTAIN"))


def stage1_from_rating(rating: Column, complaint: Column) -> tuple[Column, Column]:
    """RUL-13: (label, prob).  Stage ``complaint`` as a column first when
    it is an expensive expression (it is referenced several times)."""
    p = stage1_prob(rating, complaint)
    return stage1_label(p, complaint), p


def stage1_from_model(p: Column, complaint: Column) -> Column:
    """RUL-14: model-probability policy."""
    return (F.when(p <= 0.40, "NEGATIVE").when(complaint, "NEEDS_ATTENTION")
            .when(p >= 0.60, "POSITIVE").otherwise("UNCERTAIN"))


def queue_priority(clean: Column, label: Column, p: Column) -> Column:
    """RUL-15: uncertainty + label bonus + contrast bonus − short penalty."""
    margin = F.abs(p.cast("double") - F.lit(0.5))
    unc = F.lit(1.0) - F.least(F.lit(1.0), margin * 2.0)
    padded = F.concat(F.lit(" "), F.lower(clean), F.lit(" "))
    contrast = F.lit(False)
    for m in K.QUEUE_CONTRAST_MARKERS:
        contrast = contrast | padded.contains(m)
    score = (unc + F.when(label == "NEEDS_ATTENTION", 0.15).otherwise(0.05)
             + F.when(contrast, 0.10).otherwise(0.0)
             + F.when(token_count(clean) < 3, -0.20).otherwise(0.0))
    return F.greatest(F.lit(0.0), F.round(score, 6))


def label_priority(label: Column) -> Column:
    expr = None
    for lbl, pr in K.LABEL_PRIORITY:
        expr = F.when(label == lbl, F.lit(pr)) if expr is None else expr.when(label == lbl, F.lit(pr))
    return expr.otherwise(F.lit(0))


def round1(x: Column) -> Column:
    """Round to one decimal, ties to the even digit."""
    return F.rint(x * 10.0) / 10.0


def risk_score(label: Column, p: Column) -> Column:
    """RUL-16."""
    prob = F.when(p.isNull(), F.lit(0.5)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), p)))
    sev = (F.when(label == "NEGATIVE", (F.lit(1.0) - prob) * 20.0)
           .when(label == "NEEDS_ATTENTION", (F.lit(0.8) - F.abs(prob - 0.5)) * 15.0)
           .when(label == "UNCERTAIN", F.lit(10.0))
           .otherwise(prob * 5.0))
    return round1(label_priority(label) * 100.0 + F.greatest(sev, F.lit(0.0)))


def normalized_risk(raw: Column) -> Column:
    """RUL-17: clamp(round(raw / 4.2), 0, 100) with JS half-up rounding."""
    return F.greatest(F.lit(0), F.least(F.lit(100), F.floor(raw / 4.2 + 0.5).cast("int")))


def risk_tier(norm: Column) -> Column:
    return F.when(norm >= 85, "Critical").when(norm >= 60, "High").otherwise("Monitor")


def sla(norm: Column) -> Column:
    """RUL-18 SLA part."""
    return F.when(norm >= 85, "Respond in 2h").when(norm >= 60, "Respond in 8h").otherwise("Monitor in 24h")


def workflow_state(norm: Column) -> Column:
    """RUL-19."""
    return F.when(norm >= 80, "new").when(norm >= 55, "in_progress").otherwise("resolved")


def parse_issue_keys(summary: Column, labels=K.ISSUE_LABELS) -> Column:
    """RUL-21: ``"a:0.83, b"`` → known label keys in order."""
    raw = F.trim(F.coalesce(summary, F.lit("")))
    parts = F.transform(F.split(raw, ","), lambda s: F.trim(F.split(F.trim(s), ":")[0]))
    lbls = F.array(*[F.lit(x) for x in labels])
    keys = F.filter(parts, lambda s: (s != "") & F.array_contains(lbls, s))
    return F.when((raw == "") | (raw == "-"), F.array().cast("array<string>")).otherwise(keys)


def issue_summary(rows: Column, tags: Column) -> Column:
    """RUL-21: ``label:0.83, …`` from trained rows, else tags, else ``-``."""
    from_rows = F.array_join(F.transform(rows, lambda r: F.concat(
        r["label"], F.lit(":"), F.format_number(r["confidence"], 2))), ", ")
    return (F.when(F.size(rows) > 0, from_rows).when(F.size(tags) > 0, F.array_join(tags, ", "))
            .otherwise(F.lit("-")))


def summary_from_flags(flag_cols: Sequence[Column], labels=K.ISSUE_LABELS) -> Column:
    """Issue summary from 0/1 flags (``issueSummaryFromFlags``)."""
    act = F.filter(F.array(*[F.when(f >= 1, F.lit(lbl)) for f, lbl in zip(flag_cols, labels)]),
                   lambda x: x.isNotNull())
    return F.when(F.size(act) > 0, F.array_join(act, ", ")).otherwise(F.lit("-"))
