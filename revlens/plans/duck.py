"""DuckDB twins of the fixture views and column expressions.

Used only to build ``oracle_sql()`` strings for the correctness gate:
each oracle inlines the fixture CTEs over the base tables and re-states
the operator in DuckDB's dialect (``lambda x:`` syntax, ``//`` integer
division, 1-based lists, RE2 regexes).
"""

from __future__ import annotations

import re

from ..functions import constants as K
from ..sources.fixtures import CONNECTORS, NEG_PHRASES, NEU_PHRASES, POS_PHRASES, STATUSES


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def qlist(xs) -> str:
    return "[" + ", ".join(q(x) for x in xs) + "]"


def qin(xs) -> str:
    return "(" + ", ".join(q(x) for x in xs) + ")"


def hex8(hx: str, start: int) -> str:
    return f"('0x' || substr({hx}, {start}, 8))::BIGINT"


def h(tag_sql: str, key: str = "review_id") -> str:
    return hex8(f"md5(concat_ws('|', {tag_sql}, {key}))", 1)


def u(tag_sql: str, key: str = "review_id") -> str:
    return f"({h(tag_sql, key)} / 4294967296.0::DOUBLE)"


# --------------------------------------------------------------------------
# text expressions
# --------------------------------------------------------------------------

def clean(x: str, abbrev: bool = False, negation: bool = False, window: int = 3) -> str:
    t = f"lower(coalesce({x}, ''))"
    t = f"regexp_replace({t}, {q(K.URL_PATTERN)}, ' ', 'g')"
    if abbrev:
        t = abbrev_sql(t)
    if negation:
        t = negation_tag(t, window)
    t = f"regexp_replace({t}, {q(K.PUNCT_CLASS)}, ' ', 'g')"
    return f"trim(regexp_replace({t}, {q(K.WS_CLASS)}, ' ', 'g'))"


def tokens_ws(x: str) -> str:
    return f"list_filter(string_split({x}, ' '), lambda w: w <> '')"


def token_count(x: str) -> str:
    return f"len({tokens_ws(x)})"


def abbrev_sql(t: str, mapping=K.ABBREVIATIONS) -> str:
    pat = r"\b(" + "|".join(re.escape(k) for k, _ in mapping) + r")\b"
    case = "CASE mm[i] " + " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in mapping) + " ELSE mm[i] END"
    return (f"(SELECT array_to_string(list_transform(string_split_regex(tt, {q(pat)}), "
            f"lambda p, i: p || coalesce({case}, '')), '') "
            f"FROM (SELECT tt, regexp_extract_all(tt, {q(pat)}) AS mm FROM (SELECT {t} AS tt)))")


def negation_tag(t: str, window: int = 3, cues=K.TAGGER_NEGATION_CUES) -> str:
    cl = qlist(cues)
    bd = qin(K.TAGGER_BOUNDARIES)
    return (
        f"(SELECT array_to_string(list_filter(list_transform(tk, lambda x, i: CASE "
        f"WHEN x IN {bd} THEN NULL WHEN list_contains({cl}, x) THEN x "
        f"WHEN coalesce(list_contains({cl}, list_filter(list_slice(tk, greatest(1, i - {window}), i - 1), "
        f"lambda y: y IN {bd} OR list_contains({cl}, y))[-1]), false) THEN 'NOT_' || x ELSE x END), "
        f"lambda x: x IS NOT NULL), ' ') "
        f"FROM (SELECT regexp_extract_all(lower({t}), {q(K.TAGGER_TOKEN_PATTERN)}) AS tk))")


def padded(x: str) -> str:
    return f"(' ' || lower(coalesce({x}, '')) || ' ')"


def keyword_hit(x: str, phrases) -> str:
    pd = padded(x)
    return "(" + " OR ".join(f"contains({pd}, {q(' ' + p + ' ')})" for p in phrases) + ")"


# --------------------------------------------------------------------------
# lexicon
# --------------------------------------------------------------------------

def lex_tokens(x: str) -> str:
    return f"regexp_extract_all(lower(coalesce({x}, '')), {q(K.LEXICON_TOKEN_PATTERN)})"


def lex_score(t: str, lexicon=K.LEXICON) -> str:
    groups: dict = {}
    for w, v in lexicon:
        groups.setdefault(v, []).append(w)
    parts = [f"WHEN {t} IN {qin(ws)} THEN {float(v)}::DOUBLE" for v, ws in sorted(groups.items()) if v != 0]
    return "(CASE " + " ".join(parts) + " ELSE 0.0::DOUBLE END)"


def is_cue(t: str) -> str:
    return f"({t} IN {qin(K.LEXICON_NEGATION_CUES)} OR suffix({t}, 'n''t'))"


def is_scope_end(t: str) -> str:
    return f"({t} IN {qin(K.LEXICON_SCOPE_ENDERS)} OR {t} IN {qin(K.LEXICON_CONTRAST_MARKERS)})"


def mult(t: str, pairs) -> str:
    return "(CASE " + " ".join(f"WHEN {t} = {q(w)} THEN {float(v)}::DOUBLE" for w, v in pairs) + " END)"


def lex_raw(x: str) -> str:
    return (f"(SELECT list_reduce(tk, lambda a, t: a + {lex_score('t')}, 0.0::DOUBLE) "
            f"FROM (SELECT {lex_tokens(x)} AS tk))")


def lex_negated(x: str, window: int = 3) -> str:
    last = (f"list_filter(list_slice(tk, greatest(1, i - {window}), i - 1), "
            f"lambda y: {is_scope_end('y')} OR {is_cue('y')})[-1]")
    contrib = (f"CASE WHEN {is_scope_end('t')} OR {is_cue('t')} THEN 0.0::DOUBLE "
               f"WHEN coalesce({is_cue(last)} AND NOT {is_scope_end(last)}, false) THEN -{lex_score('t')} "
               f"ELSE {lex_score('t')} END")
    return (f"(SELECT list_reduce(list_transform(tk, lambda t, i: {contrib}), lambda a, v: a + v, 0.0::DOUBLE) "
            f"FROM (SELECT {lex_tokens(x)} AS tk))")


def lex_intensified(x: str, window: int = 3) -> str:
    ints = [w for w, _ in K.INTENSIFIERS]
    dims = [w for w, _ in K.DIMINISHERS]
    lexw = [w for w, _ in K.LEXICON]
    w = f"({lex_score('t')} * st.m)"
    step = (
        f"CASE WHEN {is_scope_end('t')} THEN {{'s': st.s, 'n': 0, 'm': 1.0::DOUBLE}} "
        f"WHEN {is_cue('t')} THEN {{'s': st.s, 'n': {window}, 'm': st.m}} "
        f"WHEN t IN {qin(ints)} THEN {{'s': st.s, 'n': st.n, 'm': {mult('t', K.INTENSIFIERS)}}} "
        f"WHEN t IN {qin(dims)} THEN {{'s': st.s, 'n': st.n, 'm': {mult('t', K.DIMINISHERS)}}} "
        f"ELSE {{'s': CASE WHEN t IN {qin(lexw)} THEN st.s + CASE WHEN st.n > 0 THEN -{w} ELSE {w} END ELSE st.s END, "
        f"'n': CASE WHEN st.n > 0 THEN st.n - 1 ELSE st.n END, "
        f"'m': CASE WHEN t IN {qin(lexw)} THEN 1.0::DOUBLE ELSE st.m END}} END")
    return (f"(SELECT list_reduce(tk, lambda st, t: {step}, {{'s': 0.0::DOUBLE, 'n': 0, 'm': 1.0::DOUBLE}}).s "
            f"FROM (SELECT {lex_tokens(x)} AS tk))")


def lex_contrast(x: str, weight: float = 2.0) -> str:
    mk = qin(K.LEXICON_CONTRAST_MARKERS)
    return (
        f"(SELECT CASE WHEN ix > 0 THEN pre + {weight}::DOUBLE * post ELSE pre END FROM ("
        f"SELECT ix, list_reduce(list_transform(tk, lambda t, i: CASE WHEN ix = 0 OR i < ix THEN {lex_score('t')} "
        f"ELSE 0.0::DOUBLE END), lambda a, v: a + v, 0.0::DOUBLE) AS pre, "
        f"list_reduce(list_transform(tk, lambda t, i: CASE WHEN ix > 0 AND i > ix THEN {lex_score('t')} "
        f"ELSE 0.0::DOUBLE END), lambda a, v: a + v, 0.0::DOUBLE) AS post FROM ("
        f"SELECT tk, coalesce(list_position(list_transform(tk, lambda t: t IN {mk}), true), 0) AS ix "
        f"FROM (SELECT {lex_tokens(x)} AS tk))))")


# --------------------------------------------------------------------------
# rules
# --------------------------------------------------------------------------

def real_complaint(tl: str, words, negations=K.COMPLAINT_NEGATIONS, lookback: int = K.COMPLAINT_LOOKBACK) -> str:
    """Position scan: a complaint word starts at i and none of the negation
    phrases occurs in the ``lookback`` characters before i."""
    kw = "^(?:" + "|".join(re.escape(w) for w in words) + ")"
    ng = "|".join(re.escape(n) for n in negations)
    return (f"(len(list_filter(range(1, length({tl}) + 1), lambda i: "
            f"regexp_matches(substr({tl}, i), {q(kw)}) AND NOT regexp_matches("
            f"substr({tl}, greatest(1, i - {lookback}), i - greatest(1, i - {lookback})), {q(ng)}))) > 0)")


def all_words():
    return [w for _, ws in K.COMPLAINT_GROUPS for w in ws]


def has_complaint(tl: str) -> str:
    slang = " OR ".join(f"contains({tl}, {q(s)})" for s in K.SLANG_EXCLUSIONS)
    return f"({real_complaint(tl, all_words())} AND NOT ({slang}))"


def complaint_count(tl: str) -> str:
    return "(" + " + ".join(f"contains({tl}, {q(w)})::INT" for w in all_words()) + ")"


def complaint_groups(tl: str) -> str:
    items = ", ".join(f"CASE WHEN {real_complaint(tl, ws)} THEN {q(g)} END" for g, ws in K.COMPLAINT_GROUPS)
    return f"(CASE WHEN {has_complaint(tl)} THEN list_filter([{items}], lambda g: g IS NOT NULL) ELSE []::VARCHAR[] END)"


def round1(x: str) -> str:
    return f"(round_even(({x})::DOUBLE * 10.0::DOUBLE, 0) / 10.0::DOUBLE)"


def label_priority(lbl: str) -> str:
    return "(CASE " + " ".join(f"WHEN {lbl} = {q(a)} THEN {b}" for a, b in K.LABEL_PRIORITY) + " ELSE 0 END)"


def risk(lbl: str, p: str) -> str:
    prob = f"(CASE WHEN {p} IS NULL THEN 0.5 ELSE greatest(0.0, least(1.0, {p})) END)"
    sev = (f"(CASE WHEN {lbl} = 'NEGATIVE' THEN (1.0 - {prob}) * 20.0 "
           f"WHEN {lbl} = 'NEEDS_ATTENTION' THEN (0.8 - abs({prob} - 0.5)) * 15.0 "
           f"WHEN {lbl} = 'UNCERTAIN' THEN 10.0 ELSE {prob} * 5.0 END)")
    return round1(f"{label_priority(lbl)} * 100.0 + greatest({sev}, 0.0)")


# --------------------------------------------------------------------------
# fixture CTEs
# --------------------------------------------------------------------------

def reviews_cte() -> str:
    lists = f"[{qlist(NEG_PHRASES)}, {qlist(NEU_PHRASES)}, {qlist(POS_PHRASES)}]"
    return f"""
rv_0 AS (
  SELECT concat_ws('-', l_orderkey::VARCHAR, l_linenumber::VARCHAR, l_partkey::VARCHAR, l_suppkey::VARCHAR) AS review_id,
         l_orderkey, l_partkey, l_suppkey, l_shipdate AS review_ts
  FROM lineitem),
rv_1 AS (
  SELECT *, md5(concat_ws('|', 'reviews', review_id)) AS hx FROM rv_0),
rv_2 AS (
  SELECT *, {hex8('hx', 1)} % 100 AS _r, {hex8('hx', 9)} AS _h2, {hex8('hx', 17)} AS _h3, {hex8('hx', 25)} AS _h4
  FROM rv_1),
rv_3 AS (
  SELECT *, CASE WHEN _r < 8 THEN 1 WHEN _r < 10 THEN 2 WHEN _r < 12 THEN 3 WHEN _r < 17 THEN 4 ELSE 5 END AS rating
  FROM rv_2),
rv_4 AS (
  SELECT *, (CASE WHEN _h4 % 100 < 15 THEN (_h4 // 100) % 3 WHEN rating <= 2 THEN 0 WHEN rating = 3 THEN 1
                  ELSE 2 END)::BIGINT AS tone
  FROM rv_3),
reviews AS (
  SELECT review_id, l_orderkey, l_partkey, l_suppkey, review_ts, rating, tone,
         CASE WHEN (_h2 // 16) % 40 = 0 THEN NULL
              WHEN _h3 % 20 = 0 THEN ({lists})[tone + 1][_h2 % 16 + 1]
              ELSE ({lists})[tone + 1][_h2 % 16 + 1]
                   || ({qlist(CONNECTORS)})[(_h3 // 20) % 8 + 1]
                   || ({lists})[(CASE WHEN (_h3 // 160) % 10 < 7 THEN tone ELSE 1 END) + 1][(_h4 // 300) % 16 + 1]
         END AS text
  FROM rv_4)"""


def scored_cte() -> str:
    base = "(CASE WHEN tone = 0 THEN 0.25::DOUBLE WHEN tone = 1 THEN 0.55::DOUBLE ELSE 0.85::DOUBLE END)"

    def clamp(x):
        return f"least(0.999::DOUBLE, greatest(0.001::DOUBLE, {x}))"

    return f"""
sr_0 AS (
  SELECT review_id, l_orderkey, l_partkey, l_suppkey, rating, tone, text, {clean('text')} AS clean_text
  FROM reviews),
scored_reviews AS (
  SELECT *, CASE WHEN rating <= 2 THEN 0 WHEN rating >= 4 THEN 1 ELSE NULL END AS y,
         {clamp(f"{base} + ({u(q('p1'))} - 0.5::DOUBLE) * 0.6::DOUBLE")} AS p,
         {clamp(f"{base} + ({u(q('p2'))} - 0.5::DOUBLE) * 0.8::DOUBLE")} AS p2,
         len(list_distinct({tokens_ws('clean_text')})) AS nnz,
         CASE WHEN {u(q('split'))} < 0.7 THEN 'train' WHEN {u(q('split'))} < 0.8 THEN 'val' ELSE 'test' END AS split
  FROM sr_0)"""


def truth_cte(src: str, name: str, extra_key: str | None = None) -> str:
    """``_hit_<label>`` / ``_truth_<label>`` columns over ``src`` (needs
    review_id and text)."""
    specific = [lb for lb in K.ISSUE_LABELS if lb != "other"]
    kw = dict(K.ISSUE_KEYWORDS)
    hits = ", ".join(f"{keyword_hit('_clean', kw[lb])} AS _hit_{lb}" for lb in specific)
    truths = ", ".join(f"(_hit_{lb} <> ({u(q('t_' + lb))} < 0.03)) AS _truth_{lb}" for lb in specific)
    any_hit = " OR ".join(f"_hit_{lb}" for lb in specific)
    any_truth = " OR ".join(f"_truth_{lb}" for lb in specific)
    return f"""
{name}_a AS (SELECT *, {clean('text')} AS _clean FROM {src}),
{name}_b AS (SELECT *, {hits} FROM {name}_a),
{name}_c AS (SELECT *, NOT ({any_hit}) AS _hit_other, {truths} FROM {name}_b),
{name} AS (SELECT *, NOT ({any_truth}) AS _truth_other FROM {name}_c)"""


def issue_scores_cte() -> str:
    def score(tag, lb):
        return (f"least(0.99::DOUBLE, greatest(0.01::DOUBLE, 0.10::DOUBLE + 0.55::DOUBLE * _hit_{lb}::INT::DOUBLE "
                f"+ 0.35::DOUBLE * {u(q(tag + lb))}))")

    unions = "\nUNION ALL ".join(
        f"SELECT review_id, {q(lb)} AS label, {score('s_', lb)} AS score, {score('s2_', lb)} AS score2, "
        f"_truth_{lb}::INT AS truth FROM is_t" for lb in K.ISSUE_LABELS)
    return truth_cte("(SELECT review_id, text FROM reviews)", "is_t") + f""",
issue_scores AS ({unions})"""


def label_batches_cte() -> str:
    def hc(tag):
        return h(f"{q(tag)} || copy::VARCHAR")

    cells = []
    for lb in K.ISSUE_LABELS:
        v = u(f"{q('l_' + lb + '_')} || copy::VARCHAR")
        t = f"_truth_{lb}::INT"
        cells.append(f"CASE WHEN {v} < 0.01 THEN '2' WHEN {v} < 0.03 THEN NULL WHEN {v} < 0.08 "
                     f"THEN (1 - {t})::VARCHAR ELSE {t}::VARCHAR END AS {lb}")
    ann = f"({h(q('id'))})::VARCHAR"
    return f"""
lb_0 AS (SELECT review_id, rating, text FROM reviews),
lb_1 AS (SELECT *, unnest(range(1, 1 + (1 + {h(q('n'))} % 3)::INT)) AS copy FROM lb_0),""" + truth_cte(
        "lb_1", "lb_t") + f""",
label_batches AS (
  SELECT review_id,
         CASE WHEN {hc('w')} % 3 = 0 THEN {ann} WHEN {hc('w')} % 3 = 1 THEN {ann} || '.0' ELSE ' ' || {ann} || ' ' END AS id,
         rating::VARCHAR AS rating, text,
         'batch_' || ({hc('f')} % 7)::VARCHAR || '.csv' AS source_file,
         TIMESTAMP '2024-01-01 00:00:00' + to_hours(({hc('m')} % 1000)::INT) AS source_mtime,
         {hc('o')} % 100000 AS row_order,
         'a' || ({hc('a')} % 5)::VARCHAR AS annotator,
         ({qlist(STATUSES)})[{hc('st')} % 5 + 1] AS annotation_status,
         {', '.join(cells)}
  FROM lb_t)"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


def stage1_cte() -> str:
    specific = [p for _, ps in K.ISSUE_KEYWORDS for p in ps]
    return f"""
st_0 AS (SELECT *, {keyword_hit('text', specific)} AS _cmp FROM reviews),
st_1 AS (SELECT *, CASE WHEN coalesce(rating, 3) <= 2 THEN 0.20::DOUBLE WHEN _cmp THEN 0.45::DOUBLE
                        WHEN coalesce(rating, 3) >= 4 THEN 0.80::DOUBLE ELSE 0.50::DOUBLE END AS stage1_prob
         FROM st_0),
stage1 AS (SELECT *, CASE WHEN stage1_prob <= 0.40 THEN 'NEGATIVE' WHEN _cmp THEN 'NEEDS_ATTENTION'
                          WHEN stage1_prob >= 0.60 THEN 'POSITIVE' ELSE 'UNCERTAIN' END AS label
           FROM st_1)"""


WS_STRIP = r"^[\t\n\x0B\f\r ]+|[\t\n\x0B\f\r ]+$"
RATIO_RE = r"^([0-9]+)[\t\n\x0B\f\r ]*/[\t\n\x0B\f\r ]*([0-9]+)$"


def predictions_cte() -> str:
    """Needs ``scored_cte``.  Mirrors ``views.predictions``."""
    m = " ".join(f"WHEN g = {q(a)} THEN {q(b)}" for a, b in K.ISSUE_TAG_TO_LABEL)
    ratio = (f"(CASE WHEN TRY_CAST(regexp_extract(text_l, {q(RATIO_RE)}, 2) AS DOUBLE) > 0 "
             f"THEN TRY_CAST(regexp_extract(text_l, {q(RATIO_RE)}, 1) AS DOUBLE) / TRY_CAST(regexp_extract(text_l, {q(RATIO_RE)}, 2) AS DOUBLE) "
             f"ELSE 0.5::DOUBLE END)")
    return f"""
pr_0 AS (
  SELECT review_id, l_orderkey, l_partkey, l_suppkey, rating, regexp_replace(coalesce(text, ''), {q(WS_STRIP)}, '', 'g') AS text,
         clean_text, p, p2, nnz, y, split
  FROM scored_reviews
  WHERE regexp_replace(coalesce(text, ''), {q(WS_STRIP)}, '', 'g') <> ''),
pr_1 AS (
  SELECT *, lower(text) AS text_l FROM pr_0),
pr_2 AS (
  SELECT *, {has_complaint('text_l')} AS _cmp,
         ({' OR '.join(f"contains(text_l, {q(mk)})" for mk in K.CASCADE_CONTRAST_MARKERS)}) AS _ctr,
         {complaint_count('text_l')} AS _ncw, {complaint_groups('text_l')} AS _grp,
         {ratio} AS _ratio, regexp_matches(text_l, {q(RATIO_RE)}) AS _isratio,
         ({token_count('clean_text')} < 2 OR trim(clean_text) = '') AS _short, nnz < {K.MIN_NNZ_DEFAULT} AS _sparse
  FROM pr_1),
pr_3 AS (
  SELECT *, CASE WHEN _short OR _sparse THEN -1 WHEN p >= {K.DEFAULT_THRESHOLDS[1]} THEN 1
                 WHEN p <= {K.DEFAULT_THRESHOLDS[0]} THEN 0 ELSE -1 END AS _dec,
         CASE WHEN text_l IN {qin(K.SINGLE_WORD_POSITIVE)} THEN 1 WHEN text_l IN {qin(K.SINGLE_WORD_NEGATIVE)} THEN 2
              WHEN _isratio THEN 3 WHEN p <= {K.CASCADE_NEGATIVE_CUTOFF} THEN 4
              WHEN p >= {K.CASCADE_CONFIDENT_POSITIVE} AND _cmp AND _ncw = 1 AND NOT _ctr THEN 5
              WHEN _cmp THEN 6 ELSE 7 END AS _branch
  FROM pr_2),
pr_4 AS (
  SELECT *,
    CASE _branch WHEN 1 THEN 'POSITIVE' WHEN 2 THEN 'NEGATIVE'
         WHEN 3 THEN CASE WHEN _ratio >= 0.7 THEN 'POSITIVE' WHEN _ratio <= 0.4 THEN 'NEGATIVE' ELSE 'NEEDS_ATTENTION' END
         WHEN 4 THEN 'NEGATIVE' WHEN 5 THEN 'POSITIVE' WHEN 6 THEN 'NEEDS_ATTENTION'
         ELSE CASE _dec WHEN 1 THEN 'POSITIVE' WHEN 0 THEN 'NEGATIVE' ELSE 'UNCERTAIN' END END AS label,
    CASE _branch WHEN 1 THEN CASE WHEN text_l IN {qin(K.SINGLE_WORD_OK)} THEN 0.55::DOUBLE ELSE 0.75::DOUBLE END
         WHEN 2 THEN 0.15::DOUBLE WHEN 3 THEN _ratio WHEN 7 THEN CASE WHEN _dec <> -1 THEN p END ELSE p END AS probability,
    CASE WHEN _branch IN (1, 2, 3, 6) THEN 'Medium' WHEN _branch IN (4, 5) THEN 'High'
         WHEN _dec <> -1 THEN 'High' ELSE 'Low' END AS confidence,
    coalesce(CASE _branch WHEN 3 THEN 'rating_detected' WHEN 5 THEN 'very_confident_positive'
         WHEN 6 THEN 'has_complaint_keyword'
         WHEN 7 THEN CASE WHEN _short THEN 'too_short' WHEN _sparse THEN 'sparse_vector'
                          WHEN _dec = -1 THEN 'threshold_band' END END, '-') AS reason,
    CASE WHEN _branch IN (4, 6) THEN _ctr AND _cmp ELSE false END AS mixed_signal,
    CASE WHEN _branch IN (4, 5, 6) THEN _grp ELSE []::VARCHAR[] END AS issue_tags
  FROM pr_3),
pr_5 AS (
  SELECT *, list_filter(list_transform(issue_tags, lambda g: CASE {m} END), lambda x: x IS NOT NULL) AS _mapped
  FROM pr_4),
pr_6 AS (
  SELECT *, list_filter(_mapped, lambda x, i: list_position(_mapped, x) = i AND x <> 'other') AS _specific
  FROM pr_5),
predictions AS (
  SELECT review_id, l_orderkey, l_partkey, l_suppkey, rating, text, clean_text, p, p2, nnz, y, split,
         label, probability, confidence, reason, mixed_signal, issue_tags, _specific AS issue_labels,
         CASE WHEN len(_specific) > 0 THEN array_to_string(list_transform(_specific, lambda x: x || ':0.75'), ', ')
              WHEN len(issue_tags) > 0 THEN array_to_string(issue_tags, ', ') ELSE '-' END AS issue_summary,
         CASE WHEN len(_specific) > 0 THEN len(_specific) ELSE len(issue_tags) END AS issue_count,
         {risk('label', 'probability')} AS risk_score
  FROM pr_6)"""
