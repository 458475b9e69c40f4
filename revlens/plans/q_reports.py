"""Registered reporting queries: scoreboard, baselines, stability,
agreement, multi-label predictions, triage KPIs, short-text guard,
sampling and splitting, character n-grams and id encoding."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions import rules as R
from ..functions.text import raw_token_count, tokens_ws
from ..operators import metrics as M
from ..operators import triage as TR
from ..session import checkpoint_dir
from ..sources.fixtures import issue_rows, scored_reviews, u
from . import duck as D
from .q_eval import IS_LONG, _binary_sql, _is_long, _long, dec_sql, r
from .registry import register
from .views import predictions

RV, SC, IS, PR = D.reviews_cte, D.scored_cte, D.issue_scores_cte, D.predictions_cte
LABELS = K.ISSUE_LABELS


def _w(*ctes):
    return D.with_ctes(*[c() for c in ctes])


# --------------------------------------------------------------------------
# SET-1/2 + TOP-5: scoreboard
# --------------------------------------------------------------------------

def _scoreboard_sql():
    bm = _binary_sql()
    ctes, bsel = bm.split("\nSELECT model, split, (tp1", 1)
    bsel = "SELECT model, split, (tp1" + bsel
    rest = ctes[len(D.with_ctes(RV(), SC())):]
    return D.with_ctes(RV(), SC(), IS()) + rest + f""",
{IS_LONG},
pl AS (SELECT model, label, count(*) FILTER (WHERE truth = 1 AND s >= 0.5) AS tp,
              count(*) FILTER (WHERE truth = 0 AND s >= 0.5) AS fp, count(*) FILTER (WHERE truth = 1 AND s < 0.5) AS fn
       FROM is_long GROUP BY model, label),
lb AS (SELECT model, sum(tp) AS tp, sum(fp) AS fp, sum(fn) AS fn, avg({r('2 * tp', '2 * tp + fp + fn')}) AS macro_f1
       FROM pl GROUP BY model),
bsel AS ({bsel}),
msel AS (SELECT model, 'all' AS split, round({r('2 * tp', '2 * tp + fp + fn')}, 6) AS micro_f1, round(macro_f1, 6) AS macro_f1 FROM lb)
SELECT 'sentiment' AS task, model, split, recall_0, precision_0, f2_0, round(1.0::DOUBLE - recall_0, 6) AS missed_negative_rate,
       NULL::DOUBLE AS micro_f1, NULL::DOUBLE AS macro_f1 FROM bsel
UNION ALL
SELECT 'issue_multilabel', model, split, NULL, NULL, NULL, NULL, micro_f1, macro_f1 FROM msel"""


@register("metric_scoreboard", _scoreboard_sql)
def q_metric_scoreboard(spark, d):
    """SET-1/2: sentiment metric rows and multi-label metric rows unioned
    by name (missing columns NULL), with missed-negative rate."""
    bm = M.binary_metrics(_long(spark, d)).select(
        F.lit("sentiment").alias("task"), "model", "split", "recall_0", "precision_0", "f2_0",
        F.round(F.lit(1.0) - F.col("recall_0"), 6).alias("missed_negative_rate"))
    ml = M.multilabel_metrics(_is_long(spark, d), F.col("s") >= 0.5).select(
        F.lit("issue_multilabel").alias("task"), "model", F.lit("all").alias("split"), "micro_f1", "macro_f1")
    return bm.unionByName(ml, allowMissingColumns=True)


@register("f1_stability", lambda: _w(RV, IS) + ",\n" + IS_LONG + f""",
c AS (SELECT model, label, count(*) FILTER (WHERE truth = 1 AND s >= 0.5) AS tp,
             count(*) FILTER (WHERE truth = 0 AND s >= 0.5) AS fp, count(*) FILTER (WHERE truth = 1 AND s < 0.5) AS fn
      FROM is_long GROUP BY model, label),
f AS (SELECT model, {r('2 * tp', '2 * tp + fp + fn')} AS f1 FROM c)
SELECT model, round(avg(f1), 6) AS mean_f1, round(stddev_samp(f1), 6) AS std_f1 FROM f GROUP BY model""")
def q_f1_stability(spark, d):
    """AGG-19: mean and sample std of per-label F1 per model."""
    per = M.per_label_metrics(_is_long(spark, d), F.col("s") >= 0.5)
    return M.stability_summary(per, ["model"], "f1")


def _code_sql(flag: str) -> str:
    parts = ", ".join(f"CASE WHEN bool_or(label = {D.q(lb)} AND {flag}) THEN {D.q(lb)} END" for lb in LABELS)
    return f"coalesce(nullif(array_to_string(list_filter([{parts}], lambda x: x IS NOT NULL), '|'), ''), 'none')"


def _dummy_sql():
    return _w(RV, IS) + f""",
codes AS (SELECT review_id, {_code_sql('truth = 1')} AS code FROM issue_scores GROUP BY review_id),
maj AS (SELECT code FROM codes GROUP BY code ORDER BY count(*) DESC, code ASC LIMIT 1),
prior AS (SELECT label, avg(truth) AS prev FROM issue_scores GROUP BY label),
pri AS (SELECT label, CASE WHEN (SELECT count(*) FROM prior WHERE prev >= 0.5) > 0 THEN (prev >= 0.5)
                           ELSE label = (SELECT arg_max(label, [prev, -(list_position({D.qlist(LABELS)}, label))::DOUBLE]) FROM prior) END AS hit
        FROM prior),
pred AS (SELECT s.review_id, s.label, s.truth, list_contains(string_split((SELECT code FROM maj), '|'), s.label) AS p_major,
                p.hit AS p_prior FROM issue_scores s JOIN pri p USING (label)),
agg AS (SELECT 'labelset_majority' AS model, count(*) FILTER (WHERE truth = 1 AND p_major) AS tp,
               count(*) FILTER (WHERE truth = 0 AND p_major) AS fp, count(*) FILTER (WHERE truth = 1 AND NOT p_major) AS fn FROM pred
        UNION ALL
        SELECT 'label_prior', count(*) FILTER (WHERE truth = 1 AND p_prior), count(*) FILTER (WHERE truth = 0 AND p_prior),
               count(*) FILTER (WHERE truth = 1 AND NOT p_prior) FROM pred)
SELECT model, (SELECT code FROM maj) AS majority_code, round({r('2 * tp', '2 * tp + fp + fn')}, 6) AS micro_f1 FROM agg"""


def _label_codes(truths):
    """(review_id, code): the true labels of a review in fixed order, ``none`` without any.

    A row's labels are numbered and filtered in the row, so a review's few numbers are shuffled, not its label rows."""
    hits = F.filter(F.transform("v", lambda t, i: F.when(t == 1, i)), lambda i: i.isNotNull())
    per = truths.select("review_id", hits.alias("h")).groupBy("review_id").agg(F.array_sort(F.flatten(F.collect_list("h"))).alias("h"))
    names = F.array(*[F.lit(lb) for lb in LABELS])
    code = F.array_join(F.transform("h", lambda i: F.element_at(names, i + 1)), "|")
    return per.select("review_id", F.coalesce(F.nullif(code, F.lit("")), F.lit("none")).alias("code"))


@register("dummy_baselines", _dummy_sql)
def q_dummy_baselines(spark, d):
    """AGG-21: label-set majority (most frequent true label set, code as
    tie-break) and label-prior (prevalence ≥ .5, else the most prevalent
    label) baselines, micro-F1 against the truth."""
    truths = issue_rows(spark, d).select("review_id", F.array(*[F.col(f"truth_{lb}") for lb in LABELS]).alias("v"))
    pos = {lb: i for i, lb in enumerate(LABELS)}
    top = _label_codes(truths).groupBy("code").count().orderBy(F.col("count").desc(), F.col("code").asc()).first()["code"]
    # Rows by truth vector: at most one for each set of labels, whatever the table's size.
    checkpoint_dir(spark)
    sets = truths.groupBy(F.col("v").alias("v")).agg(F.count(F.lit(1)).alias("n")).checkpoint()
    s = sets.select("n", F.posexplode("v").alias("i", "truth")).select(
        "n", "truth", F.element_at(F.array(*[F.lit(lb) for lb in LABELS]), F.col("i") + 1).alias("label"))
    n = F.col("n")
    prev = {r["label"]: r["prev"] for r in s.groupBy("label").agg((F.sum(F.col("truth") * n) / F.sum(n)).alias("prev")).collect()}
    chosen = {lb for lb, v in prev.items() if v >= 0.5} or {max(prev, key=lambda lb: (prev[lb], -pos[lb]))}
    major = set(top.split("|"))
    t = F.col("truth")
    pm, pp = F.col("label").isin(*major), F.col("label").isin(*chosen)
    rows = F.array(F.struct(F.lit("labelset_majority").alias("model"), pm.alias("p")),
                   F.struct(F.lit("label_prior").alias("model"), pp.alias("p")))
    ex = s.select("truth", "n", F.inline(rows))

    def total(hit):
        return F.sum(F.when(hit, n).otherwise(0))

    c = ex.groupBy("model").agg(total((t == 1) & F.col("p")).alias("tp"), total((t == 0) & F.col("p")).alias("fp"),
                                total((t == 1) & ~F.col("p")).alias("fn"))
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return c.select("model", F.lit(top).alias("majority_code"), F.round(M._ratio(2 * tp, 2 * tp + fp + fn), 6).alias("micro_f1"))


@register("issue_predictions", lambda: _w(RV, IS) + """,
b AS (SELECT review_id, label, 0.5 * score + 0.5 * score2 AS conf FROM issue_scores)
SELECT review_id, coalesce(string_agg(label, '|' ORDER BY conf DESC, label ASC) FILTER (WHERE conf >= 0.5), '') AS predicted,
       count(*) FILTER (WHERE conf >= 0.5)::BIGINT AS n_labels
FROM b GROUP BY review_id""")
def q_issue_predictions(spark, d, alpha: float = 0.5, threshold: float = 0.5):
    """DEC-4/5: blended per-label score α·a + (1−α)·b, labels above the
    threshold ordered by confidence desc (≤ 9 per review)."""
    s = issue_rows(spark, d)
    conf = F.array(*[F.struct((-(F.lit(alpha) * F.col(f"score_{lb}") + F.lit(1.0 - alpha) * F.col(f"score2_{lb}"))).alias("k"),
                              F.lit(lb).alias("l")) for lb in LABELS])
    # Labels below the threshold go before the shuffle; a review's labels travel as one row.
    hits = s.select("review_id", F.filter(conf, lambda x: -x["k"] >= threshold).alias("h"))
    g = hits.groupBy("review_id").agg(F.array_sort(F.flatten(F.collect_list("h"))).alias("h"))
    return g.select("review_id", F.array_join(F.transform("h", lambda x: x["l"]), "|").alias("predicted"),
                    F.size("h").cast("bigint").alias("n_labels"))


@register("model_agreement", lambda: _w(RV, SC) + f""",
d AS (SELECT {dec_sql('p', *K.DEFAULT_THRESHOLDS)[0]} AS a, {dec_sql('p2', *K.DEFAULT_THRESHOLDS)[0]} AS b FROM scored_reviews)
SELECT CASE WHEN a = b THEN 'match' ELSE 'mismatch' END AS agreement, count(*)::BIGINT AS n FROM d GROUP BY 1""")
def q_model_agreement(spark, d):
    """DEC-7: decision agreement of two models (match / mismatch counts)."""
    sr = scored_reviews(spark, d)
    a, _ = R.abstain_decision(F.col("p"), F.col("clean_text"), F.col("nnz"))
    b, _ = R.abstain_decision(F.col("p2"), F.col("clean_text"), F.col("nnz"))
    return sr.select(F.when(a == b, "match").otherwise("mismatch").alias("agreement")).groupBy("agreement").agg(
        F.count(F.lit(1)).alias("n"))


@register("triage_kpis", lambda: _w(RV, SC, PR) + """,
k AS (SELECT unnest(issue_labels) AS l FROM predictions),
top AS (SELECT l FROM k GROUP BY l ORDER BY count(*) DESC, l ASC LIMIT 1)
SELECT count(*)::BIGINT AS total, (SELECT l FROM top) AS top_issue,
       round(count(*) FILTER (WHERE label IN ('NEGATIVE', 'NEEDS_ATTENTION'))::DOUBLE / count(*)::DOUBLE, 6) AS queue_pressure,
       round((count(*) - count(*) FILTER (WHERE label = 'UNCERTAIN'))::DOUBLE / count(*)::DOUBLE, 6) AS automation_rate,
       count(*) FILTER (WHERE (label <> 'POSITIVE' OR issue_count > 0) AND rating >= 4)::BIGINT AS hidden_risk
FROM predictions""")
def q_triage_kpis(spark, d):
    """AGG-17: total, top issue (count desc, name), queue pressure,
    automation rate, hidden risk — one aggregate plus the fixed-label
    issue summary."""
    p = predictions(spark, d)
    lb = F.col("label")
    top = TR.issue_summary(p, "issue_rows").orderBy(F.col("count").desc(), F.col("label").asc()).first()
    k = p.agg(F.count(F.lit(1)).alias("total"),
              F.round(F.count_if(lb.isin("NEGATIVE", "NEEDS_ATTENTION")) / F.count(F.lit(1)), 6).alias("queue_pressure"),
              F.round((F.count(F.lit(1)) - F.count_if(lb == "UNCERTAIN")) / F.count(F.lit(1)), 6).alias("automation_rate"),
              F.count_if(TR.has_nlp_risk(lb, F.col("issue_count")) & (F.col("rating") >= 4)).alias("hidden_risk"))
    return k.select("total", F.lit(top["label"] if top else None).cast("string").alias("top_issue"),
                    "queue_pressure", "automation_rate", "hidden_risk")


@register("short_text_guard", lambda: _w(RV) + f""",
g AS (SELECT review_id, coalesce(text, '') AS t FROM reviews)
SELECT CASE WHEN trim(t) = '' THEN 'too_short'
            WHEN {D.token_count(f"trim(regexp_replace(t, {D.q(K.WS_CLASS)}, ' ', 'g'))")} <= 3
                 AND NOT ({' OR '.join(f"contains(lower(t), {D.q(w)})" for w in K.SENTIMENT_INDICATORS)}) THEN 'no_sentiment'
            ELSE 'model' END AS route, count(*)::BIGINT AS n
FROM g GROUP BY 1""")
def q_short_text_guard(spark, d):
    """RUL-10: guard before a second model: empty → too_short; ≤ 3 words
    without a sentiment indicator substring → no_sentiment."""
    rv = reviews_text(spark, d)
    t = F.coalesce(F.col("text"), F.lit(""))
    ind = F.lit(False)
    for w in K.SENTIMENT_INDICATORS:
        ind = ind | F.lower(t).contains(w)
    route = (F.when(F.trim(t) == "", "too_short").when((raw_token_count(t) <= 3) & ~ind, "no_sentiment")
             .otherwise("model"))
    return rv.groupBy(route.alias("route")).agg(F.count(F.lit(1)).alias("n"))


def reviews_text(spark, d):
    from ..sources.fixtures import reviews
    return reviews(spark, d).select("review_id", "text")


# --------------------------------------------------------------------------
# SPL-3/4/5
# --------------------------------------------------------------------------

@register("stratified_sample", lambda: _w(RV, SC) + """,
s AS (SELECT review_id, y FROM scored_reviews WHERE y IS NOT NULL),
sh AS (SELECT y, greatest(1, round(1000.0 * count(*) / (SELECT count(*) FROM s))::BIGINT) AS k FROM s GROUP BY y),
rk AS (SELECT s.review_id, s.y, row_number() OVER (PARTITION BY s.y ORDER BY md5(concat_ws('|', 'sample', s.review_id)), s.review_id) AS r
       FROM s)
SELECT rk.y, count(*)::BIGINT AS n FROM rk JOIN sh USING (y) WHERE r <= k GROUP BY rk.y""")
def q_stratified_sample(spark, d, n: int = 1000):
    """SPL-4: capped stratified subsample keeping class shares (≥ 1 per
    class): one md5-ordered top-k per class (classes are a fixed pair), so
    no window over a two-valued partition."""
    s = scored_reviews(spark, d).where(F.col("y").isNotNull()).select("review_id", "y")
    counts = {r["y"]: r["count"] for r in s.groupBy("y").count().collect()}  # two scalars
    total = sum(counts.values())
    parts = []
    for y, c in sorted(counts.items()):
        k = max(1, int(round(n * c / total)))
        key = F.md5(F.concat_ws("|", F.lit("sample"), F.col("review_id")))
        parts.append(s.where(F.col("y") == y).orderBy(key, "review_id").limit(k))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.groupBy("y").agg(F.count(F.lit(1)).alias("n"))


@register("uniform_sample", lambda: _w(RV) + """
SELECT review_id, rating FROM reviews ORDER BY md5(concat_ws('|', 'seed42', review_id)), review_id LIMIT 10""")
def q_uniform_sample(spark, d, n: int = 10, seed: str = "seed42"):
    """SPL-5 / TXT-8 sample: seeded uniform sample of ``n`` rows by md5
    order (a sampling operator: the limit is the feature)."""
    from ..sources.fixtures import reviews
    r = reviews(spark, d).select("review_id", "rating")
    return r.orderBy(F.md5(F.concat_ws("|", F.lit(seed), F.col("review_id"))), "review_id").limit(n)


@register("labelset_split", lambda: _w(RV, IS) + f""",
codes AS (SELECT review_id, {_code_sql('truth = 1')} AS code FROM issue_scores GROUP BY review_id),
cc AS (SELECT code, count(*) AS c FROM codes GROUP BY code),
st AS (SELECT c.review_id, CASE WHEN cc.c >= 2 THEN c.code ELSE 'rare' END AS stratum,
              {D.u("'lsplit'", "c.review_id")} AS uu FROM codes c JOIN cc USING (code))
SELECT stratum, CASE WHEN uu < 0.7 THEN 'train' WHEN uu < 0.8 THEN 'val' ELSE 'test' END AS split, count(*)::BIGINT AS n
FROM st GROUP BY 1, 2""")
def q_labelset_split(spark, d):
    """SPL-3: label-set strata (sets seen fewer than twice pooled as
    'rare'), hash split 70/10/20 inside each stratum."""
    truths = issue_rows(spark, d).select("review_id", F.array(*[F.col(f"truth_{lb}") for lb in LABELS]).alias("v"))
    codes = _label_codes(truths).withColumn("uu", u("lsplit", F.col("review_id")))
    sp = F.when(F.col("uu") < 0.7, "train").when(F.col("uu") < 0.8, "val").otherwise("test")
    # Reviews are counted by (set, split) first; how often a set was seen is the sum over its few splits.
    cells = codes.groupBy("code", sp.alias("split")).agg(F.count(F.lit(1)).alias("n"))
    sizes = cells.groupBy("code").agg(F.sum("n").alias("c"), F.collect_list(F.struct("split", "n")).alias("x"))
    st = sizes.select(F.when(F.col("c") >= 2, F.col("code")).otherwise("rare").alias("stratum"), F.inline("x"))
    return st.groupBy("stratum", "split").agg(F.sum("n").alias("n"))


# --------------------------------------------------------------------------
# FEA-2 / FEA-10
# --------------------------------------------------------------------------

@register("char_ngrams", lambda: _w(RV) + f""",
t AS (SELECT {D.clean('text')} AS ct, count(*) AS mult FROM reviews GROUP BY 1),
g AS (SELECT mult, unnest(list_filter(list_transform(range(0, length(ct) * 3),
              lambda j: {{'g': substr(ct, (j // 3) + 1, (j % 3) + 3), 'ok': (j // 3) + (j % 3) + 3 <= length(ct)}}),
              lambda x: x.ok)).g AS gram FROM t)
SELECT gram, sum(mult)::BIGINT AS cf FROM g GROUP BY gram""")
def q_char_ngrams(spark, d):
    """FEA-2: character 3–5-grams of the cleaned text (spaces included; a
    gram must fit inside the text), counted once per *distinct* cleaned
    text and weighted by how many reviews share it, so the explode is
    proportional to distinct texts."""
    from ..functions.text import clean_text
    rv = reviews_text(spark, d)
    t = rv.groupBy(clean_text(F.col("text")).alias("ct")).agg(F.count(F.lit(1)).alias("mult"))
    n = F.length("ct")
    starts = F.sequence(F.lit(0), F.greatest(n * 3 - 1, F.lit(0)))
    cand = F.transform(starts, lambda j: F.struct(
        F.substring("ct", (F.floor(j / 3) + 1).cast("int"), (j % 3 + 3).cast("int")).alias("g"),
        (F.floor(j / 3) + j % 3 + 3 <= n).alias("ok")))
    grams = F.transform(F.filter(cand, lambda x: x["ok"] & (n > 0)), lambda x: x["g"])
    g = t.select("mult", F.explode(grams).alias("gram"))
    return g.groupBy("gram").agg(F.sum("mult").alias("cf"))


@register("vocab_encoding", lambda: _w(RV) + f""",
t AS (SELECT review_id, {D.tokens_ws(D.clean('text'))} AS tk FROM reviews),
w AS (SELECT unnest(tk) AS w FROM t),
v AS (SELECT w, count(*) AS c FROM w GROUP BY w ORDER BY c DESC, w ASC LIMIT 30000),
vw AS (SELECT list(w ORDER BY c DESC, w ASC) AS vw FROM v),
e AS (SELECT review_id, list_transform(tk[1:80], lambda x: CASE WHEN list_contains(vw, x) THEN list_position(vw, x) + 1 ELSE 1 END) AS ids
      FROM t, vw)
SELECT review_id, array_to_string(list_concat(ids, list_transform(range(len(ids), 80), lambda _: 0)), ',') AS encoded FROM e""")
def q_vocab_encoding(spark, d, vocab: int = 30000, length: int = 80):
    """FEA-10: vocabulary index (PAD 0, UNK 1, top ``vocab`` words by count
    from 2) and fixed-length id encoding of the first ``length`` tokens; the
    vocabulary has at most ``vocab`` rows and is broadcast."""
    from pyspark.sql import Window
    from ..functions.text import clean_text
    rv = reviews_text(spark, d).select("review_id", tokens_ws(clean_text(F.col("text"))).alias("tk"))
    top = (rv.select(F.explode("tk").alias("w")).groupBy("w").count()
           .orderBy(F.col("count").desc(), F.col("w").asc()).limit(vocab))
    ranked = top.select("w", (F.row_number().over(Window.orderBy(F.col("count").desc(), F.col("w").asc())) + 1).alias("id"))
    # a review id can occur twice: rows are told apart by their place in the scan
    each = rv.withColumn("row", F.monotonically_increasing_id()).select("row", "review_id", F.posexplode_outer(F.slice("tk", 1, length)).alias("pos", "w"))
    ids = (each.join(F.broadcast(ranked), "w", "left").groupBy("row", "review_id")
           .agg(F.sort_array(F.collect_list(F.when(F.col("pos").isNotNull(), F.struct("pos", F.coalesce("id", F.lit(1)).alias("id"))))).alias("x")))
    padded = F.concat(F.transform("x", lambda x: x["id"]), F.array_repeat(F.lit(0), F.lit(length) - F.size("x")))
    return ids.select("review_id", F.array_join(padded, ",").alias("encoded"))


@register("model_deltas", lambda: _binary_sql().replace("\nSELECT model, split, (tp1", "\n, bm AS (SELECT model, split, (tp1", 1)
          .replace("f1_1\nFROM c", "f1_1\nFROM c)", 1) + """
SELECT model, recall_0, f2_0, round(recall_0 - max(recall_0) OVER (), 6) AS delta_recall_0,
       round(f2_0 - max(f2_0) OVER (), 6) AS delta_f2_0,
       recall_0 = max(recall_0) OVER () AS is_best
FROM bm WHERE split = 'test'""")
def q_model_deltas(spark, d):
    """SET-3: test-split metrics of each model next to the best one
    (deltas from a window over the few model rows)."""
    from pyspark.sql import Window
    bm = M.binary_metrics(_long(spark, d)).where(F.col("split") == "test")
    w = Window.partitionBy()
    return bm.select("model", "recall_0", "f2_0",
                     F.round(F.col("recall_0") - F.max("recall_0").over(w), 6).alias("delta_recall_0"),
                     F.round(F.col("f2_0") - F.max("f2_0").over(w), 6).alias("delta_f2_0"),
                     (F.col("recall_0") == F.max("recall_0").over(w)).alias("is_best"))
