"""Registered label-quality queries over the annotation batches view."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions import rules as R
from ..functions import text as T
from ..operators import labels as LB
from ..session import stored
from ..sources.fixtures import label_batches, reviews
from . import duck as D
from .registry import register
from .views import stage1

RV, LBC = D.reviews_cte, D.label_batches_cte
LABELS = K.ISSUE_LABELS


def _w(*ctes):
    return D.with_ctes(*[c() for c in ctes])


def norm_id_sql(x: str) -> str:
    t = f"trim(coalesce({x}, ''))"
    dv = f"TRY_CAST({t} AS DOUBLE)"
    return (f"(CASE WHEN {t} = '' THEN '' WHEN {dv} IS NOT NULL AND abs({dv}) < 9.0e15 AND {dv} = floor({dv}) "
            f"THEN floor({dv})::BIGINT::VARCHAR ELSE {t} END)")


def _coerced(src: str) -> str:
    vs = ", ".join(f"TRY_CAST(trim({lb}) AS DOUBLE) AS _v_{lb}" for lb in LABELS)
    ok = " AND ".join(f"coalesce(_v_{lb} IN (0.0, 1.0), false)" for lb in LABELS)
    return f"(SELECT *, {ok} AS labels_complete FROM (SELECT *, {vs} FROM {src}))"


def _filtered_sql() -> str:
    ints = ", ".join(f"_v_{lb}::INT AS {lb}" for lb in LABELS)
    return f"""
fb_0 AS (SELECT * EXCLUDE (id), {norm_id_sql('id')} AS id FROM label_batches),
fb_1 AS (SELECT * FROM fb_0 WHERE id <> '' AND lower(trim(coalesce(annotation_status, ''))) IN {D.qin(K.DONE_STATUSES)}),
fb_2 AS {_coerced('fb_1')},
filtered AS (SELECT review_id, id, rating, text, source_file, source_mtime, row_order, annotator, annotation_status, {ints}
             FROM fb_2 WHERE labels_complete)"""


def _filtered(spark, d):
    return LB.filtered_batches(label_batches(spark, d))


OUT = ["review_id", "rating", "text", "annotation_status", "annotator"] + LABELS


def _dedup_sql():
    aggs = ", ".join(f"arg_max({c}, CASE WHEN {c} IS NOT NULL THEN {{'m': source_mtime, 'o': row_order}} END) AS {c}"
                     for c in OUT)
    return _w(RV, LBC) + "," + _filtered_sql() + f"\nSELECT id, {aggs} FROM filtered GROUP BY id"


@register("batch_merge_dedup", _dedup_sql)
def q_batch_merge_dedup(spark, d):
    """LBL-2 + WIN-1 + TXT-11: merge annotation batches, keep finished and
    complete rows, one row per id with the newest non-null value of
    every column."""
    f = _filtered(spark, d)
    return LB.dedup_newest(f.select("id", "source_mtime", "row_order", *OUT), columns=OUT)


def _conflict_sql():
    d = " OR ".join(f"count(DISTINCT coalesce({lb}::VARCHAR, '<null>')) > 1" for lb in LABELS)
    cols = ", ".join(LABELS)
    return _w(RV, LBC) + "," + _filtered_sql() + f""",
bad AS (SELECT id FROM filtered GROUP BY id HAVING {d})
SELECT id, source_file, source_mtime, row_order, {cols} FROM filtered WHERE id IN (SELECT id FROM bad)"""


@register("batch_conflicts", _conflict_sql)
def q_batch_conflicts(spark, d):
    """WIN-2 + JOIN-4: rows of ids with differing label vectors."""
    # Stored: the ids' aggregate and the rows' join both read the filtered rows, most of the work.
    f = stored(_filtered(spark, d).select("id", "source_file", "source_mtime", "row_order", *LABELS))
    return LB.conflicts(f)


def _quality_sql(group_col: str) -> str:
    bins = {lb: f"(CASE WHEN _v_{lb} IN (0.0, 1.0) THEN _v_{lb} ELSE 0.0 END)" for lb in LABELS}
    card = " + ".join(bins[lb] for lb in LABELS)
    others = " + ".join(bins[lb] for lb in LABELS if lb != "other")
    bcols = ", ".join(f"{bins[lb]} AS _b_{lb}" for lb in LABELS)
    sums = ", ".join(f"sum(_b_{lb}) AS _s_{lb}" for lb in LABELS)
    drift = " + ".join(f"abs(_s_{lb} / rows - sum(_s_{lb}) OVER () / sum(rows) OVER ())" for lb in LABELS)
    g = f"coalesce(nullif(trim(coalesce({group_col}::VARCHAR, '')), ''), 'unknown')"
    ints = ", ".join(f"_v_{lb}::INT AS {lb}" for lb in LABELS)
    return _w(RV, LBC) + f""",
q_0 AS (SELECT * EXCLUDE (id), {norm_id_sql('id')} AS id FROM label_batches),
q_1 AS {_coerced("(SELECT * FROM q_0 WHERE id <> '' AND lower(trim(coalesce(annotation_status, ''))) IN " + D.qin(K.DONE_STATUSES) + ")")},
w AS (SELECT {g} AS {group_col}, labels_complete::INT AS _valid, (({card}) = 0)::INT AS _zero,
             ({bins['other']} = 1 AND ({others}) > 0)::INT AS _contra, ({card}) AS _card, {bcols} FROM q_1),
s AS (SELECT {group_col}, count(*) AS rows, sum(_valid) AS valid_rows, sum(_zero) AS zero_label_rows,
             sum(_contra) AS contradiction_rows, avg(_card) AS avg_label_cardinality, {sums} FROM w GROUP BY {group_col})
SELECT {group_col}, rows::BIGINT AS rows, valid_rows::BIGINT AS valid_rows,
       round(valid_rows::DOUBLE / greatest(rows, 1)::DOUBLE, 6) AS valid_rate,
       zero_label_rows::BIGINT AS zero_label_rows, round(zero_label_rows::DOUBLE / greatest(rows, 1)::DOUBLE, 6) AS zero_label_rate,
       contradiction_rows::BIGINT AS contradiction_rows,
       round(contradiction_rows::DOUBLE / greatest(rows, 1)::DOUBLE, 6) AS contradiction_rate,
       round(avg_label_cardinality, 6) AS avg_label_cardinality,
       round(({drift}) / {len(LABELS)}.0, 6) AS label_prevalence_drift
FROM s"""


def _status_filtered(spark, d):
    return LB.filtered_batches(label_batches(spark, d), keep_incomplete=True)


@register("quality_by_source", lambda: _quality_sql("source_file"))
def q_quality_by_source(spark, d):
    """AGG-9 by batch file (finished rows, incomplete kept so valid rates
    are informative)."""
    return LB.group_quality(_raw_status_filtered(spark, d), "source_file")


@register("quality_by_annotator", lambda: _quality_sql("annotator"))
def q_quality_by_annotator(spark, d):
    """AGG-9 by annotator."""
    return LB.group_quality(_raw_status_filtered(spark, d), "annotator")


def _raw_status_filtered(spark, d):
    b = label_batches(spark, d).withColumn("id", T.normalize_id(F.col("id")))
    return b.where((F.col("id") != "") & LB.status_norm(F.col("annotation_status")).isin(*K.DONE_STATUSES))


def _validation_sql():
    nonbin = " OR ".join(f"NOT coalesce(_v_{lb} IN (0.0, 1.0), false)" for lb in LABELS)
    card = " + ".join(f"(CASE WHEN _v_{lb} = 1.0 THEN 1 ELSE 0 END)" for lb in LABELS)
    vec = " || ',' || ".join(f"coalesce(_v_{lb}::VARCHAR, 'nan')" for lb in LABELS)
    return _w(RV, LBC) + f""",
v_0 AS {_coerced("(SELECT * EXCLUDE (id), " + norm_id_sql('id') + " AS id FROM label_batches)")},
ra AS (SELECT count(*) FILTER (WHERE id = '') AS missing_id, count(*) FILTER (WHERE {nonbin}) AS non_binary,
              count(*) FILTER (WHERE ({card}) = 0) AS zero_label,
              count(*) FILTER (WHERE _v_other = 1.0 AND ({card}) > 1) AS other_with_label FROM v_0),
pi AS (SELECT id, count(*) AS n, count(DISTINCT {vec}) AS k FROM v_0 WHERE id <> '' GROUP BY id),
ia AS (SELECT count(*) FILTER (WHERE n > 1) AS duplicate_ids, coalesce(sum(n) FILTER (WHERE n > 1), 0) AS duplicate_rows,
              count(*) FILTER (WHERE k > 1) AS conflicting_ids FROM pi),
rr AS (SELECT 'missing_id' AS rule, 'fatal' AS severity, missing_id::BIGINT AS n_bad FROM ra
       UNION ALL SELECT 'non_binary', 'fatal', non_binary::BIGINT FROM ra
       UNION ALL SELECT 'zero_label', 'fatal', zero_label::BIGINT FROM ra
       UNION ALL SELECT 'other_with_label', 'warn', other_with_label::BIGINT FROM ra
       UNION ALL SELECT 'duplicate_ids', 'warn', duplicate_ids::BIGINT FROM ia
       UNION ALL SELECT 'duplicate_rows', 'warn', duplicate_rows::BIGINT FROM ia
       UNION ALL SELECT 'conflicting_ids', 'warn', conflicting_ids::BIGINT FROM ia)
SELECT rule, severity, n_bad, n_bad = 0 AS passed FROM rr"""


@register("label_validation", _validation_sql)
def q_label_validation(spark, d):
    """LBL-3 + AGG-8: validation rule table over all batch rows."""
    return LB.validation_rules(label_batches(spark, d))


@register("label_frequency", lambda: _w(RV, LBC) + f""",
c AS {_coerced('label_batches')},
k AS (SELECT * FROM c WHERE labels_complete)
""" + "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT {D.q(lb)} AS label, sum(_v_{lb})::BIGINT AS positives, "
    f"round(coalesce(sum(_v_{lb}), 0) / greatest(count(*), 1)::DOUBLE, 6) AS prevalence FROM k" for lb in LABELS) + ")")
def q_label_frequency(spark, d):
    """AGG-7: per label positives and prevalence among complete rows."""
    return LB.label_frequency(label_batches(spark, d))


@register("status_counts", lambda: _w(RV, LBC) + """
SELECT lower(trim(coalesce(annotation_status, ''))) AS status, count(*)::BIGINT AS count FROM label_batches GROUP BY 1""")
def q_status_counts(spark, d):
    """AGG-10."""
    b = label_batches(spark, d)
    return b.groupBy(LB.status_norm(F.col("annotation_status")).alias("status")).agg(F.count(F.lit(1)).alias("count"))


@register("normalized_ids", lambda: _w(RV, LBC) + f""",
n AS (SELECT DISTINCT {norm_id_sql('id')} AS id FROM label_batches)
SELECT id, CASE WHEN id = '' THEN 2 WHEN TRY_CAST(id AS BIGINT) IS NOT NULL THEN 0 ELSE 1 END AS id_kind,
       coalesce(TRY_CAST(id AS BIGINT), 0) AS id_number,
       CASE WHEN TRY_CAST(id AS BIGINT) IS NOT NULL OR id = '' THEN id ELSE lower(id) END AS id_text
FROM n""")
def q_normalized_ids(spark, d):
    """TXT-11/12: distinct normalized ids with their natural sort keys."""
    b = label_batches(spark, d).select(T.normalize_id(F.col("id")).alias("id")).distinct()
    k = T.natural_id_key(F.col("id"))
    return b.select("id", k[0].alias("id_kind"), k[1].alias("id_number"), k[2].alias("id_text"))


def _queue_sql(n: int = 50):
    kw = dict(K.ISSUE_KEYWORDS)
    items = ", ".join(f"CASE WHEN {D.keyword_hit('ct', kw[lb])} THEN {D.q(lb)} END" for lb, _ in K.ISSUE_KEYWORDS)
    mk = " OR ".join(f"contains(' ' || lower(ct) || ' ', {D.q(m)})" for m in K.QUEUE_CONTRAST_MARKERS)
    return _w(RV, D.stage1_cte) + f""",
a AS (SELECT review_id, rating, text, label AS stage1_label, stage1_prob, {D.clean('text')} AS ct FROM stage1
      WHERE label IN ('NEGATIVE', 'NEEDS_ATTENTION')),
b AS (SELECT *, greatest(0.0, round(1.0 - least(1.0, abs(stage1_prob - 0.5) * 2.0)
               + CASE WHEN stage1_label = 'NEEDS_ATTENTION' THEN 0.15 ELSE 0.05 END
               + CASE WHEN {mk} THEN 0.10 ELSE 0.0 END
               + CASE WHEN {D.token_count('ct')} < 3 THEN -0.20 ELSE 0.0 END, 6)) AS queue_priority,
             list_filter([{items}], lambda x: x IS NOT NULL) AS hits FROM a)
SELECT review_id AS id, rating, text, ct AS clean_text,
       CASE WHEN len(hits) > 0 THEN array_to_string(hits, '|') ELSE 'other' END AS suggested_tags,
       stage1_label, stage1_prob, queue_priority
FROM b ORDER BY queue_priority DESC, stage1_prob ASC, review_id ASC LIMIT {n}"""


@register("annotation_queue", _queue_sql)
def q_annotation_queue(spark, d, n: int = 50):
    """LBL-1 + TOP-2 + RUL-13/15: the annotation template's priority queue
    (queue-only stage-1 rows, top ``n`` by priority, stage-1 p, id)."""
    s = stage1(spark, d).where(F.col("label").isin("NEGATIVE", "NEEDS_ATTENTION"))
    s = s.select("review_id", "rating", "text", F.col("label").alias("stage1_label"), "stage1_prob",
                 T.clean_text(F.col("text")).alias("clean_text"))
    s = s.select("*", R.queue_priority(F.col("clean_text"), F.col("stage1_label"), F.col("stage1_prob")).alias("queue_priority"),
                 R.labels_to_pipe(R.keyword_tags(F.col("clean_text"))).alias("suggested_tags"))
    top = s.orderBy(F.col("queue_priority").desc(), F.col("stage1_prob").asc(), F.col("review_id").asc()).limit(n)
    return top.select(F.col("review_id").alias("id"), "rating", "text", "clean_text", "suggested_tags",
                      "stage1_label", "stage1_prob", "queue_priority")


def _labelled_sql():
    ints = ", ".join(f"f.{lb}" for lb in LABELS)
    return _w(RV, LBC) + "," + _filtered_sql() + f"""
SELECT f.review_id, f.id, coalesce(f.text, r.text, '') AS text,
       TRY_CAST(coalesce(f.rating, r.rating::VARCHAR) AS DOUBLE) AS rating, {ints}
FROM filtered f LEFT JOIN reviews r ON r.review_id = f.review_id"""


@register("labelled_set", _labelled_sql)
def q_labelled_set(spark, d):
    """JOIN-1: labelled rows with text and rating, gaps filled from the reviews."""
    f = _filtered(spark, d).select("review_id", "id", "text", "rating", *LABELS)
    return LB.joined_with_base(f, reviews(spark, d).select("review_id", "text", "rating"), key="review_id")


def _drops_sql():
    card = " + ".join(f"(coalesce(_v_{lb} = 1.0, false))::INT" for lb in LABELS)
    return _w(RV, LBC) + f""",
c AS (SELECT *, {card} AS card FROM {_coerced('label_batches')})
SELECT count(*)::BIGINT AS rows, count(*) FILTER (WHERE NOT labels_complete)::BIGINT AS dropped_invalid,
       count(*) FILTER (WHERE labels_complete AND card = 0)::BIGINT AS dropped_unlabelled,
       count(*) FILTER (WHERE labels_complete AND _v_other = 1.0 AND card > 1)::BIGINT AS dropped_contradiction,
       count(*) FILTER (WHERE labels_complete AND card > 0 AND NOT (_v_other = 1.0 AND card > 1))::BIGINT AS kept
FROM c"""


@register("labelled_drops", _drops_sql)
def q_labelled_drops(spark, d):
    """LBL-5: rows that training drops, by reason (strict about ``other``)."""
    return LB.drop_counts(label_batches(spark, d), strict_other=True)
