"""Registered similarity queries over ``embeddings`` (MOD-15, HIT-1).

The prototype classifier's "model" is one mean vector per label: a
bounded table (labels × dims) that is aggregated on the cluster and then
inlined as literals, so scoring is a per-row expression with no join and
no pairwise comparison of vectors.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import stats as S
from ..sources.tables import table
from .registry import register


def centroids(spark, d):
    e = table(spark, d, "embeddings").select("label", "embedding")
    dims = e.select(F.posexplode("embedding").alias("i", "x"), "label")
    agg = dims.groupBy("label", "i").agg(F.avg(F.col("x").cast("double")).alias("m"))
    rows = agg.groupBy("label").agg(F.sort_array(F.collect_list(F.struct("i", "m"))).alias("v")).collect()
    return {r["label"]: [t["m"] for t in r["v"]] for r in rows}


def _scored(spark, d):
    cents = centroids(spark, d)
    e = table(spark, d, "embeddings").select("vec_id", "label", "embedding")
    unit = S.normalize(F.col("embedding"))
    sims = []
    for lb in sorted(cents):
        c = cents[lb]
        n = sum(x * x for x in c) ** 0.5
        lit = F.array(*[F.lit(x / n if n else 0.0) for x in c])
        sims.append(F.struct(S.dot(unit, lit).alias("s"), F.lit(-lb).alias("t"), F.lit(lb).alias("c")))
    s = e.select("vec_id", "label", F.array(*sims).alias("sims"))
    ranked = F.transform(F.reverse(F.array_sort(F.col("sims"))), lambda x: x["c"])
    return s.select("vec_id", "label", ranked.alias("ranked"))


def _sql_centroids() -> str:
    return """WITH ex AS (SELECT vec_id, label, embedding[i]::DOUBLE AS x, i
            FROM (SELECT vec_id, label, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings)),
cm AS (SELECT label, i, avg(x) AS m FROM ex GROUP BY label, i),
cv AS (SELECT label, list(m ORDER BY i) AS v FROM cm GROUP BY label),
sims AS (SELECT e.vec_id, e.label, c.label AS cand,
                list_cosine_similarity(list_transform(e.embedding, lambda x: x::DOUBLE), c.v) AS s
         FROM embeddings e, cv c),
rk AS (SELECT vec_id, label, cand, row_number() OVER (PARTITION BY vec_id ORDER BY s DESC, cand ASC) AS r FROM sims)"""


@register("prototype_classify", lambda: _sql_centroids() + """
SELECT label, count(*)::BIGINT AS n, count(*) FILTER (WHERE cand = label)::BIGINT AS correct
FROM rk WHERE r = 1 GROUP BY label""")
def q_prototype_classify(spark, d):
    """MOD-15 re-aimed: nearest label prototype (cosine to the per-label
    mean embedding); correct predictions per label."""
    s = _scored(spark, d).select("label", F.element_at("ranked", 1).alias("pred"))
    return s.groupBy("label").agg(F.count(F.lit(1)).alias("n"),
                                  F.count_if(F.col("pred") == F.col("label")).alias("correct"))


@register("hit_at_k", lambda: _sql_centroids() + """
SELECT k, round(avg(hit), 6) AS hit_rate FROM (
  SELECT kk.k, v.vec_id, max((rk.r <= kk.k AND rk.cand = rk.label)::INT) AS hit
  FROM rk JOIN (SELECT DISTINCT vec_id FROM rk) v USING (vec_id), (VALUES (1), (3), (5)) kk(k)
  GROUP BY kk.k, v.vec_id) GROUP BY k""")
def q_hit_at_k(spark, d):
    """HIT-1: share of vectors whose true label is among the k best-ranked
    prototype labels, k ∈ {1, 3, 5}."""
    s = _scored(spark, d)
    rows = F.array(*[F.struct(F.lit(k).alias("k"), F.arrays_overlap(F.slice("ranked", 1, k), F.array("label"))
                              .cast("int").alias("hit")) for k in (1, 3, 5)])
    return s.select(F.inline(rows)).groupBy("k").agg(F.round(F.avg("hit"), 6).alias("hit_rate"))
