"""Filter interaction audit: contingency tensor contractions.

Every document either passes or fails each filter of a set, whatever the
order they are applied in.  So all that an audit of every order needs are the
counts of documents by part and by pass/fail pattern: a 2x2x...x2 tensor for
each part and measure (documents, good ones, toxic ones), one axis a filter.
For each step of each order ``einsum`` selects pass, fail or all along every
axis: removed here is pass on the axes of earlier filters, fail on the step's
own and all on the rest.

Documents are read once into narrow rows.  Exact repeats are found without
bringing a text's copies together: the smallest id of each text is one
aggregate with map-side combine, and a row is joined to it on text *and* id,
so a text that a third of all rows share is spread by its ids.  At most 32
rows a part reach the contraction.

Defined results: a null text counts as empty, a null part as the empty
string; a row without an id repeats nothing and has no label; repeated rows
of one id and text are all first (none has a smaller id); several label rows
of an id count as one, good or toxic if any is; an empty table gives no rows;
texts are judged whole; extra columns are ignored.
"""

from __future__ import annotations

import itertools

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, ship

FILTERS = "ABCDE"
SPACE = r"[\x20\x09-\x0D]+"
MEASURES = ["n", "good", "toxic"]


def failures(text: Column) -> dict[str, Column]:
    """Failure conditions that a text alone decides, by filter letter."""
    words = F.filter(F.split(text, SPACE), lambda w: w != "")
    upper = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    return {
        "A": F.size(words) < 200,
        "B": 100 * F.size(F.array_distinct(words)) < 50 * F.size(words),
        "C": 100 * upper > 2 * F.length(text),
        "D": text.rlike("[#$%&*|]"),
    }


def text_key(text: Column) -> Column:
    """Texts are equal where this digest of 256 bits is."""
    return F.unhex(F.sha2(text, 256))


def patterns(docs: DataFrame, labels: DataFrame | None, part: str = "source") -> DataFrame:
    """part, pattern (bit i: filter i of ``FILTERS`` fails) and the measures."""
    text = F.coalesce(docs["text"], F.lit(""))
    bits = sum((F.when(c, 1 << FILTERS.index(k)).otherwise(0) for k, c in failures(F.col("t")).items()), F.lit(0))
    rows = (docs.select(docs["doc_id"].cast("long").alias("doc_id"),
                        F.coalesce(docs[part].cast("string"), F.lit("")).alias("part"), text.alias("t"))
            .select("doc_id", "part", text_key(F.col("t")).alias("text_key"), bits.alias("bits")))
    # Rows that agree in everything are one row with a count from here on.
    rows = cut(rows.groupBy("doc_id", "part", "text_key", "bits").agg(F.count(F.lit(1)).alias("n")))
    first = (rows.where(F.col("doc_id").isNotNull()).groupBy("text_key").agg(F.min("doc_id").alias("doc_id"))
             .withColumn("first", F.lit(True)))
    # On text and id: copies of one text go by their ids, rows without an id by their texts.
    rows = rows.join(first, ["text_key", "doc_id"], "left")
    repeats = F.col("first").isNull() & F.col("doc_id").isNotNull()
    rows = rows.withColumn("pattern", F.col("bits") + F.when(repeats, 16).otherwise(0))
    if labels is None:
        rows = rows.withColumns({"q": F.lit(0), "x": F.lit(0)})
    else:
        marks = (labels.select(labels["doc_id"].cast("long").alias("doc_id"), labels["quality"].alias("q"), labels["toxic"].alias("x"))
                 .where("doc_id IS NOT NULL AND (q = 1 OR x = 1)")
                 .groupBy("doc_id").agg(F.max((F.col("q") == 1).cast("int")).alias("q"),
                                        F.max((F.col("x") == 1).cast("int")).alias("x"))
                 .select(F.struct("doc_id", F.lit(None).cast("binary").alias("alone")).alias("k"), "q", "x"))
        # A null id has no label; its text takes its place in the key, so such rows do not meet in one task.
        key = F.struct("doc_id", F.when(F.col("doc_id").isNull(), F.col("text_key")).alias("alone"))
        rows = rows.withColumn("k", key).join(marks, "k", "left")
    n = F.col("n")
    return rows.groupBy("part", "pattern").agg(
        F.sum(n).alias("n"), F.sum(n * F.coalesce(F.col("q"), F.lit(0))).alias("good"),
        F.sum(n * F.coalesce(F.col("x"), F.lit(0))).alias("toxic"))


class Contraction:
    """Selectors of every step of every order over ``k`` filters."""

    PASS, FAIL, ALL = (1, 0), (0, 1), (1, 1)

    def __init__(self, filters: str):
        k = len(filters)
        self.orders = ["".join(o) for o in itertools.permutations(filters)]
        at = np.array([[filters.index(c) for c in o] for o in self.orders])
        self.own = at
        kept, removed = np.empty((2, len(at), k, k, 2), np.int64)
        failed, alone = np.empty((2, len(at), k, k, 2), np.int64)
        for o, order in enumerate(at):
            for step, own in enumerate(order):
                for axis in range(k):
                    earlier = axis in order[:step]
                    kept[o, step, axis] = self.PASS if earlier or axis == own else self.ALL
                    removed[o, step, axis] = self.FAIL if axis == own else self.PASS if earlier else self.ALL
                    failed[o, step, axis] = self.FAIL if axis == own else self.ALL
                    alone[o, step, axis] = self.FAIL if axis == own else self.PASS
        self.kept, self.removed, self.failed, self.alone = kept, removed, failed, alone

    def contract(self, tensor: np.ndarray, select: np.ndarray) -> np.ndarray:
        """measures x orders x steps from measures x 2 x ... x 2."""
        k, args = select.shape[2], []
        for axis in range(k):
            args += [select[:, :, axis], [k + 1, k + 2, axis]]
        return np.einsum(tensor, [k, *range(k)], *args, [k, k + 1, k + 2], optimize="greedy")

    def audit(self, counts: np.ndarray) -> pd.DataFrame:
        """All orders and steps of one part from its measures x 2^k counts (bit i of a pattern: axis i fails)."""
        k = self.own.shape[1]
        # Bit 0 varies fastest, so the reshaped axes come in reverse.
        tensor = counts.reshape((len(counts),) + (2,) * k).transpose(0, *range(k, 0, -1))
        removed = self.contract(tensor, self.removed)
        docs = tensor[:1]
        out = pd.DataFrame({
            "filter_order": np.repeat(self.orders, k),
            "step": np.tile(np.arange(1, k + 1, dtype=np.int32), len(self.orders)),
            "kept": self.contract(docs, self.kept)[0].ravel(),
            "removed": removed[0].ravel(),
            "redundant": (self.contract(docs, self.failed)[0] - removed[0]).ravel(),
            "unique_fails": self.contract(docs, self.alone)[0].ravel(),
            "good_lost": removed[1].ravel(),
            "toxic_lost": removed[2].ravel(),
        })
        shapley = np.zeros(k, np.int64)
        np.add.at(shapley, self.own.ravel(), removed[0].ravel())
        out["shapley"] = shapley[self.own.ravel()]
        return out


SCHEMA = ("part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
          "good_lost long, toxic_lost long, shapley long")


def audit(docs: DataFrame, labels: DataFrame | None = None, part: str = "source") -> DataFrame:
    """One row for every part, filter order and step (see the module)."""
    ship(docs.sparkSession)
    contraction = Contraction(FILTERS)

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        counts = np.zeros((len(MEASURES), 1 << len(FILTERS)), np.int64)
        counts[:, rows["pattern"].to_numpy()] = rows[MEASURES].to_numpy().T
        out = contraction.audit(counts)
        out.insert(0, "part", rows["part"].iloc[0])
        return out

    return patterns(docs, labels, part).groupBy("part").applyInPandas(run, SCHEMA)


def sql() -> str:
    """DuckDB twin of the audit."""
    letters = ", ".join(f"('{c}')" for c in FILTERS)
    bit = {c: 1 << i for i, c in enumerate(FILTERS)}
    own = "CASE substr(filter_order, step, 1) " + " ".join(f"WHEN '{c}' THEN {b}" for c, b in bit.items()) + " END"
    earlier = " + ".join(f"(CASE WHEN step > {i} THEN CASE substr(filter_order, {i}, 1) "
                         + " ".join(f"WHEN '{c}' THEN {b}" for c, b in bit.items()) + " END ELSE 0 END)"
                         for i in range(1, len(FILTERS)))
    return f"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
l AS (SELECT doc_id, max((quality = 1)::INT) AS q, max((toxic = 1)::INT) AS x FROM labels GROUP BY doc_id),
p AS (
  SELECT part, doc_id,
         (len(w) < 200)::INT + 2 * (100 * len(list_distinct(w)) < 50 * len(w))::INT
         + 4 * (100 * length(regexp_replace(t, '[^A-Z]+', '', 'g')) > 2 * length(t))::INT
         + 8 * regexp_matches(t, '[#$%&*|]')::INT
         + 16 * coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false)::INT AS pattern
  FROM d),
c AS (
  SELECT part, pattern, count(*) AS n, sum(coalesce(q, 0)) AS good, sum(coalesce(x, 0)) AS toxic
  FROM p LEFT JOIN l USING (doc_id) GROUP BY part, pattern),
f(k) AS (VALUES {letters}),
o AS (
  SELECT a.k || b.k || c.k || d.k || e.k AS filter_order FROM f a, f b, f c, f d, f e
  WHERE len(list_distinct([a.k, b.k, c.k, d.k, e.k])) = 5),
s AS (
  SELECT filter_order, step, own, earlier, 31 - own AS others
  FROM (SELECT filter_order, step, {own} AS own, {earlier} AS earlier
        FROM (SELECT filter_order, unnest(range(1, 6)) AS step FROM o))),
r AS (
  SELECT part, filter_order, step, own,
         sum(CASE WHEN pattern & (earlier | own) = 0 THEN n ELSE 0 END)::BIGINT AS kept,
         sum(CASE WHEN pattern & earlier = 0 AND pattern & own > 0 THEN n ELSE 0 END)::BIGINT AS removed,
         sum(CASE WHEN pattern & earlier > 0 AND pattern & own > 0 THEN n ELSE 0 END)::BIGINT AS redundant,
         sum(CASE WHEN pattern = own THEN n ELSE 0 END)::BIGINT AS unique_fails,
         sum(CASE WHEN pattern & earlier = 0 AND pattern & own > 0 THEN good ELSE 0 END)::BIGINT AS good_lost,
         sum(CASE WHEN pattern & earlier = 0 AND pattern & own > 0 THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
  FROM c CROSS JOIN s GROUP BY part, filter_order, step, own)
SELECT part, filter_order, step::INT AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       sum(removed) OVER (PARTITION BY part, own)::BIGINT AS shapley
FROM r
"""
