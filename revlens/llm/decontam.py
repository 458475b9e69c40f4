"""Benchmark decontamination: SimHash of item-sized windows.

Words are runs of letters and digits, lower-cased, so punctuation and case
do not hide a passage.  An item is the multiset of its five-word shingles
(fewer words: one shingle of them all).

1. A window is as long as an item and stands where a shingle of the text
   lines up with the same shingle of the item.  A window with any
   similarity at all has such a shingle, so no window that could pass the
   last step is left out, and no other window is fingerprinted.
2. Every window gets a 64-bit SimHash of its shingles, weighted by how often
   they occur.
3. Multi-index lookup: fingerprints are cut into ``RADIUS + 1`` blocks;
   two that differ in at most ``RADIUS`` bits agree in a whole block, so an
   equality join on (item size, block, bits) finds all of them.  At a
   similarity of 0.8 the expected distance is 9.7 bits with a deviation of
   2.9; the radius of 19 is more than three deviations above.
4. Candidates are verified by the exact weighted Jaccard similarity of
   their shingle multisets, 0.8 or more.

Columns and SQL functions only.  The benchmark's shingle hashes go into the
scan as a literal set while there are at most ``LITERALS`` of them; a larger
benchmark is joined by hash instead, with the same result.

Defined results: null and wordless texts and items match nothing; a text
shorter than an item is compared as it is; repeated documents or items
repeat nothing (a hit is listed once for each doc_id, item_id and place);
empty tables give no rows; texts are scanned whole; extra columns are
ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlens.functions.text import let
from revlens.sources.tables import fence

from .common import cut

WORDS = 5
RADIUS = 19
SIMILARITY = 0.8
LITERALS = 100_000


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: F.length(w) > 0)


def with_shingles(df: DataFrame, k: int) -> DataFrame:
    """Rows of at least k words, with ``sh``: the hashes of the k-word shingles of ``text``, in order."""
    made = let(F.transform(words_of(F.col("text")), lambda w: F.xxhash64(w)), lambda w: F.when(
        F.size(w) >= k, F.transform(F.sequence(F.lit(1), F.size(w) - (k - 1)),
                                    lambda i: F.xxhash64(*[F.element_at(w, i + j) for j in range(k)]))))
    return fence(df.withColumn("sh", made), "sh").where("sh is not null")


def simhash(sh: Column) -> Column:
    """Bit b is set if more of the hashes have it than not."""
    def bit(acc: Column, b: Column) -> Column:
        votes = F.aggregate(sh, F.lit(0), lambda s, h: s + (F.call_function("shiftright", h, b).bitwiseAND(F.lit(1)) * 2 - 1).cast("int"))
        return acc.bitwiseOR(F.when(votes > 0, F.call_function("shiftleft", F.lit(1).cast("long"), b)).otherwise(F.lit(0).cast("long")))
    return F.aggregate(F.sequence(F.lit(0), F.lit(63)), F.lit(0).cast("long"), bit)


def blocks(fp: Column) -> Column:
    """The fingerprint's blocks as an array of (number, bits)."""
    n, out, at = RADIUS + 1, [], 0
    for i in range(n):
        width = 64 // n + (1 if i < 64 % n else 0)
        out.append(F.struct(F.lit(i).alias("no"), F.shiftrightunsigned(fp, at).bitwiseAND(F.lit((1 << width) - 1)).alias("bits")))
        at += width
    return F.array(*out)


def overlap(a: Column, b: Column) -> Column:
    """Sum over the shingles of ``b`` of the smaller multiplicity."""
    many = lambda arr, x: F.size(F.filter(arr, lambda y: y == x))
    return F.aggregate(F.array_distinct(b), F.lit(0), lambda s, x: s + F.least(many(a, x), many(b, x)))


def _windows(docs: DataFrame, items: DataFrame, k: int) -> DataFrame:
    """Item-sized windows (doc_id, start, size, win) where a shingle lines up."""
    sides = items.select("n_sh", F.posexplode("sh").alias("q", "h"), "sh").select(
        "n_sh", "q", "h", F.when(F.col("q") > 0, F.element_at("sh", F.col("q"))).alias("before")).distinct()
    hashes = sides.select("h").distinct()
    few = hashes.limit(LITERALS + 1).count() <= LITERALS
    longest = items.agg(F.max("n_sh")).first()[0]
    shingled = with_shingles(docs, k).withColumn("n_all", F.size("sh"))
    if few:
        known = ",".join(f"{r.h}L" if r.h != -(1 << 63) else "cast('-9223372036854775808' as bigint)" for r in hashes.collect())
        hits = F.expr(f"filter(transform(sh, (x, i) -> if(x in ({known}), i, -1)), i -> i >= 0)")
        hit_rows = fence(shingled.withColumn("hits", hits), "hits").where(F.size("hits") > 0)
    else:  # (document, place) of shared shingles by join, then back to the documents that have any
        flat = shingled.select("doc_id", "text", F.posexplode("sh").alias("pos", "h")).select(
            "doc_id", F.xxhash64("text").alias("tx"), "pos", "h")
        at = (flat.join(hashes, "h", "left_semi").groupBy("doc_id", "tx")
              .agg(F.sort_array(F.collect_set("pos")).alias("hits"))
              .withColumnsRenamed({"doc_id": "d2", "tx": "t2"}))
        hit_rows = shingled.join(at, F.col("doc_id").eqNullSafe(F.col("d2")) & (F.xxhash64("text") == F.col("t2")))
    base = lambda p: F.greatest(p - longest, F.lit(0))
    near = F.transform("hits", lambda p: F.struct(
        p.alias("pos"), base(p).alias("base"), F.element_at("sh", p + 1).alias("h"),
        F.when(p > 0, F.element_at("sh", F.greatest(p, F.lit(1)))).alias("prior"),
        F.slice("sh", base(p) + 1, 2 * longest + 1).alias("near")))
    spots = cut(hit_rows.select("doc_id", "n_all", F.explode(near).alias("s")).select("doc_id", "n_all", "s.*"))
    # A shingle inside a run of the same diagonal stands in its first shingle's window.
    start = F.col("pos") - F.col("q")
    lined = (spots.join(sides, "h").where(~F.col("before").eqNullSafe(F.col("prior")) | F.col("before").isNull())
             .withColumns({"start": F.greatest(start, F.lit(0)), "end": F.least(start + F.col("n_sh"), F.col("n_all"))}))
    return (lined.select("doc_id", "n_sh", "start", F.slice("near", F.col("start") - F.col("base") + 1, F.col("end") - F.col("start")).alias("win"))
            .dropDuplicates(["doc_id", "n_sh", "start", "win"]))


def find(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Hits: doc_id, item_id, start_word, n_words, hamming, similarity."""
    texts = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text")).where("text is not null")
    items = benchmark.select(benchmark["item_id"].cast("long").alias("item_id"), benchmark["text"].alias("text"))
    items = cut(items.where("text is not null and item_id is not null").withColumn("n_words", F.size(words_of(F.col("text"))))
                .where("n_words > 0").distinct())
    out = []
    for k in sorted(r.k for r in items.select(F.least("n_words", F.lit(WORDS)).alias("k")).distinct().collect()):
        own = with_shingles(items.where(F.least("n_words", F.lit(WORDS)) == k), k).withColumn("n_sh", F.size("sh")).drop("text")
        own = cut(own.withColumn("fp", simhash(F.col("sh"))))
        wins = cut(_windows(texts, own, k).withColumn("fp", simhash(F.col("win"))))
        left = wins.select("doc_id", "n_sh", "start", "win", F.col("fp").alias("w_fp"), F.explode(blocks(F.col("fp"))).alias("b"))
        right = own.select("item_id", "n_sh", "n_words", "sh", F.col("fp").alias("i_fp"), F.explode(blocks(F.col("fp"))).alias("b"))
        both = left.join(right, ["n_sh", "b"]).withColumn("hamming", F.bit_count(F.col("w_fp").bitwiseXOR(F.col("i_fp"))))
        both = both.where(F.col("hamming") <= RADIUS).dropDuplicates(["doc_id", "item_id", "start", "win"])
        low = overlap(F.col("win"), F.col("sh"))
        both = both.withColumn("low", low).withColumn(
            "similarity", F.col("low") / (F.size("win") + F.size("sh") - F.col("low")))
        out.append(both.where(F.col("similarity") >= SIMILARITY).select(
            "doc_id", "item_id", F.col("start").cast("long").alias("start_word"),
            (F.size("win") + k - 1).cast("long").alias("n_words"), F.col("hamming").cast("int").alias("hamming"), "similarity"))
    if not out:
        return docs.sparkSession.createDataFrame(
            [], "doc_id long, item_id long, start_word long, n_words long, hamming int, similarity double")
    return reduce(DataFrame.unionByName, out).distinct()


SQL = r"""
WITH d AS (SELECT doc_id, list_filter(string_split_regex(lower(text), '[^\p{L}\p{N}]+'), lambda w: length(w) > 0) AS w FROM documents),
b AS (SELECT item_id, list_filter(string_split_regex(lower(text), '[^\p{L}\p{N}]+'), lambda w: length(w) > 0) AS w FROM benchmark),
bs AS (SELECT item_id, len(w) - 4 AS n_sh, unnest(range(0, len(w) - 4)) AS q, unnest(list_transform(range(0, len(w) - 4), lambda i: array_to_string(w[i + 1:i + 5], ' '))) AS s
       FROM b WHERE len(w) >= 5),
ds AS (SELECT doc_id, len(w) - 4 AS n_all, unnest(range(0, len(w) - 4)) AS p, unnest(list_transform(range(0, len(w) - 4), lambda i: array_to_string(w[i + 1:i + 5], ' '))) AS s
       FROM d WHERE len(w) >= 5),
spots AS (SELECT DISTINCT doc_id, n_all, item_id, n_sh, greatest(p - q, 0) AS a, least(p - q + n_sh, n_all) AS e FROM ds JOIN bs USING (s)),
win AS (SELECT x.doc_id, x.item_id, x.a, x.e, x.n_sh, ds.s, count(*) AS c
        FROM spots x JOIN ds ON ds.doc_id = x.doc_id AND ds.p >= x.a AND ds.p < x.e GROUP BY ALL),
itm AS (SELECT item_id, s, count(*) AS c FROM bs GROUP BY ALL),
sim AS (SELECT w.doc_id, w.item_id, w.a, w.e, w.n_sh, sum(least(w.c, i.c)) AS low
        FROM win w JOIN itm i ON w.item_id = i.item_id AND w.s = i.s GROUP BY ALL)
SELECT DISTINCT doc_id, item_id, a AS start_word, e - a + 4 AS n_words, CAST(low AS DOUBLE) / (e - a + n_sh - low) AS similarity
FROM sim WHERE CAST(low AS DOUBLE) / (e - a + n_sh - low) >= 0.8
"""
