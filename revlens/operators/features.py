"""Relational text features (FEA-*, TOP-3/4, MOD-7) and the n-gram
language model (LM-*).

Texts are dealt by document id before they are exploded into (doc, term)
rows, so these are counted where they are made: texts cross the shuffle, not
their many times larger term rows.  The vocabulary is whole by default,
stored once and joined by term; with ``max_features`` (a top-k, bounded size)
it is broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import let, tokens_ws
from ..session import stored


def word_ngrams(tokens: Column, n_max: int = 2) -> Column:
    """FEA-1: unigrams … n_max-grams of a token array (space joined)."""
    return let(tokens, lambda t: _ngrams(t, n_max))


def _ngrams(tokens: Column, n_max: int) -> Column:
    size = F.size(tokens)
    grams = tokens
    for n in range(2, n_max + 1):
        idx = F.when(size >= n, F.sequence(F.lit(1), size - n + 1)).otherwise(F.array().cast("array<int>"))
        grams = F.concat(grams, F.transform(idx, lambda i: F.array_join(F.slice(tokens, i, n), " ")))
    return grams


def term_counts(docs: DataFrame, text_col: str = "clean_text", id_col: str = "doc_id", n_max: int = 2) -> DataFrame:
    """(doc_id, term, tf) from cleaned text, hash partitioned by id."""
    dealt = docs.select(id_col, text_col).repartition(id_col)
    ex = dealt.select(id_col, F.explode(word_ngrams(tokens_ws(F.col(text_col)), n_max)).alias("term"))
    return ex.groupBy(id_col, "term").agg(F.count(F.lit(1)).alias("tf"))


def term_stats(tf: DataFrame) -> DataFrame:
    """(term, df, cf) of every candidate term."""
    return tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("cf"))


def vocabulary(tf: DataFrame, n_docs: Column | int, min_df: int = 2, max_df: float = 0.9,
               max_features: int | None = None, id_col: str = "doc_id", stats: DataFrame | None = None) -> DataFrame:
    """FEA-3/4 vocabulary: df/cf per term (``stats``, if they are made already), df bounds, if asked the top
    ``max_features`` by corpus count (term as tie-break); idf = ln((1+n)/(1+df)) + 1."""
    st = term_stats(tf) if stats is None else stats
    n = n_docs if isinstance(n_docs, Column) else F.lit(n_docs)
    kept = st.where((F.col("df") >= min_df) & (F.col("df") <= n * max_df))
    if max_features:
        kept = kept.orderBy(F.col("cf").desc(), F.col("term").asc()).limit(max_features)
    return kept.select("term", "df", "cf", (F.log((F.lit(1.0) + n) / (F.lit(1.0) + F.col("df"))) + 1.0).alias("idf"))


def tfidf(docs: DataFrame, text_col: str = "clean_text", id_col: str = "doc_id", n_max: int = 2,
          min_df: int = 2, max_df: float = 0.9, max_features: int | None = None,
          stats: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """FEA-3: (doc_id, term, weight) with raw tf × smooth idf, L2-normalised
    per document; returns (weights, vocabulary), the vocabulary as a stored table."""
    tf = term_counts(docs, text_col, id_col, n_max)
    n_docs = docs.select(id_col).distinct().count()  # one scalar to the driver
    voc = stored(vocabulary(tf, n_docs, min_df, max_df, max_features, id_col, stats))
    if min_df > 1 and voc.isEmpty():
        # FEA-4: an empty vocabulary at min_df falls back to min_df = 1
        voc = stored(vocabulary(tf, n_docs, 1, max_df, max_features, id_col, stats))
    terms = voc.select("term", "idf")
    j = tf.join(F.broadcast(terms) if max_features else terms, "term")
    w = j.select(id_col, "term", (F.col("tf") * F.col("idf")).alias("raw"))
    norm = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(Window.partitionBy(id_col)))
    return w.select(id_col, "term", (F.col("raw") / norm).alias("weight")), voc


def chi2_scores(weights: DataFrame, classes: DataFrame, id_col: str = "doc_id", y: str = "y") -> DataFrame:
    """FEA-7: chi-square of non-negative features against a class column:
    observed = Σ weight per class, expected = class share × Σ weight."""
    cls = classes.select(id_col, F.col(y).alias("_y"))
    counts = {r["_y"]: r["n"] for r in cls.groupBy("_y").agg(F.count(F.lit(1)).alias("n")).collect()}
    shares = {c: k / sum(counts.values()) for c, k in counts.items()}
    j = weights.join(cls, id_col)
    obs = j.groupBy("term").agg(*[F.sum(F.when(F.col("_y") == c, F.col("weight")).otherwise(0.0)).alias(f"o{c}")
                                  for c in sorted(shares)], F.sum("weight").alias("fc"))
    chi = None
    for c, share in sorted(shares.items()):
        e = F.col("fc") * F.lit(share)
        part = F.pow(F.col(f"o{c}") - e, 2) / e
        chi = part if chi is None else chi + part
    return obs.select("term", chi.alias("chi2"))


def naive_bayes_fit(counts: DataFrame, classes: DataFrame, alpha: float = 0.3, id_col: str = "doc_id",
                    y: str = "y") -> tuple[DataFrame, DataFrame]:
    """MOD-7 (multinomial, as SQL): per (class, term) log P(term | class)
    and per class log prior.  ``counts`` = (doc_id, term, tf)."""
    # One pass over the counts; a document without a class only adds its terms to the vocabulary.
    cls = classes.select(id_col, F.col(y).alias("_y"), F.lit(True).alias("_in"))
    seen = stored(counts.join(cls, id_col, "left").groupBy("_in", "_y", "term").agg(F.sum("tf").alias("c")))
    per = seen.where("_in").drop("_in")
    vocab_n = seen.select("term").distinct().count()
    tot = per.groupBy("_y").agg(F.sum("c").alias("tot"))
    logp = per.join(F.broadcast(tot), "_y").select(
        "_y", "term", F.log((F.col("c") + alpha) / (F.col("tot") + alpha * vocab_n)).alias("logp"))
    unseen = tot.select("_y", F.log(F.lit(alpha) / (F.col("tot") + alpha * vocab_n)).alias("logp_unseen"))
    prior = classes.groupBy(F.col(y).alias("_y")).agg(F.count(F.lit(1)).alias("n"))
    total = classes.count()
    prior = prior.select("_y", F.log(F.col("n") / F.lit(float(total))).alias("log_prior"))
    return logp, unseen.join(prior, "_y")


def naive_bayes_predict(counts: DataFrame, logp: DataFrame, class_table: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Score = log prior + Σ tf · log P(term | class); arg-max per doc.
    ``class_table`` has one row per class (bounded), so it is broadcast."""
    ct = {r["_y"]: (r["logp_unseen"], r["log_prior"]) for r in class_table.collect()}
    classes = sorted(ct)
    # One row a term with every class: the counts meet it in one join, which drops OOV terms.
    wide = logp.groupBy("term").agg(*[F.max(F.when(F.col("_y") == c, F.col("logp"))).alias(f"lp{c}") for c in classes])
    scored = counts.join(wide, "term")
    aggs = [(F.sum(F.col("tf") * F.coalesce(F.col(f"lp{c}"), F.lit(ct[c][0]))) + F.lit(ct[c][1])).alias(f"s{c}")
            for c in classes]
    s = scored.groupBy(id_col).agg(*aggs)
    cands = [F.struct(F.col(f"s{c}").alias("s"), F.lit(-c).alias("t"), F.lit(c).alias("c")) for c in classes]
    pick = F.greatest(*cands) if len(cands) > 1 else cands[0]
    return s.select(id_col, pick["c"].alias("pred"))


# --------------------------------------------------------------------------
# LM-1..4
# --------------------------------------------------------------------------

def lm_tokens(clean: Column) -> Column:
    return F.concat(F.array(F.lit("<s>")), tokens_ws(clean), F.array(F.lit("</s>")))


def lm_counts(docs: DataFrame, text_col: str = "clean_text") -> tuple[DataFrame, DataFrame]:
    """LM-1: unigram counts (tokens after ``<s>``) and bigram counts."""
    t = docs.select(lm_tokens(F.col(text_col)).alias("t"))
    uni = (t.select(F.explode(F.slice("t", 2, F.size("t") - 1)).alias("w"))
           .groupBy("w").agg(F.count(F.lit(1)).alias("c")))
    pairs = let(F.col("t"), lambda tt: F.transform(F.sequence(F.lit(2), F.size(tt)), lambda i: F.struct(
        F.element_at(tt, i - 1).alias("prev"), F.element_at(tt, i).alias("w"))))
    bi = t.select(F.inline(pairs)).groupBy("prev", "w").agg(F.count(F.lit(1)).alias("c"))
    return uni, bi


def lm_perplexity(train: DataFrame, test: DataFrame, k: float = 1.0, text_col: str = "clean_text") -> DataFrame:
    """LM-2/3: add-k unigram and bigram perplexity of ``test`` under counts
    of ``train``.  Test n-grams are counted first, then left-joined to the
    train counts (aggregate before the join).  Reproduces the unigram
    table's exclusion of ``<s>`` (its count is 0 in bigram denominators)."""
    uni, bi = lm_counts(train, text_col)
    stats = uni.agg(F.sum("c").alias("T"), F.count(F.lit(1)).alias("V0"),
                    F.count_if(F.col("w") == "</s>").alias("has_end")).first()
    total = stats["T"]
    vocab = max(1, stats["V0"] + (0 if stats["has_end"] else 1))
    tu, tb = lm_counts(test, text_col)
    n_tok = test.select(F.greatest(F.size(lm_tokens(F.col(text_col))) - 1, F.lit(1)).alias("n")).agg(F.sum("n")).first()[0]
    u = tu.join(uni.withColumnRenamed("c", "ct"), "w", "left").select(
        (F.col("c") * F.log((F.coalesce("ct", F.lit(0)) + k) / F.lit(total + k * vocab))).alias("lp"))
    b = (tb.join(bi.withColumnRenamed("c", "cp"), ["prev", "w"], "left")
         .join(uni.select(F.col("w").alias("prev"), F.col("c").alias("cprev")), "prev", "left")
         .select((F.col("c") * F.log((F.coalesce("cp", F.lit(0)) + k)
                                     / (F.coalesce("cprev", F.lit(0)) + k * vocab))).alias("lp")))
    rows = []
    for name, df in (("unigram", u), ("bigram", b)):
        rows.append(df.agg(F.lit(name).alias("model"), (F.sum("lp") / F.lit(float(n_tok))).alias("avg")))
    out = rows[0].unionByName(rows[1])
    return out.select("model", F.round(F.exp(-F.col("avg")), 6).alias("perplexity"),
                      F.round("avg", 6).alias("avg_log_prob"))


def next_token_cdf(bi: DataFrame) -> DataFrame:
    """LM-4: per previous token, cumulative distribution of next tokens
    (count desc, token asc).  Partitions are bigram *types* per token,
    bounded by the vocabulary, not by the corpus."""
    w = Window.partitionBy("prev").orderBy(F.col("c").desc(), F.col("w").asc())
    tot = F.sum("c").over(Window.partitionBy("prev"))
    return bi.select("prev", "w", "c", (F.sum("c").over(w.rowsBetween(Window.unboundedPreceding, 0)) / tot).alias("cdf"))
