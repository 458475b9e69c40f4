import itertools
import random
import re
from collections import defaultdict

import numpy as np

import __spark_entry__ as E
from oracle_harness import compare
from pyspark.sql import functions as F

from revlens.llm import filter_audit as fa

LABELS = "doc_id long, quality int, toxic int"


def brute(docs, labels):
    """Every order applied filter by filter to lists of rows."""
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    rows = []
    for i, text, source in docs:
        t = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {c for c, bad in (("A", len(w) < 200), ("B", 100 * len(set(w)) < 50 * len(w)),
                                  ("C", 100 * len(re.findall("[A-Z]", t)) > 2 * len(t)), ("D", bool(re.search(r"[#$%&*|]", t))),
                                  ("E", i is not None and any(j is not None and j < i and (u or "") == t for j, u, _ in docs)))
                 if bad}
        rows.append((i, source or "", fails))
    out = []
    for part in {p for _, p, _ in rows}:
        own, total, made = [r for r in rows if r[1] == part], defaultdict(int), []
        for order in itertools.permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                gone = [r for r in left if f in r[2]]
                left = [r for r in left if f not in r[2]]
                total[f] += len(gone)
                made.append(["".join(order), step, len(left), len(gone), sum(f in r[2] for r in own) - len(gone),
                             sum(r[2] == {f} for r in own), sum(r[0] in good for r in gone), sum(r[0] in toxic for r in gone), f])
        out += [(part, *m[:-1], total[m[-1]]) for m in made]
    return sorted(out)


def corpus(seed, n=120):
    rnd = random.Random(seed)
    words = ["alpha", "beta", "GAMMA", "delta#", "Epsilon", "x|y", "zeta", "\x0b", "é\x1cü"] + [f"w{i}" for i in range(400)]
    texts = [None, "", " \t\n", "ONE"] + [" ".join(rnd.choices(words[rnd.choice((0, 6)):rnd.choice((9, 409))], k=rnd.choice((5, 199, 200, 260))))
                                          for _ in range(n // 2)]
    docs = [(rnd.choice((i, i, i, i % 7)), rnd.choice(texts), rnd.choice(("a", "b", "", None))) for i in range(n)]
    docs += [(None, "same", "a"), (None, "same", "a"), (3, "same", "a"), (3, "same", "a"), (9, "same", "b")]
    labels = [(rnd.randrange(n), rnd.choice((0, 1, None)), rnd.choice((0, 1, None))) for _ in range(n)] + [(None, 1, 1)]
    return docs, labels


def run(spark, docs, labels):
    d = spark.createDataFrame([(i, t, s) for i, t, s in docs], "doc_id long, text string, source string")
    la = spark.createDataFrame(labels, LABELS)
    return sorted(tuple(r) for r in fa.audit(d, la).collect())


def test_equals_applying_every_order(spark):
    for seed in (1, 2):
        docs, labels = corpus(seed)
        assert run(spark, docs, labels) == brute(docs, labels)


def test_contraction_of_random_tensors():
    rnd = np.random.default_rng(3)
    counts = rnd.integers(0, 9, (3, 8))
    got = fa.Contraction("XYZ").audit(counts)
    for r in got.itertuples():
        own, earlier = 1 << "XYZ".index(r.filter_order[r.step - 1]), sum(1 << "XYZ".index(c) for c in r.filter_order[:r.step - 1])
        gone = [p for p in range(8) if p & own and not p & earlier]
        assert (r.removed, r.good_lost, r.toxic_lost) == tuple(counts[:, gone].sum(1))
        assert r.kept == sum(counts[0, p] for p in range(8) if not p & (own | earlier))
        assert r.redundant == sum(counts[0, p] for p in range(8) if p & own and p & earlier)
        assert r.unique_fails == counts[0, own]
    one = got.groupby(got.apply(lambda r: r.filter_order[r.step - 1], axis=1))
    assert (one["removed"].sum() == one["shapley"].first()).all()


def test_large_counts_stay_exact():
    counts = np.zeros((3, 32), np.int64)
    counts[:, 31] = 10**15 + 1
    got = fa.Contraction("ABCDE").audit(counts)
    assert set(got[got.step == 1].removed) == {10**15 + 1} and set(got.shapley) == {24 * (10**15 + 1)}


def test_edge_cases(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    assert fa.audit(docs).collect() == []
    one = spark.createDataFrame([(1, None, None)], "doc_id long, text string, source string")
    one = one.withColumns({c: F.lit("x") for c in ("part", "pattern", "bits", "text_key", "n", "q", "k", "first", "t")})
    rows = fa.audit(one).collect()
    assert len(rows) == 600 and {r.part for r in rows} == {""}
    assert {(r.unique_fails, r.shapley) for r in rows if r.filter_order[r.step - 1] == "A"} == {(1, 120)}
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 1), (2, 1, 1)], LABELS).withColumn("n", F.lit(5))
    got = fa.audit(one, labels).where("filter_order = 'ABCDE' AND step = 1").first()
    assert (got.good_lost, got.toxic_lost) == (1, 1)


def test_query_equals_sql(spark, sf_small):
    r = compare(spark, E.queries()["op12_filter_audit"], E.oracle_sql()["op12_filter_audit"], sf_small)
    assert r["cols_match"] and r["hash_match"] and r["spark_rows"] > 0, r
