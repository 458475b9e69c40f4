import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from revlens.llm import ngram_join as J


def shingle_set(text):
    w = (text or "").encode().lower().split()
    return frozenset([tuple(w[i:i + 5]) for i in range(len(w) - 4)] if len(w) >= 5 else ([tuple(w)] if w else []))


def brute(docs):
    """(set size, smallest linked id) by comparing all rows."""
    sets = [shingle_set(t) for _, t in docs]
    comp = list(range(len(docs)))

    def root(i):
        while comp[i] != i:
            i = comp[i]
        return i
    for i in range(len(docs)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * len(sets[i] | sets[j]):
                a, b = root(i), root(j)
                comp[max(a, b)] = min(a, b)
    low = {}
    for i, (d, _) in enumerate(docs):
        low[root(i)] = min(d, low.get(root(i), d))
    return sorted((d, len(s), low[root(i)]) for i, ((d, _), s) in enumerate(zip(docs, sets, strict=True)))


def result(df):
    return sorted((r.doc_id, r.n_shingles, r.component_id) for r in df.collect())


def corpus(seed, n=120):
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(300)]
    shared = " ".join(rnd.choice(vocab) for _ in range(40))
    docs = []
    for i in range(n):
        kind = rnd.random()
        if docs and kind < 0.45:  # near copies of any earlier text, chains included
            words = rnd.choice(docs)[1].split()
            for _ in range(rnd.randint(0, 4)):
                if words:
                    k = rnd.randrange(len(words))
                    words[k:k + 1] = rnd.choice([[], [rnd.choice(vocab)], [words[k], rnd.choice(vocab)]])
            docs.append((i * 3, " ".join(words)))
        else:
            body = " ".join(rnd.choice(vocab) for _ in range(rnd.randint(1, 120)))
            docs.append((i * 3, f"{shared}\n{body}" if kind > 0.7 else body.upper()))
    rnd.shuffle(docs)
    return docs


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_brute_force(make_docs, monkeypatch, seed):
    monkeypatch.setattr(J, "HOT_LEAST", 8)  # shared passages count as frequent here
    monkeypatch.setattr(J, "BLOCK", 16)     # long lists are dealt into blocks
    docs = corpus(seed)
    assert result(J.join(make_docs(docs))) == brute(docs)


def test_table_equals_brute_force(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    assert result(J.join(docs)) == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_many_near_copies_of_one_text(make_docs):
    rnd = random.Random(8)
    base = [f"v{i}" for i in range(90)]
    docs = []
    for i in range(150):
        words = list(base)
        words[rnd.randrange(90)] = f"x{i % 50}"
        docs.append((i, " ".join(words)))
    assert result(J.join(make_docs(docs))) == brute(docs)


def test_copies_in_two_partitions_keep_every_list(make_docs):
    rnd = random.Random(12)
    docs = []
    for f in range(24):  # a long text over two near copies: lists of three nodes whose first is often the unlinked one
        part = [f"f{f}w{i}" for i in range(60)]
        near = part[:-1] + ["end"]
        far = part + [f"g{f}w{i}" for i in range(200)]
        docs += [(len(docs) + i, " ".join(t)) for i, t in enumerate((part, near, far))]
    rnd.shuffle(docs)
    copies = [(d + 1000, t) for d, t in docs]
    rows = make_docs(docs).union(make_docs(copies))  # copies in other partitions
    lists = J.listed(J.list_keys(rows, np.empty(0, np.uint64))).toPandas()
    assert not lists.duplicated(["key", "node"]).any()
    assert result(J.join(rows)) == brute(docs + copies)


def test_tree_loses_no_pair_within_the_bounds():
    rng = np.random.default_rng(3)
    vec = rng.poisson(3, (200, J.GROUPS))
    vec[100:] = np.maximum(vec[:100] + rng.integers(-1, 2, (100, J.GROUPS)) * (rng.random((100, J.GROUPS)) < 0.1), 0)
    n, comp = vec.sum(1), np.arange(200)
    x, y = J.tree_pairs(n, vec, comp, None)
    got = {(min(a, b), max(a, b)) for a, b in zip(x.tolist(), y.tolist(), strict=True)}
    want = {(i, j) for i in range(200) for j in range(i + 1, 200)
            if 9 * np.minimum(vec[i], vec[j]).sum() >= 4 * (n[i] + n[j]) and 5 * min(n[i], n[j]) >= 4 * max(n[i], n[j])}
    assert got == want and len(want) >= 50


def test_edge_cases(make_docs):
    assert J.join(make_docs([])).collect() == []
    docs = make_docs([(1, None), (2, ""), (3, " \n\t"), (4, "A b"), (5, "a B"), (6, "a b c"), (7, "long " * 60_000 + "end"),
                      (8, "long " * 60_000 + "end"), (9, "x y z u v"), (9, "x y z u v"), (9, "other words stand here now"), (None, "a b")])
    docs = docs.withColumns({c: F.lit(0) for c in ("n", "node", "vec", "key", "comp", "check", "copies", "rep")})
    got = sorted(((r.doc_id or 0), r.n_shingles, r.component_id) for r in J.join(docs).collect())
    assert got == [(0, 1, 4), (1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (5, 1, 4), (6, 1, 6), (7, 2, 7), (8, 2, 7),
                   (9, 1, 9), (9, 1, 9), (9, 1, 9)]
    kept = J.deduplicated(docs)
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id or 0), r.text or "") for r in kept.collect()) == sorted(
        [(1, ""), (2, ""), (3, " \n\t"), (4, "A b"), (6, "a b c"), (7, "long " * 60_000 + "end"), (9, "x y z u v"),
         (9, "other words stand here now")])


def test_finer_groups_bound_the_overlap_of_large_sets():
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(0, 1 << 64, n, np.uint64)) for n in (1500, 1500, 4000, 9000)]
    sets.append(np.unique(np.concatenate((sets[0][:1450], sets[1][:60]))))
    sets.append(np.unique(np.concatenate((sets[2], sets[0][:400]))))
    n, fine = np.array([len(s) for s in sets]), [J.fine_groups(s) for s in sets]
    x, y = np.triu_indices(len(sets), 1)
    keep = J.fine_bound(x, y, n, fine)
    for a, b, ok in zip(x, y, keep, strict=True):
        both = len(np.intersect1d(sets[a], sets[b]))
        if 100 * both >= 80 * (n[a] + n[b] - both):
            assert ok
    assert [(a, b) for a, b, ok in zip(x.tolist(), y.tolist(), keep, strict=True) if ok and (a, b) in {(0, 1), (0, 4), (2, 5)}] == [(0, 4), (2, 5)]
    assert J.fine_bound(x, y, n, [None] * len(sets)).all()
