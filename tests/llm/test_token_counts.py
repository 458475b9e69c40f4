import random

import regex
from pyspark.sql import functions as F

from revlens.llm import packing, token_counts

PATH = packing.vocabulary("word_bpe_49k.json")


def greedy(word, pieces):
    """Longest piece first, piece by piece."""
    symbols, n, at = [*word[:-1], word[-1] + 256], 0, 0
    while at < len(symbols):
        end = max(e for e in range(at + 1, len(symbols) + 1) if tuple(symbols[at:e]) in pieces)
        at, n = end, n + 1
    return n


def test_small_automaton_against_greedy():
    rnd = random.Random(2)
    singles = [[c] for c in range(512)]
    for _ in range(30):
        some = [[*[rnd.choice(b"ab") for _ in range(rnd.randint(0, 4))], rnd.choice(b"ab") + 256 * rnd.randint(0, 1)]
                for _ in range(12)]
        automaton, pieces = token_counts.Automaton(singles + some), {tuple(p) for p in singles + some}
        for _ in range(100):
            word = bytes(rnd.choice(b"ab") for _ in range(rnd.randint(1, 30)))
            assert automaton.count(word) == greedy(word, pieces)


def test_query_table_against_greedy(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").limit(40)
    pieces = {tuple(p) for p in token_counts.read_vocabulary(PATH)}
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in token_counts.token_counts(docs, PATH).collect():
        words = regex.findall(token_counts.WORD, texts[r.doc_id].lower())
        assert r.n_words == len(words)
        assert r.n_tokens == sum(greedy(w.encode(), pieces) for w in words)


def test_edge_cases(make_docs):
    assert token_counts.token_counts(make_docs([]), PATH).collect() == []
    docs = make_docs([(1, None), (2, ""), (3, " \n"), (4, "x" * 50_000), (5, "don't"), (5, "don't"), (None, "the the")])
    docs = docs.withColumns({"id": F.lit(0), "n_tokens": F.lit("x")})
    got = sorted((r.doc_id or 0, r.n_words, r.n_tokens) for r in token_counts.token_counts(docs, PATH).collect() if r.doc_id != 4)
    assert got[0] == (0, 2, 2) and got[1] == (1, None, None) and got[2:4] == [(2, 0, 0), (3, 0, 0)]
    assert got[4] == got[5] and got[4][1] == 2
