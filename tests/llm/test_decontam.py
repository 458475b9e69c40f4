from pyspark.sql import functions as F

from revlens.llm import decontam as D
from revlens.llm.queries import ORACLES, QUERIES

ITEM = "one two three four five six seven eight nine ten eleven twelve"
B = "item_id long, text string"


def hits(docs, bench):
    return sorted((r.doc_id, r.item_id, r.start_word, r.n_words, round(r.similarity, 6)) for r in D.find(docs, bench).collect())


def test_passages_are_found_where_they_stand(spark, make_docs):
    bench = spark.createDataFrame([(1, ITEM), (2, "alpha beta gamma delta epsilon zeta"), (3, "tiny item"), (4, ITEM)], B)
    docs = make_docs([(1, f"before it {ITEM} after"), (2, ITEM.upper().replace(" ", "!! ")), (3, "nothing to see here at all"),
                      (4, f"{ITEM} and {ITEM}"), (5, " ".join(ITEM.split()[:11])), (6, " ".join(ITEM.split()[:8])),
                      (7, "a TINY, item"), (8, "x alpha beta gamma delta epsilon zeta")])
    got = hits(docs, bench)
    assert [g[:4] for g in got if g[1] != 4] == [(1, 1, 2, 12), (2, 1, 0, 12), (4, 1, 0, 12), (4, 1, 13, 12), (5, 1, 0, 11),
                                                 (7, 3, 1, 2), (8, 2, 1, 6)]
    assert {g[0] for g in got if g[1] == 4} == {1, 2, 4, 5}
    assert [g[4] for g in got if g[0] == 5] == [round(7 / 8, 6)] * 2


def test_large_benchmark_path_gives_the_same(spark, make_docs, monkeypatch, sf_small):
    docs, bench = (spark.read.parquet(f"{sf_small}/{t}.parquet") for t in ("documents", "benchmark"))
    want = hits(docs, bench)
    monkeypatch.setattr(D, "LITERALS", 3)
    assert hits(docs, bench) == want and want


def test_blocks_find_every_fingerprint_within_the_radius(spark):
    import random
    rnd = random.Random(6)
    rows = []
    for _ in range(200):
        a, b = rnd.getrandbits(64), 0
        b = a
        for bit in rnd.sample(range(64), D.RADIUS):
            b ^= 1 << bit
        rows.append(tuple(x - (1 << 64) if x >> 63 else x for x in (a, b)))
    df = spark.createDataFrame(rows, "a long, b long")
    same = F.arrays_overlap(D.blocks(F.col("a")), D.blocks(F.col("b")))
    assert df.where(same).count() == 200
    assert df.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) != D.RADIUS).count() == 0


def test_simhash_takes_the_majority_of_bits(spark):
    df = spark.createDataFrame([([0b110, 0b100, 0b001],), ([-1],), ([5, 5, 2],)], "sh array<long>")
    assert [r[0] for r in df.select(D.simhash(F.col("sh"))).collect()] == [0b100, -1, 5]


def test_query_equals_its_sql(spark, sf_small):
    from oracle_harness import compare
    r = compare(spark, QUERIES["op8_decontam"], ORACLES["op8_decontam"], sf_small)
    assert r["hash_match"] and r["cols_match"], r


def test_edge_cases(spark, make_docs):
    bench = spark.createDataFrame([(1, ITEM), (1, ITEM), (None, ITEM), (2, None), (3, " !! ")], B).withColumn("sh", F.lit(1))
    assert hits(make_docs([]), bench) == []
    docs = make_docs([(1, None), (2, ""), (3, "?!"), (4, ITEM), (4, ITEM), (5, "pad " * 60_000 + ITEM)])
    docs = docs.withColumns({c: F.lit(0) for c in ("sh", "w", "hits", "start", "item_id", "pos")})
    assert [h[:3] for h in hits(docs, bench)] == [(4, 1, 0), (5, 1, 60_000)]
    assert hits(docs, bench.where("false")) == []
