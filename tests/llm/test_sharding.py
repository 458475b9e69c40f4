import random
import zlib
from collections import defaultdict

import pytest

from revlens.llm import sharding


def optimum(sizes, shards):
    """Smallest capacity of a contiguous cut, by scanning every feasible value."""
    def fits(c):
        n, at = 1, 0
        for s in sizes:
            if s > c:
                return False
            if at + s > c:
                n, at = n + 1, 0
            at += s
        return n <= shards
    c = max(sizes)
    while not fits(c):
        c += 1
    return c


def check(rows, docs, shards):
    assert sorted(r.doc_id for r in rows if r.doc_id is not None) == sorted(d[0] for d in docs if d[0] is not None)
    assert len(rows) == len(docs)
    shard_of, slots, sizes = {}, defaultdict(list), defaultdict(int)
    for r in rows:
        assert 0 <= r.shard < shards
        assert shard_of.setdefault((r.size, r.text_crc32), r.shard) == r.shard
        slots[r.shard].append(r.slot)
        sizes[r.shard] += r.size
    for s in slots.values():
        assert sorted(s) == list(range(len(s)))
    return sizes


@pytest.mark.parametrize("index_size", [64, 16384])
def test_capacity_is_the_brute_force_optimum(spark, make_docs, index_size):
    rnd = random.Random(7)
    docs = [(i, rnd.choice("abcdé") * rnd.randint(0, 60)) for i in range(300)] + [(1000 + i, "copy" * 9) for i in range(150)]
    docs += [(5000 + i, f"{i} {'x' * rnd.randint(0, 90)}") for i in range(200)]
    rows = sharding.shard(make_docs(docs), 6, bins=16, salts=8, index_size=index_size).collect()
    sizes = check(rows, docs, 6)
    import hashlib
    groups = defaultdict(int)
    for _, t in docs:
        groups[hashlib.sha256(t.encode()).digest()] += len(t.encode()) + 8
    # the operator's order: hash range of the digest, then the digest
    from pyspark.sql import functions as F
    order = {bytes(r.g): r.bin for r in spark.createDataFrame([(k,) for k in groups], "g binary")
             .select("g", F.pmod(F.xxhash64("g"), F.lit(16)).alias("bin")).collect()}
    seq = [groups[g] for g in sorted(groups, key=lambda g: (order[g], g))]
    assert rows[0].capacity == optimum(seq, 6)
    assert max(sizes.values()) <= rows[0].capacity


def test_columns_and_sizes(make_docs):
    rows = {r.doc_id: r for r in sharding.shard(make_docs([(1, "né"), (2, None), (3, "")]), 3).collect()}
    assert rows[1].size == 11 and rows[1].text_crc32 == zlib.crc32("né".encode())
    assert rows[2].size == rows[3].size == 8 and rows[2].shard == rows[3].shard
    assert all(r.law == "bytes" and r.grown_shard is None for r in rows.values())


def test_edge_cases(spark, make_docs):
    assert sharding.shard(make_docs([]), 24).collect() == []
    docs = [(None, None), (1, "same"), (1, "same"), (2, "z" * 50_000)]
    check(sharding.shard(make_docs(docs), 24).collect(), docs, 24)
    clash = make_docs([(i, f"t{i}") for i in range(50)])
    from pyspark.sql import functions as F
    clash = clash.withColumns({c: F.lit("x") for c in ("g", "salt", "shard", "size", "bin", "rn", "k", "pg")})
    check(sharding.shard(clash, 5).collect(), [(i, "") for i in range(50)], 5)


def test_sizes_near_equal(make_docs):
    rnd = random.Random(3)
    docs = [(i, "w" * rnd.randint(10, 400)) for i in range(2000)]
    sizes = check(sharding.shard(make_docs([(i, f"{i}{t}") for i, t in docs]), 8).collect(), docs, 8)
    assert max(sizes.values()) - min(sizes.values()) <= 2 * 420
