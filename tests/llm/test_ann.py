import numpy as np
import pytest
from pyspark.sql import functions as F

from revlens.llm import ann
from revlens.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int"


def exact(rows, k=10):
    out = {}
    for q, x in rows:
        if q % 100 == 0:
            d = sorted((float(np.sqrt(((np.asarray(x) - np.asarray(y)) ** 2).sum())), i) for i, y in rows if i != q and len(y) == len(x))
            out[q] = d[:k]
    return out


def test_hilbert_curve_walks_from_neighbour_to_neighbour():
    for bits, dims in ((2, 2), (3, 2), (2, 3)):
        grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
        keys = ann.hilbert_keys(grid, bits)
        walk = grid[np.argsort(keys)]
        assert sorted(keys) == list(range(len(grid))) and (np.abs(np.diff(walk, axis=0)).sum(1) == 1).all()


@pytest.mark.parametrize("tile", [8192, 16])
def test_recall_and_scores(spark, sf_small, tile):
    table = spark.read.parquet(f"{sf_small}/embeddings.parquet")
    rows = [(r.vec_id, np.asarray(r.embedding, float)) for r in table.collect()]
    want = exact(rows)
    got = ann.search(table, F.col("vec_id") % 100 == 0, tile=tile).collect()
    found = {q: {r.vec_id for r in got if r.query_id == q} for q in want}
    assert all(sorted(r.rank for r in got if r.query_id == q) == list(range(1, 11)) for q in want)
    score = {i: x for i, x in rows}
    for r in got:
        assert r.score == pytest.approx(np.sqrt(((score[r.query_id] - score[r.vec_id]) ** 2).sum()), abs=1e-12)
    assert sum(len(found[q] & {i for _, i in d}) for q, d in want.items()) >= 0.9 * 10 * len(want)


def test_copies_ties_and_rows_that_take_no_part(spark):
    rows = [(i, [1.0, 0.0, 0.0], 0) for i in range(0, 300)] + [(1000, [0.0, 0.0, 0.0], 0), (1100, None, 0), (1200, [1.0, None, 0.0], 0),
            (1300, [float("nan"), 1.0, 0.0], 0), (1400, [float("inf"), 1.0, 0.0], 0), (1500, [0.0, 1.0, 0.5], 0), (1600, [1.0, 2.0], 0), (1601, [1.0, 1.0], 0),
            (None, [1.0, 0.0, 0.0], 0)]
    table = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(7) for c in ("h", "cid", "key", "vec", "dim", "q", "ids")})
    got = ann.search(table, F.col("vec_id") % 100 == 0).collect()
    lists = {q: [(r.vec_id, r.score) for r in sorted(got, key=lambda r: r["rank"]) if r.query_id == q] for q in {r.query_id for r in got}}
    assert set(lists) == {0, 100, 200, 1500, 1600}
    assert lists[0] == [(i, 0.0) for i in range(1, 11)] and lists[200] == lists[100] == [(i, 0.0) for i in range(10)]
    assert [v for v, _ in lists[1500]] == list(range(10)) and lists[1600] == [(1601, 1.0)]


def test_empty_table(spark):
    assert ann.search(spark.createDataFrame([], SCHEMA), F.col("vec_id") % 100 == 0).collect() == []


def test_query_columns(spark, sf_small):
    df = QUERIES["op1_ann"](spark, sf_small)
    assert df.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "double")]
