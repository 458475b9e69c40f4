import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from revlens.llm import pii
from test_ngram_join import brute


@pytest.fixture(scope="module")
def steps(spark, sf_small):
    from revlens.llm.common import cut, table
    docs, out = table(spark, sf_small, "documents"), []
    for name, stage in P.STAGES:
        made = cut(stage(spark, docs, sf_small))
        out.append((name, docs, made))
        docs = made
    return {name: (a, b) for name, a, b in out}


def test_stages_keep_the_columns(steps):
    assert [n for n, _ in P.STAGES] == ["language", "near_duplicates", "decontaminate", "pseudonymise", "pack"]
    for name, (a, b) in list(steps.items())[:-1]:
        assert b.columns == a.columns, name
        assert b.dtypes == a.dtypes, name


def test_each_stage_against_brute_force(spark, sf_small, steps):
    rows = {n: ({r.doc_id: r.text for r in a.collect()}, {r.doc_id: getattr(r, "text", None) for r in b.collect()})
            for n, (a, b) in steps.items()}
    a, b = rows["language"]
    assert set(b) == set(a)  # every text here has a language
    a, b = rows["near_duplicates"]
    assert set(b) == {c for _, _, c in brute(list(a.items()))}
    a, b = rows["decontaminate"]
    flat = lambda t: " " + " ".join(re.findall(r"[^\W_]+", t.lower())) + " "
    items = [flat(r.text) for r in spark.read.parquet(f"{sf_small}/benchmark.parquet").collect()]
    assert set(a) - set(b) == {d for d, t in a.items() if any(i in flat(t) for i in items)}
    a, b = rows["pseudonymise"]
    change = pii.Pseudonyms(P.pii_key(spark).encode())
    assert b == {d: change(t)[0] for d, t in a.items()} and a != b
    a, _ = rows["pack"]
    packed = steps["pack"][1]
    assert {r.doc_id for r in packed.collect()} == set(a)
    assert packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 2048").count() == 0


def test_edge_cases(spark, make_docs, sf_small):
    rows = [(i, f"the thing and then some other words of text number {i} " * 3, "en") for i in range(12)]
    rows += [(50, None, None), (51, "", "en"), (52, "12 !!", "en"), (0, rows[0][1], "en"), (None, rows[1][1], None),
             (60, "words and things " * 20_000, None)]
    docs = make_docs(rows).withColumns({"score": F.lit(1), "node": F.lit("x")})
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, docs, sf_small)
        assert out.columns == docs.columns
        kept = [r.doc_id for r in out.collect()]
        if name == "language":
            assert not {50, 51, 52} & set(kept) and len(kept) == len(rows) - 3
        if name == "near_duplicates":
            assert sorted(k for k in kept if k is not None and k < 50) == list(range(12)) and None not in kept
        empty = stage(spark, docs.where("false"), sf_small)
        assert empty.collect() == [] and empty.columns == docs.columns
    assert P.pack(spark, docs.where("false"), sf_small).collect() == []


def test_a_contaminated_row_goes_alone(spark, make_docs, sf_small):
    item = spark.read.parquet(f"{sf_small}/benchmark.parquet").where("text is not null").orderBy("item_id").first().text
    docs = make_docs([(1, f"before {item} after"), (1, "a clean text with the same id"), (None, item), (None, "a clean text without an id")])
    assert sorted(r.text for r in P.decontaminate(spark, docs, sf_small).collect()) == [
        "a clean text with the same id", "a clean text without an id"]
