import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as E
from oracle_harness import compare
from revlens.llm import fill_in_middle as fim

ODD = ["", None, "a", "日本語 ünï 😀😀 x", "has <P> inside", "<S>", "a<M", "x\0y\n\n", "<<P<S", "é" * 5000, "word " * 30_000, "😀"]


def plain_form(doc_id, text, percent=90, spm=20):
    """The contract, word for word."""
    t = text or ""
    x = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(x[8 * i:8 * i + 8], 16) for i in range(4))
    n = len(t)
    i, j = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not t or any(s in t for s in fim.SENTINELS) or h3 % 100 >= percent:
        return n, "plain", None, None, t
    p, m, s = t[:i], t[i:j], t[j:]
    if h4 % 100 < spm:
        return n, "spm", i, j - i, f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", i, j - i, f"<P>{p}<S>{s}<M>{m}"


def buffers(texts):
    raw = [t.encode() if isinstance(t, str) else t for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]), raw


@given(st.lists(st.text(alphabet=st.sampled_from("aé日😀\n \0"), max_size=30), max_size=12))
@settings(max_examples=300, deadline=None)
def test_every_cut_of_code_points(texts):
    data, bounds, raw = buffers(texts)
    units = fim.Units(data, bounds)
    rank = units.rank(bounds)
    for i, t in enumerate(texts):
        assert rank[i + 1] - rank[i] == len(t)
        got = units.select(rank[i] + np.arange(1, len(t) + 1)) - bounds[i]
        assert got.tolist() == [len(t[:k].encode()) for k in range(1, len(t) + 1)]


@given(st.lists(st.text(alphabet="ab\n", max_size=30), max_size=12))
@settings(max_examples=200, deadline=None)
def test_every_cut_of_lines_and_bytes(texts):
    data, bounds, raw = buffers(texts)
    for unit in ("line", "byte"):
        units = fim.Units(data, bounds, unit)
        rank = units.rank(bounds)
        for i, t in enumerate(raw):
            parts = t.splitlines(keepends=True) if unit == "line" else [t[k:k + 1] for k in range(len(t))]
            assert rank[i + 1] - rank[i] == len(parts)
            got = units.select(rank[i] + np.arange(1, len(parts) + 1)) - bounds[i]
            assert got.tolist() == np.cumsum([len(x) for x in parts]).tolist()


def test_bytes_that_are_no_utf8_stay_with_their_text():
    data, bounds, raw = buffers([b"a", b"\x80\x80", b"\xe6\x97", b"", b"z"])
    units = fim.Units(data, bounds)
    assert np.diff(units.rank(bounds)).tolist() == [1, 1, 1, 0, 1]
    assert units.select(np.arange(1, 5)).tolist() == [1, 3, 5, 6]


def test_equals_the_contract(make_docs):
    rows = [(i, t) for i in range(60) for t in ODD[i % len(ODD):i % len(ODD) + 1]] + [(None, "no id"), (7, "twice"), (7, "twice")]
    made = fim.restore(fim.transform(make_docs(rows))).collect()
    got = sorted((str(r.doc_id), r.n, r.form, r.prefix_units, r.middle_units, r.output, r.restored) for r in made)
    want = sorted((str(i), *plain_form(i, t), t or "") for i, t in rows)
    assert [tuple(map(str, r)) for r in got] == [tuple(map(str, r)) for r in want]
    assert {r.form for r in made} == {"plain", "psm", "spm"}


def test_small_blocks_give_the_same(make_docs, monkeypatch):
    rows = [(i, ODD[i % len(ODD)]) for i in range(40)]
    whole = sorted(map(str, fim.transform(make_docs(rows)).collect()))
    bounds = np.cumsum([0, 5, 0, 100, 3, 0])
    monkeypatch.setattr(fim, "TOGETHER", 10)
    assert list(fim._blocks(bounds)) == [(0, 2), (2, 3), (3, 5)]
    assert sorted(map(str, fim.transform(make_docs(rows)).collect())) == whole


def test_parameters(make_docs):
    docs = make_docs([(i, "one\ntwo\nthree") for i in range(30)])
    marks = ("[pre]", "[suf]", "[mid]")
    rows = fim.restore(fim.transform(docs, unit="line", sentinels=marks, fim_percent=100, spm_percent=100), sentinels=marks).collect()
    assert {r.form for r in rows} == {"spm"} and {r.n for r in rows} == {3}
    assert all(r.restored == "one\ntwo\nthree" and r.output.startswith("[suf]") for r in rows)
    assert fim.transform(docs, fim_percent=0).where("form <> 'plain' OR prefix_units IS NOT NULL").count() == 0
    with pytest.raises(ValueError):
        fim.transform(docs, unit="word")
    with pytest.raises(ValueError):
        fim.transform(docs, sentinels=("a", "a", "b"))


def test_damaged_output_raises():
    with pytest.raises(ValueError):
        fim.rebuild(b"x<S>y<M>z", "psm", b"<P>", b"<S>", b"<M>")
    with pytest.raises(ValueError):
        fim.rebuild(b"<P>x<S>y", "psm", b"<P>", b"<S>", b"<M>")


def test_edge_cases(make_docs):
    assert fim.restore(fim.transform(make_docs([]))).collect() == []
    docs = make_docs([(1, "a")]).withColumns({c: F.lit("x") for c in ("n", "form", "output", "restored", "prefix_units")})
    assert fim.restore(fim.transform(docs)).first().restored == "a"


def test_query_equals_sql(spark, sf_small):
    r = compare(spark, E.queries()["op11_fill_in_middle"], E.oracle_sql()["op11_fill_in_middle"], sf_small)
    assert r["cols_match"] and r["hash_match"] and r["spark_rows"] > 0, r
