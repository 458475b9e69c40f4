import random

from pyspark.sql import functions as F

from revlens.llm import license_scan as L


def test_increasing_is_the_longest():
    rnd = random.Random(4)
    for _ in range(60):
        b = rnd.sample(range(12), 9)
        got = L.increasing(list(enumerate(b)))
        best = max(bin(m).count("1") for m in range(1 << 9)
                   if (s := [b[i] for i in range(9) if m >> i & 1]) == sorted(s))
        assert len(got) == best and [y for _, y in got] == sorted(y for _, y in got)


def test_alignment_is_increasing_and_equal():
    rnd = random.Random(9)
    for _ in range(50):
        a = [rnd.choice("abcdefgh") for _ in range(30)]
        b = [w for w in a if rnd.random() > 0.2] + ["z"]
        pairs = L.align(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:], strict=False))


def test_every_template_is_found_whole_and_damaged():
    scanner = L.Scanner(L.TEMPLATES, 0.85)
    for name, texts in L.TEMPLATES.items():
        for t in texts:
            hits = scanner.scan(f"Some words before.\n{t.upper()} and after it")
            assert [h[0] for h in hits] == [name] and hits[0][3] == 1.0 and hits[0][1] == 3, (name, hits)
            ws = t.split()
            if len(ws) > 20:
                assert [h[0] for h in scanner.scan("x " + " ".join(ws[:9] + ["odd"] + ws[10:]))] == [name]


def test_neighbours_are_told_apart():
    scanner = L.Scanner(L.TEMPLATES, 0.85)

    def found(text):
        return [h[0] for h in scanner.scan(f"some words {text} and others")]
    work = "This work is licensed under "
    for text, name in [
            (work + "the GNU General Public License, version 2", "GPL-2.0"), (work + "the GNU General Public License, version 2.0.", "GPL-2.0"),
            (work + "the GNU General Public License, version 3", "GPL-3.0"), (work + "the GNU Lesser General Public License, version 3", "LGPL-3.0"),
            (work + "the GNU Lesser General Public License, version 2.1.", "LGPL-2.1"), (work + "the GNU Affero General Public License, version 3", "AGPL-3.0"),
            ("Licensed under CC BY-ND 4.0.", "CC-BY-ND-4.0"), ("Licensed under CC BY-NC-SA 4.0.", "CC-BY-NC-SA-4.0"), ("Licensed under CC BY 3.0.", "CC-BY-3.0"),
            (work + "a Creative Commons Attribution-ShareAlike 4.0 International License", "CC-BY-SA-4.0"),
            ("Licensed under the Mozilla Public License, Version 2.0.", "MPL-2.0"), ("Licensed under the Eclipse Public License, Version 2.0.", "EPL-2.0")]:
        assert found(text) == [name], (text, found(text))
    assert found(work + "the GNU General Public License, version 4") == []
    assert found("Licensed under CC BY-NC 4.0. Licensed under CC BY 4.0.") == ["CC-BY-NC-4.0", "CC-BY-4.0"]


def test_whole_texts_are_told_apart():
    scanner = L.Scanner(L.TEMPLATES, 0.85)
    whole = {name: L.TEMPLATES[name][-1] for name in L.WHOLE}
    assert len(L.words(whole["GPL-3.0"])) > 5000
    for name in ("BSD-2-Clause", "BSD-3-Clause", "BSD-4-Clause", "ISC", "0BSD", "MIT", "MIT-0", "GPL-2.0", "LGPL-2.0", "LGPL-2.1"):
        ws = whole[name].split()
        ws[len(ws) // 2] = "odd"
        assert [h[0] for h in scanner.scan(" ".join(ws))] == [name]
    for name in ("MIT", "BSD-3-Clause", "ISC"):  # an opening is not the license
        assert scanner.scan(" ".join(whole[name].split()[:30])) == []


def test_nothing_in_clean_texts(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    rows = L.scan(docs).collect()
    marked = {r.doc_id for r in docs.collect() if "licensed under" in r.text.lower() or "mit license" in r.text.lower()}
    assert {r.doc_id for r in rows} == marked


def test_edge_cases(make_docs):
    assert L.scan(make_docs([])).collect() == []
    mit = "Released under the MIT License."
    docs = make_docs([(1, None), (2, ""), (3, "filler " * 60_000 + mit), (4, f"{mit} {mit}"), (4, f"{mit} {mit}"), (None, mit)])
    rows = L.scan(docs.withColumns({"license": F.lit(1), "coverage": F.lit(2)})).collect()
    assert sorted((r.doc_id or 0, r.start_word) for r in rows) == [(0, 0), (3, 60_000), (4, 0), (4, 0), (4, 5), (4, 5)]
    assert L.scan(docs, {}).collect() == []
