"""Open lists are dealt to tasks without a join of their rows by component."""

import pytest

from revlens.llm import ngram_join as J
from tests.llm.test_ngram_join import brute, corpus, result


@pytest.fixture
def small(monkeypatch):
    for name, value in (("BLOCK", 4), ("LEAF", 2), ("TASK_ROWS", 5), ("TASK_BYTES", 3000), ("HOT_LEAST", 6)):
        monkeypatch.setattr(J, name, value)


def test_dealt_rows_are_stored(spark, monkeypatch):
    rows = spark.createDataFrame([(k, 0, b, n, n, n, k % 3) for k in range(12) for b in range(2) for n in range(4)],
                                 "key long, i int, j int, own int, node long, comp long, near long")
    made = J.dealt(rows, J.F.lit(1), 8)
    assert "Join" not in made._jdf.queryExecution().optimizedPlan().toString()  # its two readers do not join again
    tasks = {}
    for r in made.collect():
        tasks.setdefault((r.key, r.i, r.j), set()).add(r.task)
    assert len(tasks) == 24 and all(len(t) == 1 for t in tasks.values())  # a list's block pair in one task
    assert len(set.union(*tasks.values())) > 3


def test_lists_in_many_parts_lose_no_link(make_docs, small, monkeypatch):
    seen, plain = [], J.parted

    def parted(rows, weight, room):
        made, task = plain(rows, weight, room)
        seen.append((rows.columns, made.where("parts > 1").count(), rows.count(), rows.select("key").distinct().count()))
        return made, task

    monkeypatch.setattr(J, "parted", parted)
    docs = corpus(3)
    assert result(J.join(make_docs(docs))) == brute(docs)
    columns, several, n, lists = seen[0]
    assert "node" not in columns and n == lists  # one row a list
    assert several > 0
