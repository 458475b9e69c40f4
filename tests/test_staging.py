"""Plans of shared views and one-pass label queries: filters do not rebuild a view, nothing is multiplied or read twice."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from revlens.functions import constants as K
from revlens.operators import labels as LB
from revlens.operators import triage as TR


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name", ["mismatch_by_stars", "attention_queue", "mismatch_by_segment", "batch_conflicts", "labelled_drops"])
def test_no_filter_rebuilds_the_view(spark, sf_small, name):
    filters = [line for line in optimized(E.queries()[name](spark, sf_small)).split("\n") if "Filter (" in line or "Filter NOT" in line]
    assert not [f for f in filters if "md5" in f or "regexp_replace" in f]


def test_playbook_is_planned_without_a_join(spark):
    df = spark.createDataFrame([(1, K.PLAYBOOK[0][0], 90), (2, "nothing", 60), (3, None, 0)], "id int, issue string, nr int")
    out = TR.with_playbook(df, F.col("issue"), F.col("nr"))
    assert "Join" not in optimized(out)
    got = {r["id"]: (r["owner"], r["outcome"], r["sla"]) for r in out.collect()}
    assert got == {1: (*K.PLAYBOOK[0][1:], "Respond in 2h"), 2: (*K.PLAYBOOK_DEFAULT, "Respond in 8h"), 3: (*K.PLAYBOOK_DEFAULT, "Monitor in 24h")}


def test_conflicts_count_null_as_a_value_and_multiply_no_rows(spark):
    rows = [("a", 0, "x"), ("a", 0, "x"), ("b", 0, "x"), ("b", 1, "x"), ("c", None, "x"), ("c", 1, "x"), ("d", None, None),
            ("d", None, None), ("e", 1, "x"), ("e", 1, "y"), ("f", 1, None), ("f", 1, "y"), (None, 0, "x"), (None, 1, "x")]
    out = LB.conflicts(spark.createDataFrame(rows, "id string, l int, m string"), labels=["l", "m"])
    assert "Expand" not in optimized(out)
    assert sorted(r["id"] for r in out.collect()) == ["b", "b", "c", "c", "e", "e", "f", "f"]


@pytest.mark.parametrize("name", ["label_validation", "labelset_split"])
def test_the_view_is_read_once(spark, sf_small, name):
    assert optimized(E.queries()[name](spark, sf_small)).count("Relation [") == 1


def test_validation_counts_rows_and_ids(spark):
    cells = [("1", "1", "0"), ("1.0", "1", "0"), ("2", "0", "0"), (" 2 ", "1", "0"), ("", "x", "0"), (None, "1", "1"), ("3", "1", "1")]
    df = spark.createDataFrame(cells, "id string, a string, other string")
    got = {r["rule"]: r["n_bad"] for r in LB.validation_rules(df, labels=["a", "other"]).collect()}
    assert got == {"missing_id": 2, "non_binary": 1, "zero_label": 2, "other_with_label": 2, "duplicate_ids": 2, "duplicate_rows": 4,
                   "conflicting_ids": 1}
    assert all(r["n_bad"] == 0 for r in LB.validation_rules(df.limit(0), labels=["a", "other"]).collect())
