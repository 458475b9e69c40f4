"""Registered queries against their DuckDB twins on the smallest tables
(a representative subset per family; the driver checks all at sf0.01)."""

import pytest

import __spark_entry__ as E
from oracle_harness import compare, duck_connect

SUBSET = ["label_distribution", "data_overview", "rating_histogram", "clean_text", "abbrev_norm", "negation_tags",
          "contrast_split", "lexicon_scores", "issue_tags", "complaint_unnegated", "triage_cascade", "risk_score",
          "playbook_route", "issue_mix", "binary_metrics", "band_sweep", "label_thresholds", "blend_weights",
          "bootstrap_ci", "mcnemar", "error_taxonomy", "batch_merge_dedup", "batch_conflicts", "quality_by_source",
          "label_validation", "top_idf_terms", "chi2_topk", "ngram_perplexity", "prototype_classify",
          "event_window_counts", "user_sessions"]


@pytest.fixture(scope="module")
def con(sf_small):
    return duck_connect(sf_small)


def test_every_query_has_builder_and_oracle_names_match():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(o) >= 60


@pytest.mark.parametrize("name", SUBSET)
def test_query_matches_oracle(spark, sf_small, con, name):
    r = compare(spark, E.queries()[name], E.oracle_sql()[name], sf_small, con)
    assert r["cols_match"], r
    assert r["spark_rows"] == r["duck_rows"], r
    assert r["hash_match"], r


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert [r["label"] for r in rows] == ["NEGATIVE", "NEEDS_ATTENTION", "UNCERTAIN", "POSITIVE"]
