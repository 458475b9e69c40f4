"""Plan properties: no Python in the text hot path, pruned scans."""

import pytest

import __spark_entry__ as E


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_text_queries_stay_in_jvm(spark, sf_small):
    q = E.queries()
    for name in ["clean_text", "negation_tags", "lexicon_scores", "triage_cascade", "issue_tags"]:
        p = _plan(q[name](spark, sf_small))
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p, name


def test_review_scan_reads_only_needed_columns(spark, sf_small):
    p = _plan(E.queries()["clean_text"](spark, sf_small))
    scan = [line for line in p.split("\n") if "FileScan parquet" in line][0]
    assert "l_extendedprice" not in scan and "l_returnflag" not in scan


@pytest.mark.parametrize("name", ["batch_merge_dedup", "batch_conflicts", "labelled_set", "label_frequency", "labelled_drops"])
def test_label_stages_compile(spark, sf_small, name):
    """No stage falls back to the interpreter."""
    conf = {"spark.sql.codegen.fallback": "false", "spark.sql.codegen.factoryMode": "CODEGEN_ONLY"}
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        E.queries()[name](spark, sf_small).write.format("noop").mode("overwrite").save()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_long_fused_methods_are_not_interpreted(spark, sf_small):
    """Unless the JVM compiles long methods, a query sets the limit above which stages are not fused."""
    before = spark.conf.get("spark.sql.codegen.hugeMethodLimit")
    flagged = "-XX:-DontCompileHugeMethods" in spark.sparkContext.getConf().get("spark.executor.extraJavaOptions", "")
    try:
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", "65535")
        E.queries()["split_summary"](spark, sf_small)
        assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == ("65535" if flagged else "8000")
    finally:
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", before)


def test_conflicts_filter_the_batches_once(spark, sf_small):
    """Aggregate and join read the stored rows; neither makes the batches from the source again."""
    assert "lineitem" not in _plan(E.queries()["batch_conflicts"](spark, sf_small))


def test_routing_reads_its_decisions_once(spark, sf_small):
    """All caps and scorers in one pass over the stored reviews."""
    plan = _plan(E.queries()["hybrid_routing"](spark, sf_small))
    assert plan.split("== Initial Plan ==")[0].count("FileScan parquet") == 1 and "lineitem" not in plan


def test_multilabel_chi2_sums_in_the_rows(spark, sf_small):
    """A vocabulary within the cap: no (review, term) rows are joined or sorted."""
    plan = _plan(E.queries()["chi2_multilabel"](spark, sf_small))
    assert "Join" not in plan and "lineitem" not in plan


def test_multilabel_chi2_above_the_cap(spark, sf_small, monkeypatch):
    """A vocabulary above the cap is joined by term and gives the same."""
    from revlens.operators import textvec as V
    q = E.queries()["chi2_multilabel"]
    rows = [tuple(r) for r in q(spark, sf_small).collect()]
    monkeypatch.setattr(V, "MAX_FEATURES", 3)
    assert [tuple(r) for r in q(spark, sf_small).collect()] == rows
