"""Job runner argument checks and model bundle round trip."""

import tempfile

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF

from revlens.plans import jobs


@pytest.mark.parametrize("lo,hi", [(-0.1, 0.6), (0.4, 1.2), (0.7, 0.6)])
def test_band_validation(lo, hi):
    with pytest.raises(ValueError):
        jobs.check_band(lo, hi)


def test_unknown_step(spark, sf_small):
    with pytest.raises(ValueError):
        jobs.run(spark, sf_small, ["no_such_step"], tempfile.mkdtemp(dir="/tmp"))


def test_run_writes_steps(spark, sf_small):
    out = jobs.run(spark, sf_small, ["label_distribution"], tempfile.mkdtemp(dir="/tmp"))
    assert spark.read.parquet(out["label_distribution"]).count() == 4


def test_bundle_round_trip(spark):
    df = spark.createDataFrame([(["good"], 1.0), (["bad"], 0.0)] * 5, "tokens array<string>, label double")
    pipe = Pipeline(stages=[HashingTF(inputCol="tokens", outputCol="features", numFeatures=64),
                            LogisticRegression(maxIter=5)]).fit(df)
    d = tempfile.mkdtemp(dir="/tmp")
    jobs.save_bundle(pipe, {"thresholds": [0.4, 0.6], "min_nnz": 2}, d)
    m, cfg = jobs.load_bundle(spark, d)
    assert cfg["min_nnz"] == 2 and m.transform(df).count() == 10
