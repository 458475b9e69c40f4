"""Stepwise job selection (LBL-6) and model bundles (SRC-9).

``run(steps, ...)`` validates its arguments like the command line did
(known steps, thresholds in [0, 1], lo ≤ hi) and materialises each named
query to ``out_dir/<name>`` as parquet, so a lost executor only re-runs
the stage it held and finished steps stay on shared storage.
"""

from __future__ import annotations

import json
import os

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession

from .registry import QUERIES, load_all


def check_unit_interval(name: str, v: float) -> float:
    v = float(v)
    if not 0.0 <= v <= 1.0:
        raise ValueError(f"{name} must be in [0, 1], got {v}")
    return v


def check_band(lo: float, hi: float) -> tuple[float, float]:
    lo, hi = check_unit_interval("lo", lo), check_unit_interval("hi", hi)
    if lo > hi:
        raise ValueError(f"lo ({lo}) must not exceed hi ({hi})")
    return lo, hi


def run(spark: SparkSession, sf_dir: str, steps: list[str], out_dir: str, lo: float = 0.40, hi: float = 0.60) -> dict:
    load_all()
    check_band(lo, hi)
    unknown = [s for s in steps if s not in QUERIES]
    if unknown:
        raise ValueError(f"unknown steps: {unknown}")
    done = {}
    for name in steps:
        path = os.path.join(out_dir, name)
        QUERIES[name](spark, sf_dir).write.mode("overwrite").parquet(path)
        done[name] = path
    return done


def save_bundle(model: PipelineModel, config: dict, path: str) -> None:
    """SRC-9: fitted pipeline plus a one-row config table."""
    model.write().overwrite().save(os.path.join(path, "model"))
    spark = SparkSession.getActiveSession()
    spark.createDataFrame([(json.dumps(config, sort_keys=True),)], "config string").write.mode(
        "overwrite").json(os.path.join(path, "config"))


def load_bundle(spark: SparkSession, path: str) -> tuple[PipelineModel, dict]:
    model = PipelineModel.load(os.path.join(path, "model"))
    cfg = json.loads(spark.read.json(os.path.join(path, "config")).first()["config"])
    return model, cfg
