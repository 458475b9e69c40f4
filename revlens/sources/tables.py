"""Driver-table scans.

Plain parquet reads: Catalyst prunes columns and pushes filters into the
scan, so callers ``select`` / ``where`` right after ``table``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fence(df: DataFrame, *keys: str) -> DataFrame:
    """Optimizer fence: later filters are evaluated above this projection.

    Catalyst pushes a filter through every deterministic projection by
    inlining the expressions it reads, so a filter on the output of an
    expensive per-row computation would recompute it inside the filter.
    Wrapping a needed column in an always-true non-deterministic guard
    keeps such filters here, after the computation ran once.  A column that
    nobody reads is pruned with its guard: name every column (``*df.columns``)
    where consumers differ in what they read.
    """
    from pyspark.sql import functions as F
    keys = keys or (df.columns[0],)
    return df.select(*[F.when(F.spark_partition_id() >= 0, F.col(c)).alias(c) if c in keys else F.col(c)
                       for c in df.columns])
