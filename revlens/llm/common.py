"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from revlens.session import checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A folder of its own below the shared checkpoint folder."""
    checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage: write ``df`` as Parquet below the shared checkpoint
    folder and read it back.  A lost executor then costs a re-read, not a
    recomputation, and every later use sees the same rows."""
    spark, path = df.sparkSession, fresh_folder(df.sparkSession, "table")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers once per application, so that
    tasks import it wherever the driver was started."""
    sc, root = spark.sparkContext, Path(__file__).resolve().parents[1]
    if root.is_dir() and not getattr(sc, "_revlens_shipped", False):
        made = shutil.make_archive(f"{tempfile.mkdtemp()}/{root.name}", "zip", root_dir=root.parent, base_dir=root.name)
        sc.addPyFile(made)
        sc._revlens_shipped = True
