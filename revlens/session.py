"""Session helpers.

``get_session`` builds a local session for tests and the bench; on a
cluster the caller's session is used as is.  ``checkpoint_dir`` reads
``spark.checkpoint.dir`` from the session and only sets one when it is
unset (tests), so lineage cuts land in the cluster's shared folder.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_session(master: str | None = None, shuffle_partitions: int = 8, app: str = "revlens") -> SparkSession:
    master = master or f"local[{os.environ.get('BENCH_CPUS', '8')}]"
    spark = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("REVLENS_DRIVER_MEM", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # The text operators fuse into large whole-stage methods; HotSpot
        # leaves methods over 8 000 bytecode bytes uncompiled by default,
        # which runs them interpreted.  Compile them and keep the fusion.
        .config("spark.driver.extraJavaOptions", "-XX:-DontCompileHugeMethods")
        .config("spark.executor.extraJavaOptions", "-XX:-DontCompileHugeMethods")
        .config("spark.sql.codegen.hugeMethodLimit", "65535")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    A scratch folder stands in only on a local master (tests), where driver
    and tasks are one process; elsewhere executors could not read it, so an
    unset folder is an error."""
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        if sc.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="revlens-ckpt-", dir=os.environ.get("REVLENS_SCRATCH", "/tmp"))
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d


def stored(df: DataFrame) -> DataFrame:
    """``df`` written once as Parquet below the shared checkpoint folder and read back: later uses read it, none computes it again."""
    spark = df.sparkSession
    checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
