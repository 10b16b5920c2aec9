"""Session construction and lineage cuts.

Library code never creates its own session; callers pass one in.  ``local_session``
exists for tests, the bench and the smoke entry.  ``checkpoint`` is the only way
this package cuts lineage: a reliable checkpoint into the folder named by
``spark.checkpoint.dir`` (shared storage on a cluster).  A private folder is only
chosen when the session has none, which happens in local tests.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "yardstick") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session; one is set only when none is configured."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="yardstick-ckpt-")  # local runs: tests and the bench
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the checkpoint directory for written intermediate tables."""
    base = checkpoint_dir(spark)
    if base.startswith("file:"):
        base = base[len("file:"):]
    path = os.path.join(base, "tables", f"{name}-{os.getpid()}-{next(_counter)}")
    return path


def _count():
    i = 0
    while True:
        i += 1
        yield i


_counter = _count()


def checkpoint(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (survives executor loss), never a local one."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def materialised(df: DataFrame, name: str) -> DataFrame:
    """The rows written once as Parquet below the checkpoint directory and read back:
    lineage is cut as by ``checkpoint``, and later readers take only the columns they use."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("error").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
