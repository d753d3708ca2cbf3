"""Session helpers: where intermediate results are kept, and settings for a local session."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder from ``spark.checkpoint.dir``.

    Only a local-mode session, where every executor is this process, falls back to a folder of its own.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="regional-balance-")
    sc.setCheckpointDir(folder)
    return folder


def settle(df: DataFrame) -> DataFrame:
    """Compute a frame once and keep it in the shared folder.

    For frames that several branches of a plan read and whose values are floating sums: a sum depends on the order
    in which partial sums arrive, so two evaluations can differ in the last bit and no longer be equal keys.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint()


def local_session(cores: int | str = "*", **settings: str) -> SparkSession:
    """A local session for tests and benchmarks; on a cluster the session comes from the submitter."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("regional-balance")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "8g")
    )
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
