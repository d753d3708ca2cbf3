"""Reading back stored results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def latest_run(history: DataFrame, run: str = "run_ts", by: Sequence[str] = ()) -> DataFrame:
    """Rows of the newest run, or of the newest run of each ``by`` group.

    The newest run is a scalar subquery on the partition column, so the scan prunes to its partition.
    """
    if not by:
        return history.filter(F.col(run) == history.agg(F.max(run)).scalar())
    newest = history.groupBy(*by).agg(F.max(run).alias(run))
    return history.join(newest, [*by, run], "left_semi")


def read_results(spark: SparkSession, root: str, name: str, vintage: str | None = None) -> DataFrame:
    """Newest stored run of a result table written by ``sinks.writers.write_run``."""
    history = spark.read.option("basePath", f"{root}/{name}").parquet(f"{root}/{name}")
    history = history.withColumn("vintage", F.col("vintage").cast("string"))
    if vintage is not None:
        history = history.filter(F.col("vintage") == vintage)
    return latest_run(history)


#: File that names the folder of a result's current copy.
POINTER = "_current"


def current_copy(spark: SparkSession, root: str, name: str) -> str | None:
    """Folder name of the copy that holds, None if nothing has been published."""
    jvm = spark.sparkContext._jvm
    pointer = jvm.org.apache.hadoop.fs.Path(f"{root}/current/{name}/{POINTER}")
    system = pointer.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not system.exists(pointer):
        return None
    stream = system.open(pointer)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").strip()
    finally:
        stream.close()


def read_current(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The current copy of a result, as the last run that published one left it."""
    copy = current_copy(spark, root, name)
    if copy is None:
        raise FileNotFoundError(f"no current copy of {name} under {root}")
    return spark.read.parquet(f"{root}/current/{name}/{copy}")
