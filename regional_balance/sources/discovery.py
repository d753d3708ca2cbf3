"""Finding input files: list, classify by name, take the newest of each role."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regional_balance import schema as S
from regional_balance.functions import columns as C


def list_files(spark: SparkSession, raw: str, top: str | None = None, max_depth: int | None = S.MAX_LISTING_DEPTH) -> DataFrame:
    """(path, modificationTime, length) of files under ``raw`` up to a depth, and of table files right in ``top``.

    ``max_depth`` None has no bound; ``too_deep`` gives the files that a bound leaves out.
    Contents are not read: the scan is pruned to the listing columns. Names starting with ``_`` or ``.`` are
    hidden by Spark's listing.
    """
    fields = ["path", "modificationTime", "length"]
    under = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(raw).select(*fields)
    found = under if max_depth is None else under.filter(_depth(raw) <= max_depth)
    if top is not None:
        glob = "*.{" + ",".join(S.TOP_LEVEL_EXTENSIONS) + "}"
        tables = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(f"{top.rstrip('/')}/*")
        parent = F.regexp_replace("path", r"/[^/]*$", "")
        found = found.unionByName(tables.select(*fields).filter(parent.endswith(_plain(top))))
    return found.dropDuplicates(["path"])


def too_deep(spark: SparkSession, raw: str, max_depth: int = S.MAX_LISTING_DEPTH) -> DataFrame:
    """(path) of the files under ``raw`` that ``list_files`` leaves out for their depth."""
    under = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(raw).select("path")
    return under.filter(_depth(raw) > max_depth)


def _depth(raw: str) -> Column:
    """Number of names of ``path`` below ``raw``."""
    root = F.concat(F.lit(r"\Q"), F.lit(_plain(raw)), F.lit(r"/\E"))
    return F.size(F.split(F.element_at(F.split(F.col("path"), root, 2), -1), "/"))


def _plain(folder: str) -> str:
    """Folder without scheme and trailing slash, as it appears inside listed paths."""
    return folder.rstrip("/").split("://", 1)[-1].removeprefix("file:")


def candidate_files(listing: DataFrame) -> DataFrame:
    """Add ``role`` and keep files whose extension that role can read."""
    ext = C.file_extension(F.col("path"))
    with_role = listing.withColumn("role", C.input_role(F.col("path")))
    readable = F.when(F.col("role") == "demand", ext.isin(*S.DEMAND_EXTENSIONS)).when(
        F.col("role") == "supply", ext.isin(*S.SUPPLY_EXTENSIONS)
    )
    return with_role.filter(readable)


def latest_per_role(candidates: DataFrame, by: Iterable[str] = ()) -> DataFrame:
    """Newest file of each role; of equally new ones the last path."""
    newest = F.max_by("path", F.struct("modificationTime", "path")).alias("path")
    return candidates.groupBy(*by, "role").agg(newest, F.max("modificationTime").alias("modificationTime"))
