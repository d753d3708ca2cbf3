"""Tabular inputs. CSV is read as text and coerced column by column, so a bad value is a null by intent."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regional_balance import schema as S
from regional_balance.functions import columns as C
from regional_balance.functions import names as N


def read_csv(spark: SparkSession, path: str, infer: bool = False) -> DataFrame:
    """All columns as text; ``infer`` types them in a second pass over the file, which ``first numeric column`` needs."""
    return spark.read.option("header", "true").option("inferSchema", str(infer).lower()).csv(path)


def demand_from_csv(table: DataFrame) -> DataFrame:
    """(region_id, demand_value) from columns of those names, ignoring case and blanks in the header."""
    region = N.find_by_name(table.columns, ["region_id"])
    value = N.find_by_name(table.columns, ["demand_value"])
    if region is None or value is None:
        raise ValueError(f"demand CSV needs region_id and demand_value: {table.columns}")
    return table.select(
        C.strip(N.quoted(region).cast("string")).alias("region_id"),
        C.filled(C.number(table, value).cast("double")).alias("demand_value"),
    )


def ranking_demand(table: DataFrame, activities: Iterable[str] = S.ACTIVITIES) -> DataFrame:
    """Wide demand for rankings: normalised region keys, blank ones dropped, missing values kept.

    Only activities named exactly are taken; absent ones are left out.
    """
    activities = list(activities)
    region = N.find_region_column(table.columns, S.RANKING_REGION_NAMES, activities)
    if region is None:
        raise ValueError(f"no region column in the demand table: {table.columns}")
    present = [a for a in activities if a in table.columns]
    if not present:
        raise ValueError(f"none of the activities is a column of the demand table: {table.columns}")
    keyed = table.select(
        C.merge_key(table, region).alias("Region"), *[C.number(table, a).cast("double").alias(a) for a in present]
    )
    return keyed.filter(F.col("Region") != "")


def read_demand(spark: SparkSession, path: str) -> DataFrame:
    """A demand CSV with region_id and demand_value. Workbook grids go through ``operators.layout``."""
    if not path.lower().endswith(".csv"):
        raise ValueError(f"unsupported demand file type: {path}")
    return demand_from_csv(read_csv(spark, path))


def read_supply(spark: SparkSession, path: str) -> DataFrame:
    """(region_id, supply_value) from a CSV, Parquet or GeoJSON supply file."""
    from regional_balance.operators.supply import supply_from_facilities, tabular_supply
    from regional_balance.sources.features import facility_features, read_features

    lower = path.lower()
    if lower.endswith((".geojson", ".json")):
        return supply_from_facilities(facility_features(read_features(spark, path)))
    if lower.endswith(".parquet"):
        return tabular_supply(spark.read.parquet(path))
    if lower.endswith(".csv"):
        return tabular_supply(read_csv(spark, path, infer=True))
    raise ValueError(f"unsupported supply file type: {path}")
