"""Demand: wide or long activity tables, surveys and ready-made tables reduced to demand values."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regional_balance import schema as S
from regional_balance.functions import columns as C
from regional_balance.functions import names as N


def demand_long(wide: DataFrame, activities: Iterable[str] = S.ACTIVITIES, keep: Sequence[str] = ("region_id",)) -> DataFrame:
    """Wide activity table -> (keep..., activity, demand); missing or unreadable values count as zero."""
    S.require(wide, *keep, what="wide demand")
    found = N.activity_columns(wide, activities)
    values = [C.filled(C.number(wide, c).cast("double")).alias(label) for label, c in found.items()]
    if not values:
        return wide.select(*keep, F.lit("").alias("activity"), F.lit(0.0).alias("demand")).filter(F.lit(False))
    return wide.select(*keep, *values).unpivot(list(keep), list(found), "activity", "demand")


def _fold(value: Column, how: str) -> Column:
    total = F.coalesce(F.sum(value).cast("double"), F.lit(0.0))
    if how == "sum":
        return total
    if how == "mean":
        # Missing counts as zero, so the mean divides by all rows rather than by the filled ones.
        return F.try_divide(total, F.count(F.lit(1)))
    raise ValueError(f"how must be 'sum' or 'mean', not {how!r}")


def activity_demand(
    wide: DataFrame,
    activities: Iterable[str] = S.ACTIVITIES,
    how: str = "sum",
    by: Sequence[str] = (),
    markers: Iterable[str] = S.SUMMARY_ROW_MARKERS,
) -> DataFrame:
    """One demand value per activity over all regions of a wide table: (by..., activity, demand_value).

    The wide columns are folded in one partial+final aggregate and only the folded row is melted, so the
    shuffle carries one row per ``by`` group and task instead of one per region and activity.
    """
    S.require(wide, "region_id", *by, what="wide demand")
    found = N.activity_columns(wide, activities)
    if not found:
        empty = wide.select(*by, F.lit("").alias("activity"), F.lit(0.0).alias("demand_value"))
        return empty.filter(F.lit(False))
    rows = wide.filter(~C.is_summary_row(F.col("region_id"), markers))
    folded = rows.groupBy(*by).agg(*[_fold(C.number(wide, c), how).alias(label) for label, c in found.items()])
    return folded.unpivot(list(by), list(found), "activity", "demand_value")


def activity_demand_from_long(
    long: DataFrame,
    how: str = "sum",
    by: Sequence[str] = (),
    markers: Iterable[str] = S.SUMMARY_ROW_MARKERS,
) -> DataFrame:
    """The same aggregate from a long table (region_id, activity, demand)."""
    S.require(long, "region_id", "activity", "demand", *by, what="long demand")
    rows = long.filter(~C.is_summary_row(F.col("region_id"), markers))
    return rows.groupBy(*by, "activity").agg(_fold(C.number(long, "demand"), how).alias("demand_value"))


def scalar_demand(
    per_activity: DataFrame,
    activity: str | None = None,
    normalize: bool = False,
    by: Sequence[str] = (),
    known: Iterable[str] | None = None,
) -> DataFrame:
    """One demand value per ``by`` group: one activity, or all of them together.

    With ``normalize`` the value becomes its share of the all-activity total when that total is positive, so
    without an activity it is 1. ``known`` lists the activities of the table; an unknown one is an error.
    """
    value = F.col("demand_value")
    wanted = value
    if activity:
        name = activity.strip().lower()
        if known is not None and name not in {k.lower() for k in known}:
            raise ValueError(f"activity {activity!r} is not in the demand table: {sorted(known)}")
        wanted = F.when(F.lower("activity") == name, value)
    sums = per_activity.groupBy(*by).agg(
        F.coalesce(F.sum(wanted), F.lit(0.0)).alias("wanted"),
        F.coalesce(F.sum(value), F.lit(0.0)).alias("total"),
    )
    out = C.share_of_total(F.col("wanted"), F.col("total")) if normalize else F.col("wanted")
    return sums.select(*by, out.alias("demand_value"))


def spread_demand(regions: DataFrame, scalar: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The scalar demand on every region row: a scalar subquery, or an equi-join on ``by``."""
    S.require(regions, "region_id", *by, what="regions")
    ids = regions.select(*by, F.col("region_id").cast("string").alias("region_id"))
    if by:
        return ids.join(scalar, list(by), "left").withColumn("demand_value", C.filled(F.col("demand_value")))
    return ids.select("region_id", C.filled(scalar.select("demand_value").scalar()).alias("demand_value"))


def demand_from_survey(survey: DataFrame, use_rate: bool = True, by: Sequence[str] = ()) -> DataFrame:
    """Participation per region: participants / population, or raw participants without a population."""
    S.require(survey, "region_id", "participants", *by, what="survey")
    participants = C.number(survey, "participants")
    if use_rate and "population" in survey.columns:
        value = C.participation_rate(participants, C.number(survey, "population"))
    else:
        value = C.filled(C.finite(participants.cast("double")))
    return survey.select(*by, F.col("region_id").cast("string").alias("region_id"), value.alias("demand_value"))


def demand_from_table(table: DataFrame, value_column: str = "demand_value", by: Sequence[str] = ()) -> DataFrame:
    """A ready-made demand table cut down to the contract columns."""
    S.require(table, "region_id", value_column, *by, what="demand table")
    value = C.filled(C.number(table, value_column).cast("double"))
    return table.select(*by, F.col("region_id").cast("string").alias("region_id"), value.alias("demand_value"))


def demand_regions(wide: DataFrame, by: Sequence[str] = (), markers: Iterable[str] = S.SUMMARY_ROW_MARKERS) -> DataFrame:
    """Distinct region keys of a demand table, without footers and blank labels."""
    S.require(wide, "region_id", *by, what="wide demand")
    keys = wide.filter(~C.is_summary_row(F.col("region_id"), markers))
    keys = keys.select(*by, C.merge_key(wide, "region_id").alias("region_id"))
    return keys.filter(F.col("region_id") != "").distinct()
