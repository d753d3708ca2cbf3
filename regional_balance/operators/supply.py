"""Supply: facilities, tabular files and constants reduced to supply per region (and activity)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regional_balance import schema as S
from regional_balance.functions import columns as C
from regional_balance.functions import names as N


def supply_from_facilities(
    facilities: DataFrame,
    use_capacity: bool = True,
    count_fallback: bool = False,
    by: Sequence[str] = (),
) -> DataFrame:
    """Capacity (or number of facilities) per region; a total that is not positive counts as missing.

    A region whose capacities are all missing sums to zero and so ends as missing supply;
    ``count_fallback`` uses its facility count instead.
    """
    S.require(facilities, "region_id", *by, what="facilities")
    rows = facilities.filter(F.col("region_id").isNotNull())
    region = F.col("region_id").cast("string").alias("region_id")
    with_capacity = use_capacity and "capacity" in facilities.columns
    facts = []
    if with_capacity:
        facts.append(F.sum(C.number(facilities, "capacity")).cast("double").alias("capacity_sum"))
    if count_fallback or not with_capacity:
        S.require(facilities, "facility_id", what="facilities")
        facts.append(F.count("facility_id").cast("double").alias("facility_count"))
    sums = rows.groupBy(*by, region).agg(*facts)
    if not with_capacity:
        value = F.col("facility_count")
    elif count_fallback:
        value = F.coalesce("capacity_sum", "facility_count")
    else:
        value = F.coalesce(F.col("capacity_sum"), F.lit(0.0))
    return sums.select(*by, "region_id", F.when(value > 0, value).alias("supply_value"))


def supply_constant(ids: DataFrame, value: float = 1.0, by: Sequence[str] = (), distinct: bool = False) -> DataFrame:
    """The same supply for every region id."""
    S.require(ids, "region_id", *by, what="region ids")
    regions = ids.select(*by, F.col("region_id").cast("string").alias("region_id"))
    if distinct:
        regions = regions.distinct()
    return regions.withColumn("supply_value", F.lit(float(value)))


def tabular_supply(table: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(region_id, supply_value) from a table with unknown column names.

    The supply column is a named one, else the first numeric column other than the region column.
    Duplicate regions are kept and a value that is not a number is missing.
    """
    table = N.strip_columns(table)
    region = _region_column(table)
    value = _total_supply_column(table, region)
    if value is None:
        raise ValueError(f"supply table has no numeric column for the supply value: {table.columns}")
    return table.select(
        *by,
        C.strip(N.quoted(region).cast("string")).alias("region_id"),
        C.number(table, value).cast("double").alias("supply_value"),
    )


def _region_column(table: DataFrame) -> str:
    return N.find_by_name(table.columns, S.SUPPLY_REGION_NAMES) or table.columns[0]


def _total_supply_column(table: DataFrame, region: str) -> str | None:
    named = N.find_by_name(table.columns, S.SUPPLY_VALUE_NAMES)
    return named or N.first_numeric_column(table, exclude=[region])


def _total(value: Column) -> Column:
    return F.coalesce(F.sum(value).cast("double"), F.lit(0.0))


def supply_keyed(
    supply: DataFrame,
    by: Sequence[str] = (),
    markers: Iterable[str] = S.SUMMARY_ROW_MARKERS,
) -> DataFrame:
    """Supply summed per normalised region key, without footer rows and blank keys."""
    S.require(supply, "region_id", "supply_value", *by, what="supply")
    return _keyed_rows(supply, "region_id", markers).groupBy(*by, "_key").agg(
        _total(C.number(supply, "supply_value")).alias("supply_value")
    )


def _keyed_rows(table: DataFrame, region: str, markers: Iterable[str]) -> DataFrame:
    rows = table.filter(~C.is_summary_row(N.quoted(region), markers))
    return rows.withColumn("_key", C.merge_key(table, region)).filter(F.col("_key") != "")


def activity_supply(
    table: DataFrame,
    activities: Iterable[str] = S.ACTIVITIES,
    by: Sequence[str] = (),
    markers: Iterable[str] = S.SUMMARY_ROW_MARKERS,
) -> DataFrame:
    """Supply per region key and activity, all activities in one scan: (by..., region_id, activity, supply_value).

    An activity takes the column named after it, else the table's total-supply column, else it is left out.
    Columns are summed per region first and the few result columns melted after, so one row per region
    crosses the shuffle however many activities there are.
    """
    table = N.strip_columns(table)
    region = _region_column(table)
    total = _total_supply_column(table, region)
    source = {}
    for label in activities:
        own = N.find_label_column(table.columns, label)
        column = own if own is not None and own != region else total
        if column is not None:
            source[label] = column
    rows = _keyed_rows(table, region, markers)
    if not source:
        empty = rows.select(*by, F.col("_key").alias("region_id"), F.lit("").alias("activity"), F.lit(0.0).alias("supply_value"))
        return empty.filter(F.lit(False))
    slot = {c: f"_sum_{i}" for i, c in enumerate(dict.fromkeys(source.values()))}
    sums = rows.groupBy(*by, "_key").agg(*[_total(C.number(table, c)).alias(s) for c, s in slot.items()])
    pairs = [F.struct(F.lit(a).alias("activity"), F.col(slot[c]).alias("supply_value")) for a, c in source.items()]
    return sums.select(*by, F.col("_key").alias("region_id"), F.inline(F.array(*pairs)))


def activity_supply_from_sheets(
    sheets: Sequence[DataFrame],
    activities: Iterable[str] = S.ACTIVITIES,
    markers: Iterable[str] = S.SUMMARY_ROW_MARKERS,
) -> DataFrame:
    """Per activity, the first sheet that yields any row. Sheets of fewer than two columns do not count.

    A sheet whose activity column yields nothing falls back to its total-supply column, as a later choice
    within the same sheet.
    """
    activities = list(activities)
    choices = []
    for i, sheet in enumerate(sheets):
        if len(sheet.columns) < 2:
            continue
        choices.append(activity_supply(sheet, activities, markers=markers).withColumn("sheet_idx", F.lit(i)))
    if not choices:
        raise ValueError("no sheet has a region and a supply column")
    every = reduce(DataFrame.unionByName, choices)
    first = every.groupBy("activity").agg(F.min("sheet_idx").alias("sheet_idx"))
    return every.join(first, ["activity", "sheet_idx"], "left_semi").select("region_id", "activity", "supply_value")
