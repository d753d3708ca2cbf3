"""Fixed values, parameters and column contracts shared by the whole engine."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# --- fixed values -------------------------------------------------------------------------
# Names and numbers that results depend on; all of them can be overridden by parameters.

ACTIVITIES = (
    "Park",
    "Swimming",
    "Biking",
    "Golfing",
    "Court Games",
    "Field Games",
    "Walking/Jogging",
    "Camping",
    "Fishing",
    "Boating",
    "Local Winter",
    "Downhill Skiing",
    "Snowmobiling",
)

CLASS_SUFFICIENT = "Supply Sufficient"
CLASS_BALANCED = "Balanced"
CLASS_NEEDS = "Needs Improvement"
CLASS_NO_SUPPLY = "Needs Improvement (No Supply)"

SUMMARY_ROW_MARKERS = ("grand total", "subtotal")

DEMAND_MARKERS = ("d8", "demand")
DEMAND_PREFIXES = ("m4",)
SUPPLY_MARKERS = ("s12", "supply", "facilit")
LOCK_PREFIX = "~$"
DEMAND_EXTENSIONS = (".xlsx", ".xls", ".csv")
SUPPLY_EXTENSIONS = (".xlsx", ".xls", ".csv", ".geojson", ".json", ".gpkg", ".shp")
TOP_LEVEL_EXTENSIONS = ("xlsx", "xls", "csv", "geojson", "gpkg", "shp")
MAX_LISTING_DEPTH = 4

SUPPLY_REGION_NAMES = ("region_id", "region", "county", "name_2", "origin", "county_name")
SUPPLY_VALUE_NAMES = ("supply_value", "supply", "capacity", "total_supply", "finalcap")
SHEET_REGION_NAMES = (
    "region_id",
    "region",
    "county",
    "county_name",
    "origin",
    "origin_name",
    "name_2",
    "name2",
    "geography",
    "geo_name",
)
RANKING_REGION_NAMES = ("region_id", "region", "county", "origin", "origin_name", "county_name")
PREFERRED_SHEETS = ("sheet1", "demand", "d8", "m4", "data")
FIXED_LAYOUT_TITLE_ROWS = 3
FIXED_LAYOUT_MIN_ROWS = 5
HEADER_SEARCH_ROWS = 15

BOUNDARY_NAME_COLUMN = "NAME_2"
BOUNDARY_ALIASES = {"SAINT LAWRENCE": "ST. LAWRENCE"}
BOUNDARY_EXCLUSIONS = ("", "LAKE ONTARIO", "NAN")

INDEX_MIN = 1.0
INDEX_MAX = 10.0
IMPROVEMENT_THRESHOLD = 1.0
CLASS_BINS = 5
FLAT_RANGE_WIDTH = 1e-12
NO_SCORE_SENTINEL = -1.0
DEFAULT_VINTAGE = "2025"

SRID_LONLAT = 4326
SRID_WORKING = 3857
EARTH_RADIUS = 6378137.0
# --- end of fixed values ------------------------------------------------------------------


@dataclass(frozen=True)
class ScoreParams:
    """Scale of the need score and the two class bands."""

    scale: float = 100.0
    low: float = 0.5
    high: float = 1.0


NEED_TABLE = T.StructType(
    [
        T.StructField("region_id", T.StringType()),
        T.StructField("demand_value", T.DoubleType()),
        T.StructField("supply_value", T.DoubleType()),
        T.StructField("need_score", T.DoubleType()),
        T.StructField("need_class", T.StringType()),
        T.StructField("priority_rank", T.LongType()),
    ]
)

ACTIVITY_METRICS = T.StructType(
    [
        T.StructField("region_id", T.StringType()),
        T.StructField("activity", T.StringType()),
        T.StructField("demand_value", T.DoubleType()),
        T.StructField("supply_value", T.DoubleType()),
        T.StructField("gap", T.DoubleType()),
        T.StructField("supply_demand_ratio", T.DoubleType()),
        T.StructField("need_score", T.DoubleType()),
    ]
)

POINT_TYPE = "struct<x:double,y:double>"
POLYGONS_TYPE = f"array<array<array<{POINT_TYPE}>>>"
GEOMETRY_TYPE = f"struct<srid:int,kind:string,polygons:{POLYGONS_TYPE}>"


def require(df: DataFrame, *names: str, what: str = "table") -> None:
    """Raise early, at plan-building time, when a needed column is absent."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"{what} lacks column(s) {missing}; it has {df.columns}")
