"""GeoJSON features as rows: (id, properties map, geometry)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regional_balance import schema as S
from regional_balance.functions import columns as C
from regional_balance.functions import geometry as G

_FEATURE = "type string, id string, properties map<string,string>, geometry struct<type:string,coordinates:string>"
_COLLECTION = f"type string, crs struct<properties:struct<name:string>>, features array<struct<{_FEATURE.replace(' ', ':').replace(',:', ',')}>>"


def _rows(parsed: DataFrame, srid: Column) -> DataFrame:
    geometry = F.col("f.geometry")
    return parsed.select(
        F.col("f.id").alias("id"),
        F.coalesce(F.col("f.properties"), F.create_map().cast("map<string,string>")).alias("properties"),
        G.from_geojson(geometry["type"], geometry["coordinates"], srid).alias("geometry"),
    )


def parse_feature_lines(lines: DataFrame, column: str = "value", srid: int = S.SRID_LONLAT) -> DataFrame:
    """One feature per text row."""
    parsed = lines.select(F.from_json(column, _FEATURE).alias("f")).filter(F.col("f.type") == "Feature")
    return _rows(parsed, F.lit(srid))


def rejected_lines(lines: DataFrame, column: str = "value", srid: int = S.SRID_LONLAT) -> DataFrame:
    """(the line, reason) for lines that ``parse_feature_lines`` drops or whose geometry it cannot give; blank ones aside."""
    parsed = lines.filter(F.trim(column) != "").select(column, F.from_json(column, _FEATURE).alias("_f"))
    geometry, kind = F.col("_f.geometry"), F.col("_f.geometry.type")
    reason = (
        F.when(~F.col("_f.type").eqNullSafe("Feature"), F.lit("not a feature"))
        .when(kind.isNull(), F.lit("no geometry"))
        .when(~F.lower(kind).isin(*G.KINDS), F.concat(F.lit("geometry not known: "), kind))
        .when(G.from_geojson(kind, geometry["coordinates"], F.lit(srid)).isNull(), F.lit("coordinates cannot be read"))
    )
    return parsed.select(column, reason.alias("reason")).filter(F.col("reason").isNotNull())


def read_features(spark: SparkSession, path: str, lines: bool | None = None, srid: int | None = None) -> DataFrame:
    """Features of a file or folder.

    ``lines=True``: one feature per line, split over tasks; the form to use for large layers. ``False``: whole
    feature collections, one document per task. None: lines, when the first record is a feature.
    """
    if lines is None:
        head = spark.read.text(path).filter(F.trim("value") != "").limit(1).select(F.get_json_object("value", "$.type").alias("t")).first()
        lines = head is not None and head["t"] == "Feature"
    if lines:
        return parse_feature_lines(spark.read.text(path), srid=srid or S.SRID_LONLAT)
    collections = spark.read.schema(_COLLECTION).option("multiLine", "true").json(path)
    named = F.regexp_extract(F.coalesce(F.col("crs.properties.name"), F.lit("")), r"EPSG:+(\d+)$", 1).try_cast("int")
    code = F.lit(srid) if srid is not None else F.coalesce(named, F.lit(S.SRID_LONLAT))
    return _rows(collections.select(code.alias("code"), F.explode("features").alias("f")), F.col("code"))


def facility_features(features: DataFrame, require_region: bool = True) -> DataFrame:
    """(facility_id, region_id, facility_type, capacity, geometry); a missing facility id is a content hash."""
    p = F.col("properties")

    def prop(name: str) -> Column:
        return F.try_element_at(p, F.lit(name))

    minted = F.concat(F.lit("fac_"), F.xxhash64(F.to_json(p), F.to_json("geometry")).cast("string"))
    region = prop("region_id")
    if require_region:
        gone = F.raise_error(F.lit("facility features need a region_id property, or a spatial join first"))
        region = F.when(F.map_contains_key(p, "region_id"), region).otherwise(gone.cast("string"))
    return features.select(
        F.coalesce(prop("facility_id"), minted).alias("facility_id"),
        region.alias("region_id"),
        F.coalesce(prop("facility_type"), F.lit("unknown")).alias("facility_type"),
        C.text_number(prop("capacity")).alias("capacity"),
        "geometry",
    )


def boundary_features(
    features: DataFrame,
    region_property: str = S.BOUNDARY_NAME_COLUMN,
    srid: int | None = S.SRID_WORKING,
    aliases: Mapping[str, str] = S.BOUNDARY_ALIASES,
    exclude: Iterable[str] = S.BOUNDARY_EXCLUSIONS,
) -> DataFrame:
    """(region_id, geometry) of region polygons: names normalised, excluded regions dropped, reprojected."""
    named = features.select(F.try_element_at("properties", F.lit(region_property)).alias("_name"), "geometry")
    return boundary_rows(named, "_name", srid, aliases, exclude)


def boundary_rows(
    table: DataFrame,
    name: str,
    srid: int | None = S.SRID_WORKING,
    aliases: Mapping[str, str] = S.BOUNDARY_ALIASES,
    exclude: Iterable[str] = S.BOUNDARY_EXCLUSIONS,
) -> DataFrame:
    """The same from a table with a name column. Rows without a name are dropped."""
    S.require(table, name, "geometry", what="boundaries")
    out = table.select(C.boundary_region_id(F.col(name), aliases).alias("region_id"), "geometry")
    out = out.filter(F.col("region_id").isNotNull() & ~F.col("region_id").isin(*exclude))
    return out if srid is None else out.withColumn("geometry", G.reproject(F.col("geometry"), srid))
