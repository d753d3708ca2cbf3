"""Spatial queries. Nation k is the unit cell (k % 5, k div 5) of a grid, so that SQL can test boxes."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regional_balance.functions import geometry as G
from regional_balance.operators import arrange as A
from regional_balance.operators import metrics as M
from regional_balance.operators import rings as Y
from regional_balance.operators import score as R
from regional_balance.operators import spatial as X
from regional_balance.operators import supply as U
from regional_balance.operators import validate as V
from regional_balance.plans.alignment import align_to_geography, score_aligned
from regional_balance.schema import SRID_LONLAT, SRID_WORKING, ScoreParams
from regional_balance.session import settle, shared_folder
from regional_balance.sinks import writers
from regional_balance.sources.features import boundary_features, boundary_rows, read_features, rejected_lines
from workload.registry import Tables, money, query, rounded, sql_need
from workload.scores import NEED_COLUMNS, SQL_NATION, nation_table, tidy

SQL_GRID = "g AS (SELECT n_name AS region_id, n_nationkey % 5 AS gx, n_nationkey // 5 AS gy, n_regionkey FROM nation)"


def grid(t: Tables, srid: int = SRID_WORKING) -> DataFrame:
    x = F.col("n_nationkey") % 5
    y = F.floor(F.col("n_nationkey") / 5)
    return t.nation.select(F.col("n_name").alias("region_id"), G.box(x, y, x + 1, y + 1, srid).alias("geometry"), "n_regionkey")


def line_points(t: Tables) -> DataFrame:
    """Line items as points; many lie on cell edges and some outside the grid."""
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        "l_quantity",
        G.point(F.col("l_quantity") / 9, F.col("l_discount") * 50, SRID_WORKING).alias("geometry"),
    )


SQL_POINTS = f"""WITH {SQL_GRID}, p AS (SELECT *, l_quantity / 9 AS x, l_discount * 50 AS y FROM lineitem)"""
INSIDE = "x BETWEEN gx AND gx + 1 AND y BETWEEN gy AND gy + 1"


@query(
    "spatial_assign",
    f"{SQL_POINTS} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, region_id FROM p LEFT JOIN g ON {INSIDE}",
)
def spatial_assign(spark, sf):
    """Left spatial join: points on shared edges match every neighbour, points outside match none."""
    t = Tables(spark, sf)
    joined = X.spatial_join(line_points(t), grid(t), cell_size=1.0)
    return joined.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "region_id")


@query(
    "spatial_supply",
    f"""{SQL_POINTS} SELECT region_id, SUM(l_quantity) AS supply_value FROM p JOIN g ON {INSIDE} GROUP BY 1""",
)
def spatial_supply(spark, sf):
    """Facilities without a region get it by location, then add up to supply; cell size from the layer."""
    t = Tables(spark, sf)
    facilities = line_points(t).withColumnsRenamed({"l_quantity": "capacity"})
    aligned = align_to_geography(t.nation, t.nation, facilities, grid(t))
    return U.supply_from_facilities(aligned.facilities)


@query(
    "spatial_assign_first",
    f"""WITH {SQL_GRID}, p AS (SELECT c_custkey, c_nationkey / 5.0 AS x, ROUND(c_acctbal / 2000) AS y FROM customer)
SELECT c_custkey, MIN(region_id) AS region_id FROM p JOIN g ON {INSIDE} GROUP BY 1""",
)
def spatial_assign_first(spark, sf):
    t = Tables(spark, sf)
    people = t.customer.select(
        F.col("c_custkey").alias("facility_id"),
        G.point(F.col("c_nationkey") / 5.0, F.round(F.col("c_acctbal") / 2000), SRID_WORKING).alias("geometry"),
    )
    return X.assign_regions(people, grid(t), "first").select(F.col("facility_id").alias("c_custkey"), "region_id")


SQL_PARCELS = f"""WITH {SQL_GRID}, p AS (SELECT c_custkey, (c_acctbal + 1000) / 2000 AS x, c_nationkey / 5.0 AS y FROM customer)"""


def parcels(t: Tables) -> DataFrame:
    x, y = (F.col("c_acctbal") + 1000) / 2000, F.col("c_nationkey") / 5.0
    return t.customer.select("c_custkey", G.box(x, y, x + 0.25, y + 0.25, SRID_WORKING).alias("geometry"))


@query(
    "spatial_join_polygons",
    f"""{SQL_PARCELS} SELECT c_custkey, region_id FROM p LEFT JOIN g ON x <= gx + 1 AND x + 0.25 >= gx AND y <= gy + 1 AND y + 0.25 >= gy""",
)
def spatial_join_polygons(spark, sf):
    t = Tables(spark, sf)
    return X.spatial_join(parcels(t), grid(t), source_id="c_custkey").select("c_custkey", "region_id")


@query(
    "spatial_assign_areas",
    f"""{SQL_PARCELS} SELECT c_custkey, region_id FROM p JOIN g ON x <= gx + 1 AND x + 0.25 >= gx AND y <= gy + 1 AND y + 0.25 >= gy""",
)
def spatial_assign_areas(spark, sf):
    """Facilities of two parts without ids: the first outside every region, the second over one or several."""
    t = Tables(spark, sf)
    far = G.box(*[F.lit(v) for v in (-9.0, -9.0, -8.0, -8.0)], SRID_WORKING)
    shapes = parcels(t).withColumn("geometry", G.joined_parts("multipolygon", far, F.col("geometry")))
    return align_to_geography(t.nation, t.nation, shapes, grid(t)).facilities.select("c_custkey", "region_id")


@query(
    "spatial_assign_lines",
    f"""{SQL_PARCELS} SELECT c_custkey, region_id FROM p JOIN g ON x <= gx + 1 AND x + 1.5 >= gx AND y BETWEEN gy AND gy + 1""",
)
def spatial_assign_lines(spark, sf):
    """Trails along a row of regions: each belongs to all regions that it touches."""
    t = Tables(spark, sf)
    x, y = (F.col("c_acctbal") + 1000) / 2000, F.col("c_nationkey") / 5.0
    ends = [F.struct(v.alias("x"), y.alias("y")) for v in (x, x + 1.5)]
    trails = t.customer.select("c_custkey", G.line(*ends, srid=SRID_WORKING).alias("geometry"))
    return align_to_geography(t.nation, t.nation, trails, grid(t)).facilities.select("c_custkey", "region_id")


@query(
    "features_rejected",
    """SELECT reason, COUNT(*) AS n FROM (SELECT CASE c_nationkey % 5 WHEN 0 THEN 'geometry not known: GeometryCollection' WHEN 1 THEN 'not a feature'
WHEN 2 THEN 'no geometry' END AS reason FROM customer) WHERE reason IS NOT NULL GROUP BY 1""",
)
def features_rejected(spark, sf):
    """Lines of GeoJSON that give no geometry, by reason; points and lines are read."""
    kinds = F.array(*[F.lit(k) for k in ("GeometryCollection", "", "", "Point", "LineString")])
    coordinates = F.array(*[F.lit(k) for k in ("[]", "[]", "[]", "[1,2]", "[[1,2],[3,4]]")])
    n = (F.col("c_nationkey") % 5).cast("int")
    shape = F.format_string('{"type":"%s","coordinates":%s}', kinds[n], coordinates[n])
    shape = F.when(n == 2, F.lit("null")).otherwise(shape)
    kind = F.when(n == 1, F.lit("Topology")).otherwise(F.lit("Feature"))
    text = F.format_string('{"type":"%s","id":"%d","properties":{},"geometry":%s}', kind, F.col("c_custkey"), shape)
    return rejected_lines(Tables(spark, sf).customer.select(text.alias("value"))).groupBy("reason").agg(F.count("*").alias("n"))


@query(
    "spatial_join_right",
    f"""WITH {SQL_GRID}, p AS (SELECT s_suppkey, s_acctbal / 2500 AS x, s_nationkey / 5.0 AS y FROM supplier)
SELECT region_id, COUNT(s_suppkey) AS facilities FROM g LEFT JOIN p ON {INSIDE} GROUP BY 1""",
)
def spatial_join_right(spark, sf):
    """Every region is kept, also one without a facility."""
    t = Tables(spark, sf)
    s = t.supplier.select("s_suppkey", G.point(F.col("s_acctbal") / 2500, F.col("s_nationkey") / 5.0, SRID_WORKING).alias("geometry"))
    joined = X.spatial_join(s, grid(t), how="right")
    return joined.groupBy("region_id").agg(F.count("s_suppkey").alias("facilities"))


@query(
    "reproject_points",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, ROUND(RADIANS(l_quantity * 3) * 6378137.0, 3) AS x,
ROUND(LN(TAN(0.7853981633974483 + RADIANS(l_discount * 800) / 2)) * 6378137.0, 3) AS y, ROUND(l_quantity * 3, 6) AS lon, ROUND(l_discount * 800, 6) AS lat FROM lineitem""",
)
def reproject_points(spark, sf):
    """To the working CRS and back."""
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    rows = Tables(spark, sf).lineitem.select(*keys, G.point(F.col("l_quantity") * 3, F.col("l_discount") * 800).alias("geometry"))
    there = X.to_crs(rows).withColumn("back", G.reproject(F.col("geometry"), SRID_LONLAT))
    g, b = F.col("geometry"), F.col("back")
    # Adding zero turns the -0.0 that a rounded tiny latitude leaves into 0.0.
    return there.select(
        *keys,
        (F.round(G.point_x(g), 3) + 0.0).alias("x"),
        (F.round(G.point_y(g), 3) + 0.0).alias("y"),
        (F.round(G.point_x(b), 6) + 0.0).alias("lon"),
        (F.round(G.point_y(b), 6) + 0.0).alias("lat"),
    )


@query(
    "region_area",
    """WITH c AS (SELECT c_mktsegment, c_acctbal / 100 AS lon, CAST(c_nationkey AS DOUBLE) AS lat FROM customer),
a AS (SELECT c_mktsegment, (RADIANS(lon + 0.5) * 6378137.0 - RADIANS(lon) * 6378137.0) *
(LN(TAN(0.7853981633974483 + RADIANS(lat + 0.5) / 2)) * 6378137.0 - LN(TAN(0.7853981633974483 + RADIANS(lat) / 2)) * 6378137.0) AS area FROM c)
SELECT c_mktsegment, ROUND(SUM(area) / 1000000, 2) AS square_km FROM a GROUP BY 1""",
)
def region_area(spark, sf):
    """Half-degree parcels of customers, measured in the working CRS."""
    lon, lat = F.col("c_acctbal") / 100, F.col("c_nationkey").cast("double")
    boxes = Tables(spark, sf).customer.select("c_mktsegment", G.box(lon, lat, lon + 0.5, lat + 0.5).alias("geometry"))
    total = X.total_area(X.to_crs(boxes), by=["c_mktsegment"])
    return total.select("c_mktsegment", F.round(F.col("area") / 1000000, 2).alias("square_km"))


def strip_parcels(t: Tables) -> DataFrame:
    """Customer k owns the unit square at x = k: neighbours of one nation share an edge."""
    k = F.col("c_custkey")
    rows = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return rows.select(F.col("n_name").alias("region_id"), "c_custkey", "c_mktsegment", G.box(k, F.lit(0), k + 1, F.lit(1), SRID_WORKING).alias("geometry"))


@query(
    "dissolve_outline",
    """WITH v AS (SELECT c_nationkey AS n, c_custkey AS x FROM customer UNION ALL SELECT c_nationkey, c_custkey + 1 FROM customer),
o AS (SELECT n, x, COUNT(*) AS c FROM v GROUP BY ALL), e AS (SELECT n, COUNT(*) AS sides FROM o WHERE c = 1 GROUP BY 1),
p AS (SELECT c_nationkey AS n, COUNT(*) AS parts FROM customer GROUP BY 1)
SELECT n_name AS region_id, 2 * parts + sides AS edges, CAST(2 * parts + sides AS DOUBLE) AS perimeter
FROM p JOIN e USING (n) JOIN nation ON n = n_nationkey""",
)
def dissolve_outline(spark, sf):
    lines = X.dissolve_outline(strip_parcels(Tables(spark, sf)), "region_id")
    length = F.sqrt(F.pow(F.col("x2") - F.col("x1"), 2) + F.pow(F.col("y2") - F.col("y1"), 2))
    return lines.groupBy("region_id").agg(F.count("*").alias("edges"), F.sum(length).alias("perimeter"))


@query(
    "dissolve_attributes",
    """SELECT n_name AS region_id, arg_min(c_mktsegment, c_custkey) AS c_mktsegment, COUNT(*) AS parts, CAST(COUNT(*) AS DOUBLE) AS area,
CAST(MIN(c_custkey) AS DOUBLE) AS x1, CAST(MAX(c_custkey) + 1 AS DOUBLE) AS x2 FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1""",
)
def dissolve_attributes(spark, sf):
    whole = X.dissolve_attributes(strip_parcels(Tables(spark, sf)), "region_id", ["c_custkey"], ["c_mktsegment"])
    return whole.select("region_id", "c_mktsegment", "parts", "area", "bbox.x1", "bbox.x2")


@query(
    "overlapping_parts",
    "SELECT a.c_custkey AS c_custkey, a.c_custkey + 1 AS other FROM customer a JOIN customer b ON b.c_custkey = a.c_custkey + 1",
)
def overlapping_parts(spark, sf):
    return X.overlapping_parts(strip_parcels(Tables(spark, sf)), "c_custkey")


def rough_shapes(t: Tables) -> DataFrame:
    """Rectangles from account balance and nation number: some open, some flat, some turned, some missing."""
    a, n = F.col("c_acctbal"), F.col("c_nationkey").cast("double")
    zero = F.lit(0.0)

    def vertex(x, y):
        return F.struct(x.alias("x"), y.alias("y"))

    open_ring = F.array(vertex(zero, zero), vertex(a, zero), vertex(a, n), vertex(zero, n))
    ring = F.when(F.col("c_mktsegment") == "BUILDING", open_ring).otherwise(F.concat(open_ring, F.array(vertex(zero, zero))))
    shape = F.when(F.col("c_mktsegment") != "MACHINERY", G.polygon(ring, srid=SRID_WORKING))
    return t.customer.select("c_mktsegment", "c_custkey", shape.alias("geometry"))


@query(
    "geometry_audit",
    """SELECT c_mktsegment, CASE WHEN c_mktsegment = 'MACHINERY' THEN 'no geometry' WHEN c_mktsegment = 'BUILDING' AND c_nationkey <> 0 THEN 'unclosed ring'
WHEN c_acctbal * c_nationkey = 0 THEN 'zero area' ELSE 'ok' END AS problem, COUNT(*) AS n FROM customer GROUP BY 1, 2""",
)
def geometry_audit(spark, sf):
    return X.audit_geometry(rough_shapes(Tables(spark, sf)), by=["c_mktsegment"])


@query(
    "geometry_repair",
    """SELECT c_custkey, ROUND(ABS(c_acctbal * c_nationkey), 4) AS area FROM customer WHERE c_mktsegment <> 'MACHINERY' AND c_acctbal * c_nationkey <> 0""",
)
def geometry_repair(spark, sf):
    fixed = X.repair_geometry(rough_shapes(Tables(spark, sf)))
    return fixed.select("c_custkey", F.round(G.area(F.col("geometry")), 4).alias("area"))


@query(
    "boundary_regions",
    """SELECT CASE c_mktsegment WHEN 'BUILDING' THEN 'ST. LAWRENCE' ELSE UPPER(c_name) END AS region_id,
ROUND(RADIANS(c_acctbal / 100) * 6378137.0, 3) AS x1 FROM customer WHERE c_mktsegment NOT IN ('MACHINERY', 'FURNITURE')""",
)
def boundary_regions(spark, sf):
    """Boundary names normalised, an alias applied, excluded areas dropped, geometry reprojected."""
    seg = F.col("c_mktsegment")
    name = F.when(seg == "BUILDING", "Saint Lawrence ").when(seg == "MACHINERY", " Lake Ontario").when(seg == "FURNITURE", "nan").otherwise(F.col("c_name"))
    lon, lat = F.col("c_acctbal") / 100, F.col("c_nationkey").cast("double")
    raw = Tables(spark, sf).customer.select(name.alias("NAME_2"), G.box(lon, lat, lon + 1, lat + 1).alias("geometry"))
    out = boundary_rows(V.clean_boundaries(raw, "name_2").valid.withColumnRenamed("region_id", "label"), "label")
    return out.select("region_id", F.round(G.bbox(F.col("geometry"))["x1"], 3).alias("x1"))


@query(
    "layer_join_raw",
    f"{SQL_NATION}, {SQL_GRID} SELECT {NEED_COLUMNS}, CAST(gx AS DOUBLE) AS x1 FROM n LEFT JOIN g USING (region_id)",
)
def layer_join_raw(spark, sf):
    t = Tables(spark, sf)
    layer = R.attach_geometry(nation_table(t), grid(t))
    return tidy(layer).select("*", G.bbox(F.col("geometry"))["x1"].alias("x1")).drop("geometry")


@query(
    "layer_join_normalised",
    f"""WITH {SQL_GRID}, s AS (SELECT n_name, arg_max(o_totalprice, o_orderkey) AS score FROM orders JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey WHERE c_mktsegment <> 'BUILDING' GROUP BY 1)
SELECT lower(region_id) AS region_id, CAST(gy AS DOUBLE) AS y1, score AS activity_need_score FROM g LEFT JOIN s ON region_id = n_name""",
)
def layer_join_normalised(spark, sf):
    """Labels that differ in case meet; the last of repeated scores is taken; old score columns go."""
    t = Tables(spark, sf)
    layer = grid(t).select(F.lower("region_id").alias("region_id"), "geometry", F.lit(1.0).alias("need_score"))
    rows = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    rows = rows.filter(F.col("c_mktsegment") != "BUILDING")
    scores = rows.select(
        F.concat(F.lit(" "), "n_name").alias("Region"), F.col("o_totalprice").alias("ActivityNeedScore"), "o_orderkey"
    )
    joined = M.layer_join(layer, scores, order=["o_orderkey"])
    return joined.select("region_id", G.bbox(F.col("geometry"))["y1"].alias("y1"), "activity_need_score")


@query(
    "aligned_scores",
    f"""WITH {SQL_GRID}, p AS (SELECT s_acctbal / 2500 AS x, s_nationkey / 5.0 AS y, s_acctbal FROM supplier),
s0 AS (SELECT region_id, CAST(SUM(CAST(s_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS v FROM p JOIN g ON {INSIDE} GROUP BY 1),
s AS (SELECT region_id, CASE WHEN v > 0 THEN v END AS supply_value FROM s0),
d AS (SELECT n_name AS region_id, CAST(COUNT(*) FILTER (WHERE c_acctbal > 5000) AS DOUBLE) / COUNT(*) AS demand_value
      FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1),
j AS (SELECT region_id, COALESCE(demand_value, 0.0) AS demand_value, supply_value FROM d FULL JOIN s USING (region_id)),
{sql_need(100000.0, 0.5, 1.0)} SELECT region_id, ROUND(demand_value, 9) AS demand_value, ROUND(supply_value, 2) AS supply_value,
ROUND(need_score, 6) AS need_score, need_class, CAST(priority_rank AS DOUBLE) AS priority_rank, CAST(gx AS DOUBLE) AS x1 FROM n LEFT JOIN g USING (region_id)""",
)
def aligned_scores(spark, sf):
    """Survey participation against facilities placed by location, on the region layer."""
    t = Tables(spark, sf)
    people = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).groupBy(F.col("n_name").alias("region_id"))
    survey = people.agg(F.count("*").alias("population"), F.count_if(F.col("c_acctbal") > 5000).alias("participants"))
    where = G.point(F.col("s_acctbal") / 2500, F.col("s_nationkey") / 5.0, SRID_WORKING).alias("geometry")
    facilities = t.supplier.select(F.col("s_name").alias("facility_id"), money("s_acctbal").alias("capacity"), where)
    aligned = align_to_geography(V.clean_survey(survey).valid, t.nation, facilities, grid(t), cell_size=1.0)
    _, layer = score_aligned(aligned, params=ScoreParams(scale=100000.0))
    out = layer.withColumn("x1", G.bbox(F.col("geometry"))["x1"]).drop("geometry")
    out = out.withColumn("priority_rank", F.col("priority_rank").cast("double"))
    return rounded(out, demand_value=9, supply_value=2, need_score=6)


INTERSECTS = "x <= gx + 1 AND x + w >= gx AND y <= gy + 1 AND y + h >= gy"
INTERIORS = "x < gx + 1 AND x + w > gx AND y < gy + 1 AND y + h > gy"
WITHIN = "x >= gx AND x + w <= gx + 1 AND y >= gy AND y + h <= gy + 1"
CONTAINS = "x <= gx AND x + w >= gx + 1 AND y <= gy AND y + h >= gy + 1"
SQL_SIZED = f"""WITH {SQL_GRID}, p AS (SELECT c_custkey, (c_acctbal + 1000) / 2000 AS x, c_nationkey / 5.0 AS y, 0.25 AS w, 0.25 AS h FROM customer),
b AS (SELECT s_suppkey, s_acctbal / 5000 AS x, (s_nationkey % 5) * 1.0 AS y, 2.5 AS w, 2.0 AS h FROM supplier)"""


def estates(t: Tables) -> DataFrame:
    """Boxes larger than a region; their lower and upper sides lie on region borders."""
    x, y = F.col("s_acctbal") / 5000, (F.col("s_nationkey") % 5) * 1.0
    return t.supplier.select("s_suppkey", G.box(x, y, x + 2.5, y + 2.0, SRID_WORKING).alias("geometry"))


@query("spatial_within", f"{SQL_SIZED} SELECT c_custkey, region_id, CAST(n_regionkey AS BIGINT) AS n_regionkey FROM p JOIN g ON {WITHIN}")
def spatial_within(spark, sf):
    """Parcels inside one region, with a column of the region."""
    t = Tables(spark, sf)
    joined = X.spatial_join(parcels(t), grid(t), how="inner", predicate="within", attributes=["n_regionkey"])
    return joined.select("c_custkey", "region_id", F.col("n_regionkey").cast("long").alias("n_regionkey"))


@query("spatial_touches", f"{SQL_SIZED} SELECT c_custkey, region_id FROM p JOIN g ON {INTERSECTS} AND NOT ({INTERIORS})")
def spatial_touches(spark, sf):
    t = Tables(spark, sf)
    return X.spatial_join(parcels(t), grid(t), how="inner", predicate="touches").select("c_custkey", "region_id")


@query("spatial_overlaps", f"{SQL_SIZED} SELECT c_custkey, region_id FROM p JOIN g ON {INTERIORS} AND NOT ({WITHIN}) AND NOT ({CONTAINS})")
def spatial_overlaps(spark, sf):
    t = Tables(spark, sf)
    return X.spatial_join(parcels(t), grid(t), how="inner", predicate="overlaps").select("c_custkey", "region_id")


@query("spatial_contains", f"{SQL_SIZED} SELECT s_suppkey, region_id FROM b JOIN g ON {CONTAINS}")
def spatial_contains(spark, sf):
    t = Tables(spark, sf)
    return X.spatial_join(estates(t), grid(t), how="inner", predicate="contains").select("s_suppkey", "region_id")


@query(
    "spatial_crosses",
    f"""{SQL_PARCELS} SELECT c_custkey, region_id FROM p JOIN g ON x < gx + 1 AND x + 1.5 > gx AND y > gy AND y < gy + 1""",
)
def spatial_crosses(spark, sf):
    """Trails longer than a region, partly inside it."""
    t = Tables(spark, sf)
    x, y = (F.col("c_acctbal") + 1000) / 2000, F.col("c_nationkey") / 5.0
    ends = [F.struct(v.alias("x"), y.alias("y")) for v in (x, x + 1.5)]
    trails = t.customer.select("c_custkey", G.line(*ends, srid=SRID_WORKING).alias("geometry"))
    return X.spatial_join(trails, grid(t), how="inner", predicate="crosses").select("c_custkey", "region_id")


@query(
    "spatial_points_within",
    f"{SQL_POINTS} SELECT region_id, COUNT(*) AS points FROM p JOIN g ON x > gx AND x < gx + 1 AND y > gy AND y < gy + 1 GROUP BY 1",
)
def spatial_points_within(spark, sf):
    """Points on a border are within no region."""
    t = Tables(spark, sf)
    return X.spatial_join(line_points(t), grid(t), how="inner", predicate="within").groupBy("region_id").agg(F.count("*").alias("points"))


SQL_STRIPS = """p AS (SELECT n_regionkey, c_custkey * 0.7 AS a, c_custkey * 0.7 + 1 AS b FROM customer JOIN nation ON c_nationkey = n_nationkey)"""


@query(
    "union_area",
    f"""WITH {SQL_STRIPS}, m AS (SELECT *, MAX(b) OVER (PARTITION BY n_regionkey ORDER BY a ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reached FROM p)
SELECT n_regionkey, ROUND(CAST(SUM(2 * (b - GREATEST(a, LEAST(COALESCE(reached, a), b)))) AS DOUBLE), 6) AS area FROM m GROUP BY 1""",
)
def union_area(spark, sf):
    """Parcels two units high that overlap their neighbours of the same region: shared ground counts once."""
    t = Tables(spark, sf)
    x = F.col("c_custkey") * 0.7
    rows = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    rows = rows.select("n_regionkey", G.box(x, F.lit(0.0), x + 1, F.lit(2.0), SRID_WORKING).alias("geometry"))
    return A.union_area(rows, by=["n_regionkey"]).withColumn("area", F.round("area", 6))


@query(
    "parts_sharing_ground",
    "SELECT a.c_custkey AS c_custkey, a.c_custkey + 1 AS other FROM customer a JOIN customer b ON b.c_custkey = a.c_custkey + 1",
)
def parts_sharing_ground(spark, sf):
    """Parcels one and a half units wide, two apart only touch: pairs with interiors in common."""
    k = F.col("c_custkey")
    parts = Tables(spark, sf).customer.select("c_custkey", G.box(k, k % 2 * 0.5, k + F.when(k % 2 == 0, 2.0).otherwise(1.5), F.lit(1.0), SRID_WORKING).alias("geometry"))
    return X.overlapping_parts(parts, "c_custkey", touching=False)


@query(
    "dissolve_write_join",
    """SELECT o_orderkey, n_name AS region_id FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
WHERE o_orderdate >= DATE '1998-01-01'""",
)
def dissolve_write_join(spark, sf):
    """Parcels dissolved to one layer, written as GeoJSON, read again, and facilities joined to it by place."""
    t = Tables(spark, sf)
    whole = Y.dissolve(strip_parcels(t), "region_id", ["c_custkey"], ["c_mktsegment"])
    path = writers.write_features(whole, f"{shared_folder(spark)}/dissolved-{uuid.uuid4()}.geojson")
    # The join reads its regions several times: one value for each, which is long text to read.
    layer = settle(boundary_features(read_features(spark, path), "region_id"))
    orders = t.orders.filter(F.col("o_orderdate") >= F.lit("1998-01-01").cast("date"))
    places = orders.select("o_orderkey", G.point(F.col("o_custkey") + 0.5, F.lit(0.5), SRID_WORKING).alias("geometry"))
    return X.spatial_join(places, layer, how="inner").select("o_orderkey", "region_id")


@query(
    "outline_problems",
    """SELECT c_mktsegment, CASE c_nationkey % 5 WHEN 0 THEN 'self-intersection' WHEN 1 THEN 'spike' WHEN 2 THEN 'touching ring' WHEN 3 THEN 'overlapping edges' ELSE 'ok' END AS problem,
COUNT(*) AS n FROM customer GROUP BY 1, 2""",
)
def outline_problems(spark, sf):
    """Bow-ties, spikes, rings that come back to a point and holes along the outline, one size for each customer."""
    s = 1 + F.col("c_custkey") % 97

    def ring(*spots):
        return F.array(*[F.struct((x * s).cast("double").alias("x"), (y * s).cast("double").alias("y")) for x, y in spots])

    box = ((0, 0), (4, 0), (4, 4), (0, 4), (0, 0))
    bow = ring((0, 0), (4, 4), (4, 0), (0, 4), (0, 0))
    spike = ring((0, 0), (4, 0), (4, 4), (7, 4), (4, 4), (0, 4), (0, 0))
    touching = ring((0, 0), (2, 2), (4, 0), (4, 4), (2, 2), (0, 4), (0, 0))
    hole = ring((0, 1), (1, 1), (1, 2), (0, 2), (0, 1))
    kind = F.col("c_nationkey") % 5
    shape = F.when(kind == 0, F.array(bow)).when(kind == 1, F.array(spike)).when(kind == 2, F.array(touching))
    shape = shape.when(kind == 3, F.array(ring(*box), hole)).otherwise(F.array(ring(*box)))
    value = F.struct(F.lit(SRID_WORKING).alias("srid"), F.lit("polygon").alias("kind"), F.array(shape).alias("polygons"))
    rows = Tables(spark, sf).customer.select("c_mktsegment", value.alias("geometry"))
    return X.audit_geometry(rows, by=["c_mktsegment"])
