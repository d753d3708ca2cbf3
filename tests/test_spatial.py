import math
import random

import pytest
from pyspark.sql import functions as F

from regional_balance.functions import geometry as G
from regional_balance.operators import spatial as X
from regional_balance.operators import supply as U
from regional_balance.plans.alignment import align_to_geography, score_aligned
from regional_balance.schema import GEOMETRY_TYPE

W = 3857


def geom(rings, kind="polygon", srid=W):
    return (srid, kind, [[[(float(x), float(y)) for x, y in r] for r in rings]])


def point(x, y, srid=W):
    return geom([[(x, y)]], "point", srid)


def square(x, y, s=1.0):
    return [(x, y), (x + s, y), (x + s, y + s), (x, y + s), (x, y)]


def layer(spark, rows, ident="region_id string"):
    return spark.createDataFrame(rows, f"{ident}, geometry {GEOMETRY_TYPE}")


def pairs(df, *names):
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=str)


def inside(polygon_rings, x, y):
    """Reference test in plain arithmetic: closed polygon, holes by parity."""
    odd = False
    for ring in polygon_rings:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
            cross = (x2 - x1) * (y - y1) - (x - x1) * (y2 - y1)
            if cross == 0 and min(x1, x2) <= x <= max(x1, x2) and min(y1, y2) <= y <= max(y1, y2):
                return True
            if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
                odd = not odd
    return odd


def test_points_in_polygons_equal_brute_force(spark):
    rnd = random.Random(7)
    shapes = []
    for k in range(12):
        cx, cy, size = rnd.randrange(0, 12), rnd.randrange(0, 12), rnd.choice([0.5, 1, 3, 9])
        n = rnd.randrange(5, 10)
        ring = [
            (round(cx + size * rnd.uniform(0.3, 1) * math.cos(2 * math.pi * i / n), 2), round(cy + size * rnd.uniform(0.3, 1) * math.sin(2 * math.pi * i / n), 2))
            for i in range(n)
        ]
        shapes.append((f"p{k}", [ring + ring[:1]]))
    shapes.append(("hole", [square(0, 0, 10), square(2, 2, 3)]))
    shapes += [("left", [square(20, 0)]), ("right", [square(21, 0)])]
    points = [(i, round(rnd.uniform(-3, 15), 1), round(rnd.uniform(-3, 15), 1)) for i in range(300)]
    points += [(1000, 21.0, 0.5), (1001, 21.0, 1.0), (1002, 2.0, 3.0), (1003, 3.5, 3.5), (1004, 99.0, 99.0)]
    want = {(i, name) for i, x, y in points for name, rings in shapes if inside(rings, x, y)}
    src = layer(spark, [(i, point(x, y)) for i, x, y in points], "pid int")
    tgt = layer(spark, [(n, geom(r)) for n, r in shapes])
    for size in (None, 0.7, 5.0):
        got = pairs(X.spatial_join(src, tgt, how="inner", cell_size=size), "pid", "region_id")
        assert len(got) == len(want) and set(got) == want
    left = pairs(X.spatial_join(src, tgt), "pid", "region_id")
    alone = {i for i, _, _ in points} - {i for i, _ in want}
    assert sorted(left, key=str) == sorted(list(want) + [(i, None) for i in alone], key=str)
    right = pairs(X.spatial_join(src, tgt, how="right"), "pid", "region_id")
    empty = {n for n, _ in shapes} - {n for _, n in want}
    assert set(right) == want | {(None, n) for n in empty}


def test_polygons_meeting(spark):
    tgt = layer(spark, [("big", geom([square(0, 0, 10)])), ("touch", geom([square(10, 0, 1)])), ("far", geom([square(50, 50)])), ("hole", geom([square(100, 0, 10), square(101, 1, 8)]))])
    src = layer(
        spark,
        [
            (1, geom([square(4, 4)])),
            (2, geom([square(9.5, 0.5)])),
            (3, geom([square(-5, -5, 30)])),
            (4, geom([square(104, 4)])),
            (5, geom([square(200, 200)])),
            (6, geom([square(11, 1)])),
        ],
        "sid int",
    )
    want = {(1, "big"), (2, "big"), (2, "touch"), (3, "big"), (3, "touch"), (6, "touch")}
    for size in (None, 0.9, 7.0):
        assert set(pairs(X.spatial_join(src, tgt, how="inner", source_id="sid", cell_size=size), "sid", "region_id")) == want
        assert len(pairs(X.spatial_join(src, tgt, how="inner", source_id="sid", cell_size=size), "sid", "region_id")) == len(want)
    left = pairs(X.spatial_join(src, tgt, source_id="sid"), "sid", "region_id")
    assert set(left) == want | {(4, None), (5, None)}
    right = pairs(X.spatial_join(src, tgt, how="right", source_id="sid"), "sid", "region_id")
    assert set(right) == want | {(None, "far"), (None, "hole")}


def test_join_plan_is_an_equi_join(spark, plan):
    src, tgt = layer(spark, [(1, point(0, 0))], "pid int"), layer(spark, [("a", geom([square(0, 0)]))])
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        small = plan(X.spatial_join(src, tgt))
        large = plan(X.spatial_join(src, tgt, broadcast_bytes=0))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "BroadcastHashJoin" in small and "SortMergeJoin" not in small
    assert "SortMergeJoin" in large
    for text in (small, large):
        assert "NestedLoop" not in text and "Cartesian" not in text and "Python" not in text


def test_size_bound_of_cells(spark):
    tgt = layer(spark, [("a", geom([square(0, 0, 10)])), ("b", geom([square(0, 0)]))])
    for grid in (X.Grid(), X.Grid(2.0)):
        stored = X.region_cells(tgt, grid, "region_id").agg(F.sum(F.size("_te") * 48 + 200)).first()[0]
        levels, bound = X.layer_profile(tgt, grid)
        assert stored <= bound < 100 * stored
        assert levels == ([0, 2] if grid.side is None else [0])


def test_cells_inside_a_region_need_no_edges(spark):
    tgt = layer(spark, [("a", geom([square(0.5, 0.5, 10)]))])
    cells = {(r._cx, r._cy): r._inside for r in X.region_cells(tgt, X.Grid(1.0), "region_id").collect()}
    assert len(cells) == 121 and sum(v is True for v in cells.values()) == 81
    hollow = layer(spark, [("h", geom([square(0.5, 0.5, 10), square(2.5, 2.5, 6)]))])
    cells = {(r._cx, r._cy) for r in X.region_cells(hollow, X.Grid(1.0), "region_id").collect()}
    assert (5, 5) not in cells and (1, 1) in cells


def test_grid_bound_for_uneven_layers(spark):
    """Tiny regions crowded together next to giants: few cells per region, and few regions per cell."""
    rows = [(f"giant{i}", geom([square(1000 * i, 5, 900)])) for i in range(3)]
    rows += [(f"s{i}", geom([square(i % 20, i // 20, 0.9)])) for i in range(200)]
    cells = X.region_cells(layer(spark, rows), X.Grid(), "region_id")
    assert cells.count() <= 4 * len(rows)
    crowd = cells.groupBy("_town", "_cx", "_cy").count().agg(F.max("count")).first()[0]
    assert crowd <= 4


def test_join_options_are_checked(spark):
    src, tgt = layer(spark, [(1, point(0, 0))], "pid int"), layer(spark, [("a", geom([square(0, 0)]))])
    with pytest.raises(ValueError):
        X.spatial_join(src, tgt, how="full")
    with pytest.raises(ValueError):
        X.spatial_join(src.drop("geometry"), tgt)


def test_reprojection(spark):
    src = layer(spark, [(1, point(180.0, 0.0, 4326)), (2, point(-73.75, 42.65, 4326)), (3, None)], "pid int")
    there = {r.pid: r.geometry for r in X.to_crs(src).collect()}
    assert there[1].polygons[0][0][0].x == pytest.approx(20037508.342789244)
    assert there[1].polygons[0][0][0].y == pytest.approx(0, abs=1e-6)
    assert there[2].polygons[0][0][0].y == pytest.approx(math.log(math.tan(math.pi / 4 + math.radians(42.65) / 2)) * 6378137.0)
    assert there[3] is None and there[1].srid == W
    back = {r.pid: r.geometry for r in X.to_crs(X.to_crs(src), 4326).collect()}
    assert back[2].polygons[0][0][0].x == pytest.approx(-73.75) and back[2].polygons[0][0][0].y == pytest.approx(42.65)
    assert X.to_crs(src, 4326).collect() == src.collect()
    with pytest.raises(Exception, match="CRS"):
        X.to_crs(layer(spark, [(1, (None, "point", [[[(0.0, 0.0)]]]))], "pid int")).collect()
    with pytest.raises(ValueError):
        X.to_crs(src, 2263)


def test_area_and_holes(spark):
    multi = (W, "multipolygon", [geom([square(0, 0, 2)])[2][0], geom([square(5, 5, 4), square(6, 6)])[2][0]])
    tgt = layer(spark, [("a", geom([square(0, 0, 2)[::-1]])), ("b", multi), ("p", point(1, 1))])
    got = {r.region_id: r.a for r in tgt.select("region_id", G.area(F.col("geometry")).alias("a")).collect()}
    assert got == {"a": 4.0, "b": 19.0, "p": 0.0}
    assert X.total_area(tgt).first().area == 23.0


def test_dissolve(spark):
    rows = [("a", 1, None, geom([square(0, 0)])), ("a", 2, "first", geom([square(1, 0)])), ("a", 3, "second", geom([square(9, 9)])), ("b", 4, "x", geom([square(2, 0)]))]
    parts = spark.createDataFrame(rows, f"region_id string, pid int, note string, geometry {GEOMETRY_TYPE}")
    outline = X.dissolve_outline(parts, "region_id")
    assert {r.region_id: r["count"] for r in outline.groupBy("region_id").count().collect()} == {"a": 10, "b": 4}
    whole = {r.region_id: (r.note, r.parts, r.area, r.bbox.x2) for r in X.dissolve_attributes(parts, "region_id", ["pid"]).collect()}
    assert whole == {"a": ("first", 3, 3.0, 10.0), "b": ("x", 1, 1.0, 3.0)}
    assert pairs(X.overlapping_parts(parts, "pid"), "pid", "other") == [(1, 2), (2, 4)]


def test_audit_and_repair(spark):
    rows = [
        ("ok", geom([square(0, 0)])),
        ("point", point(0, 0)),
        ("none", None),
        ("open", geom([square(0, 0)[:-1]])),
        ("turned", geom([square(0, 0)[::-1]])),
        ("short", geom([[(0, 0), (1, 1), (0, 0)]])),
        ("flat", geom([[(0, 0), (1, 1), (2, 2), (0, 0)]])),
        ("empty", (W, "polygon", [])),
    ]
    tgt = layer(spark, rows)
    why = {r.region_id: r.p for r in tgt.select("region_id", G.problem(F.col("geometry")).alias("p")).collect()}
    assert why == {"ok": None, "point": None, "none": "no geometry", "open": "unclosed ring", "turned": None, "short": "too few vertices", "flat": "zero area", "empty": "no geometry"}
    fixed = {r.region_id: r.geometry for r in X.repair_geometry(tgt).collect()}
    assert sorted(fixed) == ["ok", "open", "point", "turned"]
    assert fixed["open"].polygons == fixed["ok"].polygons
    assert [tuple(v) for v in fixed["turned"].polygons[0][0]] == [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0), (0.0, 0.0)]
    assert X.drop_missing_geometry(tgt).count() == len(rows) - 1


def test_alignment_and_assignment(spark):
    bounds = layer(spark, [("A", geom([square(0, 0)])), ("B", geom([square(1, 0)]))])
    data = [("f1", 5.0, point(0.5, 0.5)), ("f2", 3.0, point(1.0, 0.5)), ("f3", 9.0, point(7, 7))]
    facilities = spark.createDataFrame(data, f"facility_id string, capacity double, geometry {GEOMETRY_TYPE}")
    survey = spark.createDataFrame([("A", 10, 4), ("C", 10, 1)], "region_id string, population long, participants long")
    aligned = align_to_geography(survey, survey, facilities, bounds)
    assert pairs(aligned.facilities, "facility_id", "region_id") == [("f1", "A"), ("f2", "A"), ("f2", "B")]
    first = X.assign_regions(facilities, bounds, "first")
    assert pairs(first, "facility_id", "region_id") == [("f1", "A"), ("f2", "A")]
    assert pairs(U.supply_from_facilities(aligned.facilities), "region_id", "supply_value") == [("A", 8.0), ("B", 3.0)]
    table, shapes = score_aligned(aligned)
    assert pairs(table, "region_id", "need_score") == [("A", 5.0), ("B", 0.0), ("C", None)]
    assert {r.region_id: r.geometry is not None for r in shapes.collect()} == {"A": True, "B": True, "C": False}
    placed = facilities.withColumn("region_id", F.when(F.col("facility_id") == "f1", "Z"))
    assert pairs(align_to_geography(survey, survey, placed, bounds).facilities, "facility_id", "region_id") == [("f1", "Z")]


def test_areas_join_every_region_they_meet(spark):
    """Park areas without ids beside points: over two regions, first corner outside all regions, twice the same row."""
    from pyspark.sql import functions as F

    from regional_balance.functions import geometry as geo
    from regional_balance.operators import spatial as sp

    def box(x1, y1, x2, y2):
        return geo.box(*[F.lit(float(v)) for v in (x1, y1, x2, y2)])

    one = spark.range(1)
    regions = one.select(F.lit("R0").alias("region_id"), box(0, 0, 1, 1).alias("geometry"))
    regions = regions.union(one.select(F.lit("R1"), box(1, 0, 2, 1)))
    rows = [("both", box(0.5, 0.2, 1.5, 0.4)), ("outside first", box(-1, 0.2, 0.5, 0.4)), ("far", box(5, 5, 6, 6))]
    rows += [("twice", box(1.2, 0.2, 1.3, 0.3))] * 2 + [("point", geo.point(F.lit(0.3), F.lit(0.3)))]
    parks = None
    for name, shape in rows:
        row = one.select(F.lit(name).alias("name"), shape.alias("geometry"))
        parks = row if parks is None else parks.union(row)
    pairs = lambda how: sorted((r.name, r.region_id or "") for r in sp.spatial_join(parks, regions, how=how).collect())
    inner = [("both", "R0"), ("both", "R1"), ("outside first", "R0"), ("point", "R0"), ("twice", "R1"), ("twice", "R1")]
    assert pairs("inner") == inner
    assert pairs("left") == sorted([*inner, ("far", "")])
    assert sorted(r.name for r in sp.assign_regions(parks, regions).collect()) == [n for n, _ in inner]


def test_parts_lines_and_multipoints_meet_areas(spark):
    """Multi-part sources are matched by every part; an outline of a line has no inside."""
    tgt = layer(spark, [("A", geom([square(0, 0, 10)])), ("B", geom([square(20, 0, 1)])), ("ring", geom([square(40, 0, 10), square(41, 1, 8)]))])

    def parts(kind, *each):
        return (W, kind, [[[(float(x), float(y)) for x, y in part]] for part in each])

    rows = [
        ("two areas", parts("multipolygon", square(100, 100), square(4, 4))),
        ("points", parts("multipoint", [(99, 99)], [(5, 5)], [(20, 0.5)])),
        ("trail", parts("linestring", [(-1, 5), (20.5, 5), (20.5, 0.5)])),
        ("trail inside", parts("multilinestring", [(70, 70), (71, 71)], [(2, 2), (3, 3)])),
        ("round B", parts("linestring", square(15, -5, 11))),
        ("in hole", parts("linestring", [(43, 3), (44, 4)])),
        ("point", point(20.5, 0.5)),
    ]
    src = layer(spark, rows, "name string")
    want = [("points", "A"), ("points", "B"), ("point", "B"), ("trail", "A"), ("trail", "B"), ("trail inside", "A"), ("two areas", "A")]
    assert pairs(X.spatial_join(src, tgt, how="inner"), "name", "region_id") == sorted(want, key=str)
    assert pairs(X.spatial_join(src, tgt, how="inner", source_id="name"), "name", "region_id") == sorted(want, key=str)
    g = F.col("geometry")
    back = F.get_json_object(G.to_geojson(g), "$")
    read = G.from_geojson(F.get_json_object(back, "$.type"), F.get_json_object(back, "$.coordinates"), F.lit(W))
    assert src.filter(~read["polygons"].eqNullSafe(g["polygons"])).count() == 0
    assert src.select(F.sum(G.area(g))).first()[0] == 2.0 and src.filter(G.problem(g).isNotNull()).count() == 0


def test_far_parts_do_not_crowd_cells(spark):
    """Cells of a geometry of many small parts keep in proportion to its parts, and a crowded outline still gets small ones."""
    parts = [geom([square(3.0 * k, 0.0)])[2][0] for k in range(2000)]
    tgt = layer(spark, [("many", (W, "multipolygon", parts))])
    assert X.region_cells(tgt, X.Grid(), "region_id").count() <= 4 * len(parts)
    spots = [(1, point(3000.5, 0.5)), (2, point(3002.0, 0.5)), (3, point(5998.0, 1.0))]
    assert {r.i for r in X.spatial_join(layer(spark, spots, "i int"), tgt, how="inner").collect()} == {1, 3}
    big = [geom([square(0.0, 10.0, 1000.0)])[2][0]]
    mixed = layer(spark, [("mixed", (W, "multipolygon", [*parts, *big]))])
    held = X.region_cells(mixed, X.Grid(), "region_id").agg(F.count("*"), F.max(F.size("_te"))).first()
    assert held[0] <= 4 * len(parts) and held[1] < 300
