"""Geometry as nested arrays and the expressions over it. See ``schema.GEOMETRY_TYPE``.

A geometry has an SRID, a kind (``KINDS``) and polygons -> rings -> vertices. The first ring of a polygon is its
outline, the others are holes. Points and lines use the same nesting: each point, or each line, is a part of its own, one
"polygon" of one "ring" that is not closed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from regional_balance import schema as S


AREAS, LINES, POINTS = ("polygon", "multipolygon"), ("linestring", "multilinestring"), ("point", "multipoint")
KINDS = (*AREAS, *LINES, *POINTS)


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once however often ``use`` names it: columns are text that is put in everywhere."""
    return F.transform(F.array(value), use)[0]


def point(x: Column, y: Column, srid: int = S.SRID_LONLAT) -> Column:
    vertex = F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))
    value = F.struct(
        F.lit(srid).alias("srid"), F.lit("point").alias("kind"), F.array(F.array(F.array(vertex))).alias("polygons")
    )
    return F.when(x.isNotNull() & y.isNotNull(), value)


def polygon(*rings: Column, srid: int = S.SRID_LONLAT) -> Column:
    """From rings given as arrays of ``struct<x,y>``."""
    return F.struct(
        F.lit(srid).alias("srid"), F.lit("polygon").alias("kind"), F.array(F.array(*rings)).alias("polygons")
    )


def box(x1: Column, y1: Column, x2: Column, y2: Column, srid: int = S.SRID_LONLAT) -> Column:
    corners = ((x1, y1), (x2, y1), (x2, y2), (x1, y2), (x1, y1))
    ring = F.array(*[F.struct(x.cast("double").alias("x"), y.cast("double").alias("y")) for x, y in corners])
    return polygon(ring, srid=srid)


def joined_parts(kind: str, *parts: Column) -> Column:
    """One geometry of the parts of several in the same CRS."""
    every = F.concat(*[p["polygons"] for p in parts])
    return F.struct(parts[0]["srid"].alias("srid"), F.lit(kind).alias("kind"), every.alias("polygons"))


def line(*ends: Column, srid: int = S.SRID_LONLAT) -> Column:
    """Through vertices given as ``struct<x,y>``."""
    return F.struct(F.lit(srid).alias("srid"), F.lit("linestring").alias("kind"), F.array(F.array(F.array(*ends))).alias("polygons"))


def rings(g: Column) -> Column:
    return F.flatten(g["polygons"])


def vertices(g: Column) -> Column:
    return F.flatten(rings(g))


def point_x(g: Column) -> Column:
    return g["polygons"][0][0][0]["x"]


def point_y(g: Column) -> Column:
    return g["polygons"][0][0][0]["y"]


def is_point(g: Column) -> Column:
    return g["kind"] == "point"


def is_area(g: Column) -> Column:
    return g["kind"].isin(*AREAS)


def starts(g: Column) -> Column:
    """array<struct<x,y>>: the first vertex of every part."""
    return F.transform(g["polygons"], lambda p: p[0][0])


def bbox(g: Column) -> Column:
    """struct<x1,y1,x2,y2>"""
    xs = F.transform(vertices(g), lambda p: p["x"])
    ys = F.transform(vertices(g), lambda p: p["y"])
    return F.struct(
        F.array_min(xs).alias("x1"), F.array_min(ys).alias("y1"), F.array_max(xs).alias("x2"), F.array_max(ys).alias("y2")
    )


def part_boxes(g: Column) -> Column:
    """array<struct<x1,y1,x2,y2>>: the box of every part, from its outline."""

    def box_of(ring: Column) -> Column:
        xs, ys = F.transform(ring, lambda v: v["x"]), F.transform(ring, lambda v: v["y"])
        return F.struct(
            F.array_min(xs).alias("x1"), F.array_min(ys).alias("y1"), F.array_max(xs).alias("x2"), F.array_max(ys).alias("y2")
        )

    return F.transform(g["polygons"], lambda p: box_of(p[0]))


def ring_edges(ring: Column) -> Column:
    """array<struct<x1,y1,x2,y2>> between successive vertices."""
    n = F.greatest(F.size(ring) - 1, F.lit(0))
    return F.zip_with(
        F.slice(ring, F.lit(1), n),
        F.slice(ring, F.lit(2), n),
        lambda a, b: F.struct(
            a["x"].alias("x1"), a["y"].alias("y1"), b["x"].alias("x2"), b["y"].alias("y2")
        ),
    )


def edges(g: Column) -> Column:
    return F.flatten(F.transform(rings(g), ring_edges))


def strokes(g: Column) -> Column:
    """``edges``, and for points an edge without length at each."""
    spots = F.transform(vertices(g), lambda v: F.struct(v["x"].alias("x1"), v["y"].alias("y1"), v["x"].alias("x2"), v["y"].alias("y2")))
    return F.when(g["kind"].isin(*POINTS), spots).otherwise(edges(g))


def signed_area(ring: Column) -> Column:
    """Area of a closed ring, negative if it runs clockwise."""
    # Relative to the first vertex: working-CRS coordinates are large and their products would cancel badly.
    o = ring[0]
    twice = F.aggregate(
        ring_edges(ring),
        F.lit(0.0),
        lambda acc, e: acc + (e["x1"] - o["x"]) * (e["y2"] - o["y"]) - (e["x2"] - o["x"]) * (e["y1"] - o["y"]),
    )
    return twice / F.lit(2.0)


def area(g: Column) -> Column:
    """Outlines less holes, in the units of the geometry's CRS; zero for points and lines."""

    def of_polygon(rings_: Column) -> Column:
        holes = F.slice(rings_, F.lit(2), F.greatest(F.size(rings_) - 1, F.lit(0)))
        hole_area = F.aggregate(holes, F.lit(0.0), lambda acc, r: acc + F.abs(signed_area(r)))
        return F.abs(signed_area(rings_[0])) - hole_area

    total = F.aggregate(g["polygons"], F.lit(0.0), lambda acc, p: acc + of_polygon(p))
    return F.when(g["kind"].isin(*LINES, *POINTS), F.lit(0.0)).otherwise(total)


def _map_vertices(g: Column, srid: int, fx, fy) -> Column:
    moved = F.transform(
        g["polygons"],
        lambda p: F.transform(
            p,
            lambda r: F.transform(r, lambda v: F.struct(fx(v["x"]).alias("x"), fy(v["y"]).alias("y"))),
        ),
    )
    return F.struct(F.lit(srid).alias("srid"), g["kind"].alias("kind"), moved.alias("polygons"))


def mercator_x(lon: Column) -> Column:
    return F.radians(lon) * F.lit(S.EARTH_RADIUS)


def mercator_y(lat: Column) -> Column:
    return F.ln(F.tan(F.lit(0.7853981633974483) + F.radians(lat) / F.lit(2.0))) * F.lit(S.EARTH_RADIUS)


def inverse_x(x: Column) -> Column:
    return F.degrees(x / F.lit(S.EARTH_RADIUS))


def inverse_y(y: Column) -> Column:
    return F.degrees(F.lit(2.0) * F.atan(F.exp(y / F.lit(S.EARTH_RADIUS))) - F.lit(1.5707963267948966))


def reproject(g: Column, srid: int = S.SRID_WORKING) -> Column:
    """Between longitude/latitude and spherical Mercator; a geometry without a CRS, or with another, is an error."""
    if srid == S.SRID_WORKING:
        moved, source = _map_vertices(g, srid, mercator_x, mercator_y), S.SRID_LONLAT
    elif srid == S.SRID_LONLAT:
        moved, source = _map_vertices(g, srid, inverse_x, inverse_y), S.SRID_WORKING
    else:
        raise ValueError(f"reproject knows {S.SRID_LONLAT} and {S.SRID_WORKING}, not {srid}")
    # A single point, the commonest case, without walking nested arrays.
    fx, fy = (mercator_x, mercator_y) if srid == S.SRID_WORKING else (inverse_x, inverse_y)
    spot = F.array(F.array(F.array(F.struct(fx(point_x(g)).alias("x"), fy(point_y(g)).alias("y")))))
    alone = F.struct(F.lit(srid).alias("srid"), g["kind"].alias("kind"), spot.alias("polygons"))
    moved = F.when(is_point(g), alone).otherwise(moved)
    unknown = F.raise_error(F.concat(F.lit("geometry CRS cannot be reprojected: "), F.coalesce(g["srid"].cast("string"), F.lit("none"))))
    return (
        F.when(g.isNull(), F.lit(None).cast(S.GEOMETRY_TYPE))
        .when(g["srid"] == srid, g)
        .when(g["srid"] == source, moved)
        .otherwise(unknown.cast(S.GEOMETRY_TYPE))
    )


def on_edge(x: Column, y: Column, e: Column) -> Column:
    cross = (e["x2"] - e["x1"]) * (y - e["y1"]) - (x - e["x1"]) * (e["y2"] - e["y1"])
    inside = (
        (x >= F.least(e["x1"], e["x2"]))
        & (x <= F.greatest(e["x1"], e["x2"]))
        & (y >= F.least(e["y1"], e["y2"]))
        & (y <= F.greatest(e["y1"], e["y2"]))
    )
    return inside & (cross == 0)


def _crossed(x: Column, y: Column, e: Column) -> Column:
    """The ray from (x, y) towards growing x crosses the edge."""
    spans = (e["y1"] > y) != (e["y2"] > y)
    side = (e["x2"] - e["x1"]) * (y - e["y1"]) - (x - e["x1"]) * (e["y2"] - e["y1"])
    return spans & F.when(e["y2"] > e["y1"], side > 0).otherwise(side < 0)


def covers_point(edge_list: Column, x: Column, y: Column) -> Column:
    """Closed polygon test over an edge array: boundary contact counts, holes work by parity."""
    touches = F.exists(edge_list, lambda e: on_edge(x, y, e))
    crossings = F.size(F.filter(edge_list, lambda e: _crossed(x, y, e)))
    return touches | (crossings % 2 == 1)


def _orient(ax: Column, ay: Column, bx: Column, by: Column, cx: Column, cy: Column) -> Column:
    return F.signum((bx - ax) * (cy - ay) - (by - ay) * (cx - ax))


def edges_meet(e: Column, f: Column) -> Column:
    """Two closed segments share a point."""
    o1 = _orient(e["x1"], e["y1"], e["x2"], e["y2"], f["x1"], f["y1"])
    o2 = _orient(e["x1"], e["y1"], e["x2"], e["y2"], f["x2"], f["y2"])
    o3 = _orient(f["x1"], f["y1"], f["x2"], f["y2"], e["x1"], e["y1"])
    o4 = _orient(f["x1"], f["y1"], f["x2"], f["y2"], e["x2"], e["y2"])
    touching = (
        on_edge(f["x1"], f["y1"], e) | on_edge(f["x2"], f["y2"], e) | on_edge(e["x1"], e["y1"], f) | on_edge(e["x2"], e["y2"], f)
    )
    return ((o1 * o2 < 0) & (o3 * o4 < 0)) | touching


def polygons_meet(
    edges_a: Column,
    edges_b: Column,
    starts_a: Column | None = None,
    starts_b: Column | None = None,
    area_a: Column | None = None,
    area_b: Column | None = None,
) -> Column:
    """Outlines meet, or a part of one lies within the other.

    A part that crosses no outline lies inside or outside as a whole, so its first vertex answers for it. Without
    ``starts`` each side is taken for an area of one part; ``area_a`` and ``area_b`` tell areas from lines and points,
    which have edges but no inside.
    """

    def first(edge_list: Column) -> Column:
        return F.transform(F.slice(edge_list, 1, 1), lambda e: F.struct(e["x1"].alias("x"), e["y1"].alias("y")))

    def reaches(parts: Column, edge_list: Column, area: Column | None) -> Column:
        def within(v: Column) -> Column:
            if area is None:
                return covers_point(edge_list, v["x"], v["y"])
            on = F.exists(edge_list, lambda e: on_edge(v["x"], v["y"], e))
            return F.when(area, covers_point(edge_list, v["x"], v["y"])).otherwise(on)

        return F.exists(parts, within)

    starts_a = first(edges_a) if starts_a is None else starts_a
    starts_b = first(edges_b) if starts_b is None else starts_b
    meet = F.exists(edges_a, lambda e: F.exists(edges_b, lambda f: edges_meet(e, f)))
    return meet | reaches(starts_a, edges_b, area_b) | reaches(starts_b, edges_a, area_a) | F.arrays_overlap(starts_a, starts_b)


def close_rings(g: Column) -> Column:
    """Repeat the first vertex at the end of rings that lack it."""

    def closed(r: Column) -> Column:
        return F.when((F.size(r) > 1) & (r[0] != F.element_at(r, -1)), F.concat(r, F.slice(r, 1, 1))).otherwise(r)

    def orient(r: Column, outline: Column) -> Column:
        wrong = F.when(outline, signed_area(r) < 0).otherwise(signed_area(r) > 0)
        return F.when(wrong, F.reverse(r)).otherwise(r)

    fixed = F.transform(
        g["polygons"], lambda p: F.transform(F.transform(p, closed), lambda r, i: orient(r, i == 0))
    )
    value = F.struct(g["srid"].alias("srid"), g["kind"].alias("kind"), fixed.alias("polygons"))
    return F.when(is_area(g), value).otherwise(g)


def problem(g: Column) -> Column:
    """First reason why a geometry is unusable, or null: checked after ``close_rings`` nothing is unclosed."""
    too_short = F.exists(rings(g), lambda r: F.size(r) < 4)
    unclosed = F.exists(rings(g), lambda r: r[0] != F.element_at(r, -1))
    return (
        F.when(g.isNull() | (F.size(vertices(g)) < 1), F.lit("no geometry"))
        .when(g["kind"].isin(*LINES) & F.exists(rings(g), lambda r: F.size(r) < 2), F.lit("too few vertices"))
        .when(~is_area(g), F.lit(None).cast("string"))
        .when(unclosed, F.lit("unclosed ring"))
        .when(too_short, F.lit("too few vertices"))
        .when(area(g) == 0, F.lit("zero area"))
    )


def from_geojson(kind: Column, coordinates: Column, srid: Column) -> Column:
    """From a GeoJSON geometry's type and the text of its coordinates; null for collections and what cannot be read."""
    depth = {"Point": 1, "MultiPoint": 2, "LineString": 2, "MultiLineString": 3, "Polygon": 3, "MultiPolygon": 4}

    def parsed(levels: int) -> Column:
        ddl = "double"
        for _ in range(levels):
            ddl = f"array<{ddl}>"
        return F.from_json(coordinates, ddl)

    def vertex(v: Column) -> Column:
        return F.struct(v[0].alias("x"), v[1].alias("y"))

    def polygon_rings(p: Column) -> Column:
        return F.transform(p, lambda r: F.transform(r, vertex))

    polys = (
        F.when(kind == "Point", F.array(F.array(F.array(vertex(parsed(depth["Point"]))))))
        .when(kind == "MultiPoint", F.transform(parsed(depth["MultiPoint"]), lambda v: F.array(F.array(vertex(v)))))
        .when(kind == "LineString", F.array(F.array(F.transform(parsed(depth["LineString"]), vertex))))
        .when(kind == "MultiLineString", F.transform(parsed(depth["MultiLineString"]), lambda r: F.array(F.transform(r, vertex))))
        .when(kind == "Polygon", F.array(polygon_rings(parsed(depth["Polygon"]))))
        .when(kind == "MultiPolygon", F.transform(parsed(depth["MultiPolygon"]), polygon_rings))
    )

    def value(polys: Column) -> Column:
        return F.when(polys.isNotNull(), F.struct(srid.cast("int").alias("srid"), F.lower(kind).alias("kind"), polys.alias("polygons")))

    return once(polys, value)


def to_geojson(g: Column) -> Column:
    """GeoJSON geometry text; ``null`` text for a missing geometry."""

    def vertex(v: Column) -> Column:
        return F.array(v["x"], v["y"])

    def polygon_text(p: Column) -> Column:
        return F.to_json(F.transform(p, lambda r: F.transform(r, vertex)))

    def text(kind: str, coordinates: Column) -> Column:
        return F.concat(F.lit(f'{{"type":"{kind}","coordinates":'), coordinates, F.lit("}"))

    polys = g["polygons"]
    many = F.to_json(F.transform(polys, lambda p: F.transform(p, lambda r: F.transform(r, vertex))))
    return F.coalesce(
        F.when(is_point(g), text("Point", F.to_json(vertex(polys[0][0][0]))))
        .when(g["kind"] == "multipoint", text("MultiPoint", F.to_json(F.transform(polys, lambda p: vertex(p[0][0])))))
        .when(g["kind"] == "linestring", text("LineString", F.to_json(F.transform(polys[0][0], vertex))))
        .when(g["kind"] == "multilinestring", text("MultiLineString", F.to_json(F.transform(polys, lambda p: F.transform(p[0], vertex)))))
        .when(g["kind"] == "polygon", text("Polygon", polygon_text(polys[0])))
        .when(g["kind"] == "multipolygon", text("MultiPolygon", many)),
        F.lit("null"),
    )
