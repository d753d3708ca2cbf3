"""Dissolved regions as geometries: outline edges linked end to end into rings, rings into polygons with holes.

Edges stay rows until a region's geometry, which is one value, is put together. Rings are found by pointer doubling: every
edge knows the smallest edge within its next 2 ** k and how far ahead that is, and learns of twice as many in each round.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regional_balance import schema as S
from regional_balance.functions import geometry as G
from regional_balance.functions import planar as P
from regional_balance.operators.cells import Grid, laid_out
from regional_balance.session import settle

_ENDS = ("x1", "y1", "x2", "y2")


def outline_edges(df: DataFrame, region: str, geometry: str = "geometry") -> DataFrame:
    """(region, x1, y1, x2, y2): edges of each region's outline with its inside on their left.

    For a coverage whose neighbours share vertices: an edge between two parts of a region is there once in either
    direction and cancels.
    """
    shapes = df.filter(F.col(geometry).isNotNull() & G.is_area(F.col(geometry)))
    e = shapes.select(region, F.explode(G.edges(G.close_rings(F.col(geometry)))).alias("e"))
    forward = (F.col("e.x1") < F.col("e.x2")) | ((F.col("e.x1") == F.col("e.x2")) & (F.col("e.y1") < F.col("e.y2")))
    e = e.filter((F.col("e.x1") != F.col("e.x2")) | (F.col("e.y1") != F.col("e.y2")))

    def pick(a: str, b: str) -> Column:
        return F.when(forward, F.col(f"e.{a}")).otherwise(F.col(f"e.{b}"))

    ways = {"x1": pick("x1", "x2"), "y1": pick("y1", "y2"), "x2": pick("x2", "x1"), "y2": pick("y2", "y1")}
    counted = e.select(region, *[c.alias(n) for n, c in ways.items()], F.when(forward, 1).otherwise(-1).alias("way"))
    counted = counted.groupBy(region, *_ENDS).agg(F.sum("way").alias("way")).filter(F.col("way") != 0)
    turned = F.col("way") < 0
    swap = {"x1": "x2", "y1": "y2", "x2": "x1", "y2": "y1"}
    return counted.select(region, *[F.when(turned, F.col(b)).otherwise(F.col(a)).alias(a) for a, b in swap.items()])


def linked(edges: DataFrame, region: str) -> DataFrame:
    """(region, id, x1, y1, next): the edge that follows each. Where several leave a vertex it is the first one clockwise from
    the way back, so rings that touch in a point stay apart."""
    named = edges.withColumn("id", F.struct(*_ENDS))
    after = named.select(region, F.col("x1").alias("x2"), F.col("y1").alias("y2"), F.col("x2").alias("fx"), F.col("y2").alias("fy"), F.col("id").alias("next"))
    met = named.join(after, [region, "x2", "y2"])
    way_back = F.atan2(F.col("y1") - F.col("y2"), F.col("x1") - F.col("x2"))
    way_on = F.atan2(F.col("fy") - F.col("y2"), F.col("fx") - F.col("x2"))
    turn = F.pmod(way_back - way_on, F.lit(2 * math.pi))
    turn = F.when(turn <= 0, F.lit(2 * math.pi)).otherwise(turn)
    return met.groupBy(region, "id").agg(F.min_by("next", F.struct(turn, "next")).alias("next"))


def ring_places(links: DataFrame, region: str) -> DataFrame:
    """(region, id, low, ahead): the smallest edge of each edge's ring, and how many steps ahead it is.

    One round for each doubling of the longest ring; each is computed once, into the shared folder. When nothing changes in a
    round of s steps, edges s apart have the same smallest edge, and so do all of a ring.
    """
    state = settle(links.select(region, "id", F.col("next").alias("jump"), F.col("id").alias("low"), F.lit(0).cast("long").alias("ahead")))
    span = 1
    while True:
        far = state.select(region, F.col("id").alias("jump"), F.col("jump").alias("far"), F.col("low").alias("low2"), F.col("ahead").alias("ahead2"))
        met = state.join(far, [region, "jump"])
        less = F.col("low2") < F.col("low")
        new = met.select(
            region,
            "id",
            F.col("far").alias("jump"),
            F.when(less, F.col("low2")).otherwise(F.col("low")).alias("low"),
            F.when(less, F.col("ahead2") + span).otherwise(F.col("ahead")).alias("ahead"),
            less.alias("changed"),
        )
        new = settle(new)
        state, span = new.drop("changed"), 2 * span
        if new.filter("changed").isEmpty():
            return state.select(region, "id", "low", "ahead")


def rings_of(edges: DataFrame, region: str) -> DataFrame:
    """(region, low, ring, area): the closed rings of outline edges; area is negative for holes."""
    places = ring_places(linked(edges, region), region)
    # The smallest edge is 0 steps ahead of itself; what follows it has the whole ring still ahead.
    order = F.when(F.col("ahead") == 0, F.lit(0).cast("long")).otherwise(F.lit(2**62) - F.col("ahead"))
    vertex = F.struct(F.col("id.x1").alias("x"), F.col("id.y1").alias("y"))
    ordered = places.groupBy(region, "low").agg(F.sort_array(F.collect_list(F.struct(order.alias("at"), vertex.alias("v")))).alias("all"))
    vertices = F.transform("all", lambda a: a["v"])
    rings = ordered.select(region, "low", F.concat(vertices, F.slice(vertices, 1, 1)).alias("ring"))
    return rings.withColumn("area", G.signed_area(F.col("ring")))


def holes_placed(rings: DataFrame, region: str, srid: int, grid: Grid = Grid()) -> DataFrame:
    """(region, low, ring, holes): outlines with the holes in them. A hole belongs to the smallest outline of its region around it."""
    shells = rings.filter("area > 0").withColumn("_g", G.polygon(F.col("ring"), srid=srid))
    shells = shells.withColumns({"own": grid.level_of(F.col("_g"))}).withColumn("on", F.array("own"))
    cells = laid_out(shells, grid, [region, "low"], "_g", "on", ["area"])
    levels = shells.agg(F.collect_set("own").alias("levels")).scalar()
    # The middle of a hole's first edge lies on no other edge of the outline.
    v = F.col("ring")
    x, y = (v[0]["x"] + v[1]["x"]) / 2, (v[0]["y"] + v[1]["y"]) / 2
    holes = rings.filter("area < 0").select(region, F.col("ring").alias("hole"), x.alias("x"), y.alias("y"), F.col("low").alias("hole_low"))
    probes = holes.select(region, "hole_low", "x", "y").withColumn("level", F.explode(levels))
    probes = probes.withColumns({f"c{c}": grid.cell(F.col(c), F.col("level")) for c in "xy"})
    cell = grid.bounds(F.col("cx"), F.col("cy"), F.col("level"))
    around = probes.join(cells, [region, "level", "cx", "cy"]).filter(P.inside(F.col("edges"), F.col("middle"), F.col("x"), F.col("y"), cell))
    shell = around.groupBy(region, "hole_low").agg(F.min_by("low", "area").alias("low"))
    inner = holes.join(shell, [region, "hole_low"]).groupBy(region, "low").agg(F.collect_list("hole").alias("holes"))
    return shells.select(region, "low", "ring").join(inner, [region, "low"], "left")


def dissolve_geometry(df: DataFrame, region: str, geometry: str = "geometry", grid: Grid = Grid()) -> DataFrame:
    """(region, geometry): the parts of each region as one polygon or multipolygon, inner borders gone.

    For a coverage whose neighbours share vertices, in one CRS. A region without areas has none here. Rings are settled in the shared folder
    while this is built, one round for each doubling of the longest.
    """
    S.require(df, region, geometry, what="parts")
    srid = df.agg(F.max(F.col(geometry)["srid"])).first()[0]
    rings = settle(rings_of(outline_edges(df, region, geometry), region))
    placed = holes_placed(rings, region, srid, grid)
    parts = F.concat(F.array("ring"), F.coalesce("holes", F.array().cast("array<array<struct<x:double,y:double>>>")))
    whole = placed.groupBy(region).agg(F.sort_array(F.collect_list(parts)).alias("polygons"))
    kind = F.when(F.size("polygons") == 1, "polygon").otherwise("multipolygon")
    value = F.struct(F.lit(srid).cast("int").alias("srid"), kind.alias("kind"), F.col("polygons")).cast(S.GEOMETRY_TYPE)
    return whole.select(region, value.alias(geometry))


def dissolve(
    df: DataFrame, region: str, order: Sequence[str], attributes: Sequence[str] | None = None, geometry: str = "geometry", grid: Grid = Grid()
) -> DataFrame:
    """One row per region: its geometry and the first attribute values by ``order``, as a layer to write or join."""
    from regional_balance.operators.spatial import dissolve_attributes

    values = dissolve_attributes(df, region, order, attributes, geometry).drop("area", "bbox")
    shapes = dissolve_geometry(df, region, geometry, grid)
    return values.join(shapes, region, "left")
