"""Geometries laid out on grid cells, edge by edge, and the relations that follow from what happens in the cells.

Everything is rows: an edge goes to the cells that it meets, the inside of an area is filled in along the centre lines of
cell rows, and both are gathered by cell. So a geometry of any size is spread out, parts far apart cost what they would
cost alone, and a cell inside an area holds no edge at all.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regional_balance.functions import geometry as G
from regional_balance.functions import planar as P

_SMALLEST, _LN8 = 1e-9, math.log(8.0)

#: Edges that a cell should hold, about, after a detailed outline has been given smaller cells.
CELL_EDGES = 16

#: What ``spatial_join`` can ask for; each is of the source to the target.
PREDICATES = ("intersects", "within", "contains", "touches", "overlaps", "crosses")

#: A further relation: the interiors have a point in common.
INTERIORS = "interiors"


@dataclass(frozen=True)
class Grid:
    """Square cells of side ``8 ** level``; a geometry belongs to the level whose cells are at least as large as its largest part.

    A part then covers at most 2 x 2 cells however uneven the sizes in a layer are, and small geometries never share
    a cell just because large ones exist. An outline of many edges belongs to a lower level, so that a cell has few of them.
    A fixed ``side`` makes one level; as a column it is one that all rows carry.
    """

    side: float | Column | None = None

    def level(self, box: Column) -> Column:
        if self.side is not None:
            return F.lit(0)
        extent = F.greatest(box["x2"] - box["x1"], box["y2"] - box["y1"], F.lit(_SMALLEST))
        return F.ceil(F.ln(extent) / F.lit(_LN8)).cast("int")

    def level_of(self, g: Column) -> Column:
        """The level of a geometry, from its largest part and the number of its edges on as much ground as that takes.

        Edges of parts elsewhere do not crowd a cell, so a geometry of many small parts has cells as large as they are and
        the number of its cells keeps in proportion to that of its edges.
        """
        if self.side is not None:
            return F.lit(0)
        extents = F.transform(G.part_boxes(g), lambda b: F.greatest(b["x2"] - b["x1"], b["y2"] - b["y1"], F.lit(_SMALLEST)))

        def level(extents: Column, extent: Column) -> Column:
            ground = F.aggregate(extents, F.lit(0.0), lambda s, e: s + (e / extent) * (e / extent))
            crowd = F.size(G.vertices(g)) / F.lit(float(CELL_EDGES)) / ground
            detailed = F.round((F.ln(extent) - F.ln(crowd) / 2) / F.lit(_LN8))
            return F.when(crowd > 1, detailed).otherwise(F.ceil(F.ln(extent) / F.lit(_LN8))).cast("int")

        return G.once(extents, lambda all: G.once(F.array_max(all), lambda largest: level(all, largest)))

    def size(self, level: Column) -> Column:
        if self.side is None:
            return F.pow(F.lit(8.0), level)
        return self.side if isinstance(self.side, Column) else F.lit(float(self.side))

    def cell(self, c: Column, level: Column) -> Column:
        return F.floor(c / self.size(level))

    def span(self, lo: Column, hi: Column, level: Column) -> Column:
        return F.sequence(self.cell(lo, level), self.cell(hi, level))

    def centre(self, cell: Column, level: Column) -> Column:
        return (cell + F.lit(0.5)) * self.size(level)

    def bounds(self, cx: Column, cy: Column, level: Column) -> P.Cell:
        size = self.size(level)
        return P.Cell(cx * size, cy * size, (cx + 1) * size, (cy + 1) * size, self.centre(cx, level), self.centre(cy, level))


def edge_cells(rows: DataFrame, grid: Grid, edge: str = "_e", level: str = "_level") -> DataFrame:
    """Rows of edges with the cells (``_cx``, ``_cy``) of their level that they meet, one row for each."""
    e, at = F.col(edge), F.col(level)
    spans = {f"_c{c}": grid.span(F.least(e[f"{c}1"], e[f"{c}2"]), F.greatest(e[f"{c}1"], e[f"{c}2"]), at) for c in "xy"}
    for name, span in spans.items():
        rows = rows.withColumn(name, F.explode(span))
    box = grid.bounds(F.col("_cx"), F.col("_cy"), at)
    # Corners all on one side of a slanted edge: it passes the cell by.
    sides = [(e["x2"] - e["x1"]) * (y - e["y1"]) - (x - e["x1"]) * (e["y2"] - e["y1"]) for x in (box.x1, box.x2) for y in (box.y1, box.y2)]
    return rows.filter((F.greatest(*sides) >= 0) & (F.least(*sides) <= 0))


def laid_out(shapes: DataFrame, grid: Grid, key: Sequence[str], geometry: str, levels: str, carried: Sequence[str] = ()) -> DataFrame:
    """(key..., carried..., level, cx, cy, edges, middle): each geometry on every level of its array ``levels``.

    ``edges`` are those that meet the cell and ``middle`` says whether its centre is inside the area; cells without either
    are left out. Geometries that are equal in ``key`` must be one.
    """
    g = F.col(geometry)
    rows = shapes.filter(g.isNotNull()).withColumn("_area", G.is_area(g)).withColumn("_level", F.explode(levels))
    kept = [*key, *carried]
    rows = rows.select(*kept, "_area", "_level", F.explode(G.strokes(g)).alias("_e"))
    e, level = F.col("_e"), F.col("_level")
    rows = rows.filter(~F.col("_area") | (e["x1"] != e["x2"]) | (e["y1"] != e["y2"]))
    placed = edge_cells(rows, grid).select(*kept, "_level", "_cx", "_cy", "_e", F.lit(False).alias("_middle"))

    lines = rows.filter("_area").withColumn("_cy", F.explode(grid.span(F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"]), level)))
    height = grid.centre(F.col("_cy"), level)
    lines = lines.filter((e["y1"] > height) != (e["y2"] > height))
    at = e["x1"] + (height - e["y1"]) * (e["x2"] - e["x1"]) / (e["y2"] - e["y1"])
    held = [F.first(c).alias(c) for c in carried]
    lines = lines.groupBy(*key, "_level", "_cy").agg(F.sort_array(F.collect_list(at)).alias("_at"), *held)
    pairs = F.transform(F.sequence(F.lit(1), F.size("_at") - 1, F.lit(2)), lambda k: F.struct(F.col("_at")[k - 1].alias("a"), F.col("_at")[k].alias("b")))
    filled = lines.filter(F.size("_at") >= 2).withColumn("_run", F.explode(pairs))
    # Cells whose centre is at a or beyond and before b.
    first, last = (F.ceil(F.col(f"_run.{c}") / grid.size(level) - 0.5) for c in "ab")
    filled = filled.withColumns({"_first": first, "_last": last - 1}).filter(F.col("_first") <= F.col("_last"))
    filled = filled.withColumn("_cx", F.explode(F.sequence("_first", "_last")))
    none = F.lit(None).cast("struct<x1:double,y1:double,x2:double,y2:double>")
    filled = filled.select(*kept, "_level", "_cx", "_cy", none.alias("_e"), F.lit(True).alias("_middle"))

    cells = placed.unionByName(filled).groupBy(*key, "_level", "_cx", "_cy")
    cells = cells.agg(F.collect_list("_e").alias("edges"), F.max("_middle").alias("middle"), *held)
    return cells.withColumnsRenamed({"_level": "level", "_cx": "cx", "_cy": "cy"})


def _levels(shapes: DataFrame) -> Column:
    """All levels of a layer, as a scalar subquery: a few numbers, eight-fold steps of size apart."""
    return shapes.agg(F.collect_set("own").alias("levels")).scalar()


def related(sources: DataFrame, targets: DataFrame, grid: Grid, predicate: str = "intersects", ordered: bool = False) -> DataFrame:
    """(s, t) of the pairs for which the predicate holds, each once; with ``ordered`` those only in which s is less than t.

    Both frames are (s or t, geometry) with unique ids in one CRS; targets are areas, sources anything. Two geometries meet
    on the coarser of their levels. The interior of one meets the exterior of the other if a piece of the one's outline lies
    outside the other (or in a cell where the other has nothing), a piece of the other's lies within the one, or they share a
    piece of outline with their interiors on either side of it.
    """
    g = F.col("geometry")
    sized = [df.filter(g.isNotNull()).withColumns({"own": grid.level_of(g), "box": G.bbox(g)}) for df in (sources, targets)]
    layouts = []
    for name, mine, others in (("s", sized[0], sized[1]), ("t", sized[1], sized[0])):
        on = mine.withColumn("others", _levels(others.select("own")))
        coarser = F.filter("others", lambda v: v > F.col("own"))
        on = on.withColumn("on", F.array_union(F.array("own"), F.coalesce(coarser, F.array().cast("array<int>"))))
        on = on.withColumn("area", G.is_area(g))
        cells = laid_out(on, grid, [name], "geometry", "on", ["own", "area", "box"])
        new = {"box": f"{name}_box", "own": f"{name}_own", "area": f"{name}_area", "edges": f"{name}_edges", "middle": f"{name}_middle"}
        layouts.append(cells.withColumnsRenamed(new))
    s_cells, t_cells = layouts[0], layouts[1].drop("t_area")
    met = s_cells.join(t_cells, ["level", "cx", "cy"]).filter(F.col("level") == F.greatest("s_own", "t_own"))
    a, b = F.col("s_box"), F.col("t_box")
    met = met.filter((a["x1"] <= b["x2"]) & (b["x1"] <= a["x2"]) & (a["y1"] <= b["y2"]) & (b["y1"] <= a["y2"]))
    if ordered:
        met = met.filter(F.col("s") < F.col("t"))
    # Small in bytes and heavy in work: dealt out anew, so that neither few partitions nor a crowded cell hold it up.
    met = met.drop("s_box", "t_box").repartition(int(met.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    cell = grid.bounds(F.col("cx"), F.col("cy"), F.col("level"))
    bits = P.piece_rows(met, cell)
    pairs = bits.groupBy("s", "t").agg(
        F.bit_or("bits").alias("bits"), F.max("s_area").alias("s_area"), F.max("level").alias("level"), F.sum("s_on").alias("s_on"), F.sum("t_on").alias("t_on")
    )

    def has(mask: int) -> Column:
        return F.col("bits").bitwiseAND(mask) != 0

    inner = has(P.IN | P.SAME | P.OTHER_IN | P.BOTH)
    if predicate == "intersects":
        return pairs.filter(has(P.TOUCH)).select("s", "t")
    if predicate == INTERIORS:
        return pairs.filter(inner).select("s", "t")
    if predicate == "touches":
        return pairs.filter(has(P.TOUCH) & ~inner).select("s", "t")
    # Cells in which a geometry has edges: if not all of them are among those that met, the rest lies outside the other.
    for name, layout in zip("st", layouts, strict=True):
        counts = layout.filter(F.size(f"{name}_edges") > 0).groupBy(name, "level").agg(F.count("*").alias(f"{name}_all"))
        pairs = pairs.join(counts, [name, "level"])
    s_out = has(P.OUT) | (F.col("s_on") < F.col("s_all"))
    t_out = has(P.OTHER_OUT) | (F.col("t_on") < F.col("t_all"))
    beyond = s_out | (F.col("s_area") & has(P.OTHER_IN | P.OPPOSITE))
    missing = t_out | has(P.IN | P.OPPOSITE)
    wanted = {
        "within": inner & ~beyond,
        "contains": F.col("s_area") & inner & ~missing,
        "overlaps": F.col("s_area") & inner & beyond & missing,
        "crosses": ~F.col("s_area") & inner & s_out,
    }[predicate]
    return pairs.filter(wanted).select("s", "t")
