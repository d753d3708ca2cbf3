"""What needs the edges of many geometries compared with each other: the area that they cover together, and outlines that
cross or touch themselves."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regional_balance.functions import geometry as G
from regional_balance.functions import planar as P
from regional_balance.operators.cells import CELL_EDGES, Grid, edge_cells, laid_out

#: Cells across the largest geometry at most, so that it is not cut up by the size of the small ones.
MOST_ACROSS = 2048

#: What can be wrong with an outline's own edges, worst first.
CROSSING, OVERLAPPING, SPIKE, TOUCHING = "self-intersection", "overlapping edges", "spike", "touching ring"
_REASONS = (CROSSING, OVERLAPPING, SPIKE, TOUCHING)


def geometry_name(geometry: str) -> Column:
    """128 bits that stand for a geometry."""
    return F.struct(F.xxhash64(geometry).alias("a"), F.xxhash64(F.lit(1), geometry).alias("b"))


def _typical_side(shapes: DataFrame, geometry: str) -> Column:
    """Side of cells in which a typical outline of the layer has some ``CELL_EDGES`` edges, as a scalar subquery."""
    g = F.col(geometry)
    extents = F.transform(G.part_boxes(g), lambda b: F.greatest(b["x2"] - b["x1"], b["y2"] - b["y1"]))
    spaced = F.array_max(extents) / F.sqrt(F.greatest(F.size(G.vertices(g)) / F.lit(float(CELL_EDGES)), F.lit(1.0)))
    sizes = shapes.select(spaced.alias("spaced"), F.array_max(extents).alias("extent"))
    side = F.greatest(F.percentile_approx("spaced", 0.5), F.max("extent") / MOST_ACROSS, F.lit(1e-9))
    return sizes.agg(F.coalesce(side, F.lit(1.0)).alias("side")).scalar()


def _crossings(e: Column, f: Column) -> Column:
    """x where two edges cross, null if they do not or run side by side."""
    dx, dy, fx, fy = e["x2"] - e["x1"], e["y2"] - e["y1"], f["x2"] - f["x1"], f["y2"] - f["y1"]
    by = dx * fy - dy * fx
    ox, oy = f["x1"] - e["x1"], f["y1"] - e["y1"]

    def met(by: Column) -> Column:
        safe = F.when(by != 0, by).otherwise(F.lit(1.0))
        t, u = (ox * fy - oy * fx) / safe, (ox * dy - oy * dx) / safe
        return F.when((by != 0) & t.between(0, 1) & u.between(0, 1), e["x1"] + t * dx)

    return G.once(by, met)


def _at(e: Column, x: Column) -> Column:
    """y of an edge at an x that it spans."""
    step = e["x2"] - e["x1"]
    return e["y1"] + (x - e["x1"]) * (e["y2"] - e["y1"]) / F.when(step != 0, step).otherwise(F.lit(1.0))


def covered_area(shapes: Column, cell: P.Cell) -> Column:
    """Area that shapes (array of edges and whether the centre is inside) cover of a cell, overlaps counted once.

    The cell is cut into slabs where an edge ends, two edges cross or one leaves the cell above or below. Within a slab what
    is covered of a vertical line changes linearly, so its length in the middle times the slab's width is the area.
    """
    corner = lambda a, b: F.struct(a[0].alias("x1"), a[1].alias("y1"), b[0].alias("x2"), b[1].alias("y2"))
    sides = F.array(*[corner((cell.x1, y), (cell.x2, y)) for y in (cell.y1, cell.y2)])

    def cuts_of(edges: Column) -> Column:
        meet = G.once(F.concat(edges, sides), lambda others: F.flatten(F.transform(edges, lambda e: F.transform(others, lambda f: _crossings(e, f)))))
        ends = F.flatten(F.transform(edges, lambda e: F.array(e["x1"], e["x2"])))
        cuts = F.filter(F.concat(ends, meet), lambda x: (x > cell.x1) & (x < cell.x2))
        return F.array_sort(F.array_distinct(F.concat(F.array(cell.x1, cell.x2), cuts)))

    def slabs_of(cuts: Column) -> Column:
        n = F.size(cuts) - 1
        slab = lambda a, b: F.struct((b - a).alias("wide"), ((a + b) / 2).alias("x"))
        return F.zip_with(F.slice(cuts, F.lit(1), n), F.slice(cuts, F.lit(2), n), slab)

    def runs(shape: Column, x: Column) -> Column:
        """The parts of the line at x that a shape covers, as (lo, hi)."""
        spanning = F.filter(shape["edges"], lambda e: (e["x1"] > x) != (e["x2"] > x))
        heights = F.array_sort(F.filter(F.transform(spanning, lambda e: _at(e, x)), lambda y: (y > cell.y1) & (y < cell.y2)))
        none = F.array().cast("array<double>")

        def at_bottom(heights: Column) -> Column:
            # Between the bottom and the first edge above it there is no edge that the place could lie on.
            first = F.coalesce(F.get(heights, F.lit(0)), cell.y2)
            return G.once((cell.y1 + first) / 2, lambda y: P.inside(shape["edges"], shape["middle"], x, y, cell))

        def bounds(heights: Column, bottom: Column) -> Column:
            top = bottom != (F.size(heights) % 2 == 1)
            return F.concat(F.when(bottom, F.array(cell.y1)).otherwise(none), heights, F.when(top, F.array(cell.y2)).otherwise(none))

        def pairs(bounds: Column) -> Column:
            firsts = F.filter(F.sequence(F.lit(0), F.greatest(F.size(bounds) - 1, F.lit(0))), lambda k: (k % 2 == 0) & (k + 1 < F.size(bounds)))
            return F.transform(firsts, lambda k: F.struct(bounds[k].alias("lo"), bounds[k + 1].alias("hi")))

        return G.once(heights, lambda h: G.once(G.once(at_bottom(h), lambda b: bounds(h, b)), pairs))

    def length(x: Column) -> Column:
        every = F.array_sort(F.flatten(F.transform(shapes, lambda s: runs(s, x))))
        start = F.struct(cell.y1.alias("end"), F.lit(0.0).alias("sum"))

        def add(acc: Column, r: Column) -> Column:
            more = F.greatest(r["hi"] - F.greatest(r["lo"], acc["end"]), F.lit(0.0))
            return F.struct(F.greatest(acc["end"], r["hi"]).alias("end"), (acc["sum"] + more).alias("sum"))

        return F.aggregate(every, start, add, lambda acc: acc["sum"])

    slabs = G.once(G.once(F.flatten(F.transform(shapes, lambda s: s["edges"])), cuts_of), slabs_of)
    parts = F.transform(slabs, lambda s: s["wide"] * length(s["x"]))
    return F.aggregate(parts, F.lit(0.0), lambda a, b: a + b)


def union_area(df: DataFrame, geometry: str = "geometry", by: Sequence[str] = (), cell_size: float | None = None) -> DataFrame:
    """(by..., area): what the areas cover together, in the units of their CRS; places under several count once.

    Areas are laid out on cells. A cell inside any of them is covered; in others the edges are arranged (``covered_area``).
    Equal geometries are laid out once. Points and lines have no area, a group without areas has 0. Cells fit the layer's
    typical outline unless ``cell_size`` is given; a cell's edges are compared with each other, so a layer that is very dense in places wants smaller ones.
    """
    g = F.col(geometry)
    groups = df.select(*by).distinct() if by else None
    shapes = df.filter(g.isNotNull() & G.is_area(g)).select(*by, g.alias("_g"), geometry_name(geometry).alias("_name"))
    shapes = shapes.groupBy(*by, "_name").agg(F.first("_g").alias("_g"))
    side = F.lit(float(cell_size)) if cell_size is not None else _typical_side(shapes, "_g")
    grid = Grid(F.col("_side"))
    cells = laid_out(shapes.withColumns({"_on": F.array(F.lit(0)), "_side": side}), grid, [*by, "_name"], "_g", "_on", ["_side"])
    whole = (F.size("edges") == 0) & F.col("middle")
    # A cell inside one area needs no edges of the others.
    held = F.when(~whole, F.struct("edges", "middle"))
    cells = cells.groupBy(*by, "level", "cx", "cy").agg(
        F.max(whole).alias("whole"), F.collect_list(held).alias("shapes"), F.first("_side").alias("_side")
    )
    bounds = grid.bounds(F.col("cx"), F.col("cy"), F.col("level"))
    size = grid.size(F.col("level"))
    areas = cells.withColumn("area", F.when(F.col("whole"), size * size).otherwise(covered_area(F.col("shapes"), bounds)))
    total = areas.groupBy(*by).agg(F.sum("area").alias("area"))
    if by:
        same = [groups[c].eqNullSafe(total[c]) for c in by]
        joined = groups.join(total, on=same, how="left")
        return joined.select(*[groups[c] for c in by], F.coalesce(total["area"], F.lit(0.0)).alias("area"))
    return total.select(F.coalesce("area", F.lit(0.0)).alias("area"))


def _own_edges(shapes: DataFrame, grid: Grid) -> DataFrame:
    """(_name, _level, part, ring, n, at, _e): every edge of every ring, repeated vertices left out."""
    g = F.col("_g")
    rows = shapes.withColumn("_level", grid.level_of(g)).select("_name", "_level", F.posexplode(g["polygons"]).alias("part", "_rings"))
    rows = rows.select("_name", "_level", "part", F.posexplode("_rings").alias("ring", "_v"))
    v = F.col("_v")
    rows = rows.withColumn("_v", F.filter(v, lambda p, i: (i == 0) | (p != F.get(v, i - 1))))
    rows = rows.withColumn("_v", G.ring_edges(F.col("_v")))
    return rows.select("_name", "_level", "part", "ring", F.size("_v").alias("n"), F.posexplode("_v").alias("at", "_e"))


def self_contacts(df: DataFrame, geometry: str = "geometry", grid: Grid = Grid()) -> DataFrame:
    """(_name, problem, x, y): for each area whose own edges meet where they should not, the worst kind and a place of it.

    ``self-intersection``: two edges cross; ``overlapping edges``: two run along each other; ``spike``: an edge turns back on the
    one before; ``touching ring``: a ring comes back to a point. Rings and parts may touch each other in points. ``_name`` is
    ``geometry_name``. Edges meet by grid cell, so the work is not all edges against all.
    """
    g = F.col(geometry)
    shapes = df.filter(g.isNotNull() & G.is_area(g)).select(geometry_name(geometry).alias("_name"), g.alias("_g"))
    shapes = shapes.groupBy("_name").agg(F.first("_g").alias("_g"))
    cells = edge_cells(_own_edges(shapes, grid), grid)
    keys = ["_name", "_level", "_cx", "_cy"]
    place = ["part", "ring", "at"]
    first = cells.select(*keys, "n", F.struct(*place).alias("p"), F.col("_e").alias("e"))
    second = cells.select(*keys, F.struct(*place).alias("q"), F.col("_e").alias("f"))
    met = first.join(second, keys).filter(F.col("p") < F.col("q"))
    p, q, e, f, n = (F.col(c) for c in ("p", "q", "e", "f", "n"))
    one_ring = (p["part"] == q["part"]) & (p["ring"] == q["ring"])
    after, around = one_ring & (q["at"] - p["at"] == 1), one_ring & (p["at"] == 0) & (q["at"] == n - 1)

    def turn(ax: Column, ay: Column, bx: Column, by: Column, cx: Column, cy: Column) -> Column:
        return F.signum((bx - ax) * (cy - ay) - (by - ay) * (cx - ax))

    def back(v: str, a: str, w: str, b: str) -> Column:
        """From their shared vertex (v of e, w of f) both edges go the same way."""
        ax, ay = e[f"x{a}"] - e[f"x{v}"], e[f"y{a}"] - e[f"y{v}"]
        bx, by = f[f"x{b}"] - f[f"x{w}"], f[f"y{b}"] - f[f"y{w}"]
        return (ax * by - ay * bx == 0) & (ax * bx + ay * by > 0)

    sides = [
        turn(e["x1"], e["y1"], e["x2"], e["y2"], f["x1"], f["y1"]) * turn(e["x1"], e["y1"], e["x2"], e["y2"], f["x2"], f["y2"]),
        turn(f["x1"], f["y1"], f["x2"], f["y2"], e["x1"], e["y1"]) * turn(f["x1"], f["y1"], f["x2"], f["y2"], e["x2"], e["y2"]),
    ]
    crossed = (sides[0] < 0) & (sides[1] < 0)
    level = (turn(e["x1"], e["y1"], e["x2"], e["y2"], f["x1"], f["y1"]) == 0) & (turn(e["x1"], e["y1"], e["x2"], e["y2"], f["x2"], f["y2"]) == 0)
    lengths = [
        F.least(F.greatest(e[f"{c}1"], e[f"{c}2"]), F.greatest(f[f"{c}1"], f[f"{c}2"])) - F.greatest(F.least(e[f"{c}1"], e[f"{c}2"]), F.least(f[f"{c}1"], f[f"{c}2"]))
        for c in "xy"
    ]
    along = level & (F.least(*lengths) >= 0) & (F.greatest(*lengths) > 0)
    kind = (
        F.when(after, F.when(back("2", "1", "1", "2"), 2))
        .when(around, F.when(back("1", "2", "2", "1"), 2))
        .when(crossed, 0)
        .when(along, 1)
        .when(one_ring & G.edges_meet(e, f), 3)
    )
    # A spike starts where the shorter of its two edges does.
    length = lambda g: F.hypot(g["x2"] - g["x1"], g["y2"] - g["y1"])
    shorter = length(e) <= length(f)
    foot = {
        c: F.when(after, F.when(shorter, e[f"{c}1"]).otherwise(f[f"{c}2"])).when(around, F.when(shorter, e[f"{c}2"]).otherwise(f[f"{c}1"])) for c in "xy"
    }
    x = F.coalesce(_crossings(e, f), foot["x"], F.greatest(F.least(e["x1"], e["x2"]), F.least(f["x1"], f["x2"])))
    y = F.when(crossed & (e["x1"] != e["x2"]), _at(e, x)).when(crossed, _at(f, x))
    y = F.coalesce(y, foot["y"], F.greatest(F.least(e["y1"], e["y2"]), F.least(f["y1"], f["y2"])))
    found = met.withColumn("kind", kind).filter(F.col("kind").isNotNull())
    worst = found.groupBy("_name").agg(F.min(F.struct("kind", x.alias("x"), y.alias("y"))).alias("w"))
    return worst.select("_name", F.array(*[F.lit(r) for r in _REASONS])[F.col("w.kind")].alias("problem"), "w.x", "w.y")


def with_problem(df: DataFrame, geometry: str = "geometry", out: str = "problem", grid: Grid = Grid()) -> DataFrame:
    """``df`` with ``out``, the first reason why a geometry is unusable (null for good ones), and ``out_x``, ``out_y``, a place
    where its outline meets itself."""
    base = G.problem(F.col(geometry))
    named = df.withColumns({"_base": base, "_key": geometry_name(geometry)})
    own = self_contacts(df, geometry, grid).withColumnsRenamed({"_name": "_key", "problem": "_own", "x": "_x", "y": "_y"})
    joined = named.join(own, "_key", "left")
    # An outline that crosses itself can have no area on balance; one with all vertices in a line has none whatever it does.
    use_own = F.col("_base").isNull() | ((F.col("_base") == "zero area") & (F.col("_own") == CROSSING))
    new = {
        out: F.when(use_own, F.col("_own")).otherwise(F.col("_base")),
        f"{out}_x": F.when(use_own, F.col("_x")),
        f"{out}_y": F.when(use_own, F.col("_y")),
    }
    return joined.withColumns(new).select(*df.columns, *new)
