"""What holds within one grid cell: position of points and of pieces of edges against the edges of one geometry there.

A cell carries the edges of a geometry that meet it and whether its centre lies inside. A point's position follows from the
edges that a path to the centre crosses: along the point's height to the centre's vertical, then along that to the
centre. Ties are broken as if the centre's vertical lay a little to the right and every height a little higher still less,
so an edge through a corner of the path counts once.

All are column expressions over small arrays; ``e`` and ``f`` are edges (x1, y1, x2, y2).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regional_balance.functions import geometry as G

#: Cuts closer together than this share of an edge make no piece.
_SHORT = 1e-12

#: Bits of what a geometry's pieces do in a cell. ``IN``, ``OUT``: a piece lies in the other's interior or exterior.
#: ``SAME``: on its outline with the interiors on one side; ``OPPOSITE``: on it otherwise. ``OTHER_IN``, ``OTHER_OUT``: a piece of
#: the other lies in the geometry's interior or exterior. ``TOUCH``: a point is shared. ``BOTH``: the cell is interior to both.
IN, OUT, SAME, OPPOSITE, OTHER_IN, OTHER_OUT, TOUCH, BOTH = (1 << k for k in range(8))


@dataclass(frozen=True)
class Centre:
    cx: Column
    cy: Column


@dataclass(frozen=True)
class Cell:
    """Bounds and centre of a cell."""

    x1: Column
    y1: Column
    x2: Column
    y2: Column
    cx: Column
    cy: Column


def _odd(n: Column) -> Column:
    return n % 2 == 1


def _ahead(f: Column, px: Column, y: Column, cell: Cell | Centre) -> Column:
    """The path along height ``y`` from ``px`` to the centre's vertical crosses the edge."""
    spans = (f["y1"] > y) != (f["y2"] > y)
    at = f["x1"] + (y - f["y1"]) * (f["x2"] - f["x1"]) / F.when(spans, f["y2"] - f["y1"]).otherwise(F.lit(1.0))
    between = F.when(px < cell.cx, (at > px) & (at <= cell.cx)).otherwise((at > cell.cx) & (at <= px))
    return spans & between


def _aside(f: Column, y: Column, cell: Cell | Centre) -> Column:
    """The path along the centre's vertical from height ``y`` to the centre crosses the edge."""
    spans = (f["x1"] > cell.cx) != (f["x2"] > cell.cx)
    slope = (f["y2"] - f["y1"]) / F.when(spans, f["x2"] - f["x1"]).otherwise(F.lit(1.0))
    at = f["y1"] + (cell.cx - f["x1"]) * slope
    above = [(at > h) | ((at == h) & (slope > 0)) for h in (y, cell.cy)]
    return spans & (above[0] != above[1])


def inside(edges: Column, middle: Column, x: Column, y: Column, cell: Cell) -> Column:
    """A point of the cell that lies on no edge is inside the geometry; ``middle``: its centre is."""
    crossed = F.size(F.filter(edges, lambda f: _ahead(f, x, y, cell) != _aside(f, y, cell)))
    return middle != _odd(crossed)


def covers(edges: Column, middle: Column, x: Column, y: Column, cell: Cell) -> Column:
    """Closed test: a point on an edge counts."""
    return F.exists(edges, lambda f: G.on_edge(x, y, f)) | inside(edges, middle, x, y, cell)


def _cross(ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    return ax * by - ay * bx


def _along(e: Column, x: Column, y: Column) -> Column:
    """Share of an edge at which a point of its line lies."""
    dx, dy = e["x2"] - e["x1"], e["y2"] - e["y1"]
    wide = F.abs(dx) >= F.abs(dy)
    step = F.when(wide, dx).otherwise(dy)
    return F.when(wide, x - e["x1"]).otherwise(y - e["y1"]) / F.when(step != 0, step).otherwise(F.lit(1.0))


def _aligned(e: Column, f: Column) -> Column:
    """Both ends of ``f`` lie on the line of ``e``."""
    dx, dy = e["x2"] - e["x1"], e["y2"] - e["y1"]
    first = _cross(dx, dy, f["x1"] - e["x1"], f["y1"] - e["y1"])
    second = _cross(dx, dy, f["x2"] - e["x1"], f["y2"] - e["y1"])
    return (first == 0) & (second == 0)


def _meeting(e: Column, f: Column) -> Column:
    """struct<on, a, b>: where ``f`` cuts ``e``, as shares of ``e``; ``on`` if they share a line, and then from a to b."""
    dx, dy, fx, fy = e["x2"] - e["x1"], e["y2"] - e["y1"], f["x2"] - f["x1"], f["y2"] - f["y1"]
    by = _cross(dx, dy, fx, fy)
    ox, oy = f["x1"] - e["x1"], f["y1"] - e["y1"]
    safe = F.when(by != 0, by).otherwise(F.lit(1.0))
    t, u = _cross(ox, oy, fx, fy) / safe, _cross(ox, oy, dx, dy) / safe
    # Cuts a little beyond the end of f are taken as well: a cut too many makes one more piece and nothing else.
    hit = (by != 0) & (u >= -1e-9) & (u <= 1 + 1e-9)
    on = _aligned(e, f)
    ends = [_along(e, f["x1"], f["y1"]), _along(e, f["x2"], f["y2"])]
    a = F.when(on, F.least(*ends)).when(hit, t)
    b = F.when(on, F.greatest(*ends)).when(hit, t)
    return F.struct(on.alias("on"), a.alias("a"), b.alias("b"))


def _within(e: Column, cell: Cell) -> tuple[Column, Column]:
    """Shares of an edge between which it lies in the cell."""
    lows, highs = [F.lit(0.0)], [F.lit(1.0)]
    for axis, low, high in (("x", cell.x1, cell.x2), ("y", cell.y1, cell.y2)):
        step = e[f"{axis}2"] - e[f"{axis}1"]
        safe = F.when(step != 0, step).otherwise(F.lit(1.0))
        ends = [(bound - e[f"{axis}1"]) / safe for bound in (low, high)]
        lows.append(F.when(step != 0, F.least(*ends)).otherwise(F.lit(0.0)))
        highs.append(F.when(step != 0, F.greatest(*ends)).otherwise(F.lit(1.0)))
    return F.greatest(*lows), F.least(*highs)


def _beside(e: Column, x: Column, y: Column, edges: Column, middle: Column, cell: Cell) -> Column:
    """The place just right of a point of ``e`` (just above it, if ``e`` is level) is inside the geometry."""

    def crossed(f: Column) -> Column:
        level = e["y1"] == e["y2"]
        shared = (f["y1"] > y) != (f["y2"] > y)
        # Going left from just right of the point crosses the edges that lie along e; going right does not.
        ahead = F.when(~level & _aligned(e, f), shared & (x > cell.cx)).otherwise(_ahead(f, x, y, cell))
        return ahead != _aside(f, y, cell)

    return middle != _odd(F.size(F.filter(edges, crossed)))


def cuts(e: Column, meetings: Column, low: Column, high: Column) -> Column:
    """Ascending shares of an edge from ``low`` to ``high``, with those between at which it meets other edges."""
    ends = F.flatten(F.transform(meetings, lambda m: F.array(m["a"], m["b"])))
    return F.array_sort(F.concat(F.array(low, high), F.filter(ends, lambda t: (t > low) & (t < high))))


def meeting_edges(e: Column, other: Column) -> Column:
    """Array of struct<on, a, b>, one for each edge that cuts ``e`` or shares its line."""
    return F.filter(F.transform(other, lambda f: _meeting(e, f)), lambda m: m["a"].isNotNull())


def touched(e: Column, other: Column) -> Column:
    """An end of either lies on the other; of closed rings the first end of each edge is enough."""
    return F.exists(
        other,
        lambda f: G.on_edge(f["x1"], f["y1"], e) | G.on_edge(e["x1"], e["y1"], f) | G.on_edge(e["x2"], e["y2"], f),
    )


def piece_rows(met: DataFrame, cell: Cell) -> DataFrame:
    """(s, t, s_area, level, bits, s_on, t_on) from rows of two geometries in a cell: a row for each piece of each edge.

    ``met`` has (s, t, s_area, level, s_edges, s_middle, t_edges, t_middle); t is an area. The pieces of t's edges come as well
    if s is one. ``s_on`` and ``t_on`` say, on one row of each cell, whether the geometry has edges there.
    """
    bounds = {f"_{n}": getattr(cell, n) for n in ("x1", "y1", "x2", "y2", "cx", "cy")}
    fixed = ["s", "t", "s_area", "level", *bounds]
    forth = F.struct(
        F.lit(False).alias("back"), F.col("s_edges").alias("own"), F.col("s_middle").alias("own_middle"), F.col("s_area").alias("own_area"),
        F.col("t_edges").alias("other"), F.col("t_middle").alias("other_middle"),
    )
    back = F.struct(
        F.lit(True).alias("back"), F.col("t_edges").alias("own"), F.col("t_middle").alias("own_middle"), F.lit(True).alias("own_area"),
        F.col("s_edges").alias("other"), F.col("s_middle").alias("other_middle"),
    )
    ways = F.when(F.col("s_area") & (F.size("t_edges") > 0), F.array(forth, back)).otherwise(F.array(forth))
    rows = met.withColumns(bounds).select(*fixed, F.inline(ways))
    rows = rows.select("*", F.posexplode_outer("own").alias("at", "e"))
    e, other = F.col("e"), F.col("other")
    c = Cell(*[F.col(n) for n in bounds])
    low, high = _within(e, c)
    rows = rows.withColumns({"meetings": meeting_edges(e, other), "low": low, "high": high})
    point = (e["x1"] == e["x2"]) & (e["y1"] == e["y2"])
    shares = F.when(point, F.array(F.lit(0.0), F.lit(0.0))).when(F.col("low") < F.col("high"), cuts(e, F.col("meetings"), F.col("low"), F.col("high")))
    rows = rows.withColumns({"point": point, "shares": shares})
    n = F.size("shares") - 1
    parts = F.zip_with(F.slice("shares", F.lit(1), n), F.slice("shares", F.lit(2), n), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    rows = rows.select("*", F.posexplode_outer(F.filter(F.when(n > 0, parts), lambda p: F.col("point") | (p["b"] - p["a"] > _SHORT))).alias("nth", "p"))
    t = (F.col("p.a") + F.col("p.b")) / 2
    rows = rows.withColumns({"share": t, "x": e["x1"] + t * (e["x2"] - e["x1"]), "y": e["y1"] + t * (e["y2"] - e["y1"])})
    x, y, share = F.col("x"), F.col("y"), F.col("share")
    on = F.when(F.col("point"), F.exists(other, lambda f: G.on_edge(x, y, f))).otherwise(
        F.exists("meetings", lambda m: m["on"] & (m["a"] <= share) & (share <= m["b"]))
    )
    rows = rows.withColumn("on", on)
    beside = [_beside(e, x, y, edges, middle, c) for edges, middle in ((F.col("own"), F.col("own_middle")), (other, F.col("other_middle")))]
    bits = (
        F.when(F.col("p").isNull(), F.lit(0))
        .when(F.col("on"), F.when(F.col("own_area") & ~F.col("back") & (beside[0] == beside[1]), F.lit(SAME)).otherwise(F.lit(OPPOSITE)))
        .when(inside(other, F.col("other_middle"), x, y, c), F.lit(IN))
        .otherwise(F.lit(OUT))
    )
    rows = rows.withColumn("bits", bits)
    # Of the other's pieces only those off the outline tell anything new.
    turned = F.when(F.col("bits") == IN, F.lit(OTHER_IN)).when(F.col("bits") == OUT, F.lit(OTHER_OUT)).otherwise(F.lit(0))
    first = ~F.col("back") & (F.coalesce("at", F.lit(0)) == 0) & (F.coalesce("nth", F.lit(0)) == 0)
    both = first & F.col("e").isNull() & (F.size(other) == 0) & F.col("own_middle") & F.col("other_middle")
    shared = F.col("bits").isin(IN, SAME, OPPOSITE) | both | (e.isNotNull() & (F.coalesce("nth", F.lit(0)) == 0) & touched(e, other))
    every = F.when(F.col("back"), turned).otherwise(F.col("bits"))
    every = every.bitwiseOR(F.when(both, F.lit(BOTH)).otherwise(F.lit(0))).bitwiseOR(F.when(shared, F.lit(TOUCH)).otherwise(F.lit(0)))
    s_on = F.when(first & e.isNotNull(), 1).otherwise(0)
    t_on = F.when(first & (F.size(other) > 0), 1).otherwise(0)
    return rows.select("s", "t", "s_area", "level", every.alias("bits"), s_on.alias("s_on"), t_on.alias("t_on"))
