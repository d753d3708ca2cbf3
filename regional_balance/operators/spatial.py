"""Spatial operators as equi-joins on grid cells with an exact residual test, and edge-based aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regional_balance import schema as S
from regional_balance.functions import geometry as G
from regional_balance.functions import names as N
from regional_balance.functions import planar as P
from regional_balance.operators.arrange import geometry_name, with_problem
from regional_balance.operators.cells import INTERIORS, PREDICATES, Grid, laid_out, related


BROADCAST_BYTES = 128 * 1024 * 1024
_EDGE_BYTES, _CELL_BYTES = 48, 200


def to_crs(df: DataFrame, srid: int = S.SRID_WORKING, geometry: str = "geometry") -> DataFrame:
    return df.withColumn(geometry, G.reproject(F.col(geometry), srid))


def drop_missing_geometry(df: DataFrame, geometry: str = "geometry") -> DataFrame:
    return df.filter(F.col(geometry).isNotNull())


def repair_geometry(df: DataFrame, geometry: str = "geometry", drop_crossing: bool = False) -> DataFrame:
    """Close and orient rings and drop geometries that are still unusable; with ``drop_crossing`` also outlines that cross,
    overlap or touch themselves."""
    fixed = df.withColumn(geometry, G.close_rings(F.col(geometry)))
    if not drop_crossing:
        return fixed.filter(G.problem(F.col(geometry)).isNull())
    return with_problem(fixed, geometry, "_problem").filter(F.col("_problem").isNull()).select(*df.columns)


def audit_geometry(df: DataFrame, geometry: str = "geometry", by: Sequence[str] = ()) -> DataFrame:
    """(by..., problem, n) over all geometries; usable ones count as ``ok``. Areas are also looked through for edges that
    cross, overlap or touch each other (see ``arrange.self_contacts``)."""
    why = F.coalesce("_problem", F.lit("ok")).alias("problem")
    return with_problem(df.select(*by, geometry), geometry, "_problem").select(*by, why).groupBy(*by, "problem").agg(F.count("*").alias("n"))


def layer_profile(targets: DataFrame, grid: Grid, geometry: str = "geometry") -> tuple[list[int], int]:
    """Levels of a layer and an upper bound, in bytes, of its cells: every edge in every cell of its own box, and every
    cell of a region's box.

    One aggregate over the layer and one row back; there are few levels (eight-fold steps of size).
    """
    g, level = F.col(geometry), F.col("level")

    def cells(box: Column) -> Column:
        across = grid.cell(box["x2"], level) - grid.cell(box["x1"], level) + 1
        return across * (grid.cell(box["y2"], level) - grid.cell(box["y1"], level) + 1)

    def box_of(e: Column) -> Column:
        sides = {f"{c}{k}": f(e[f"{c}1"], e[f"{c}2"]) for c in "xy" for k, f in ((1, F.least), (2, F.greatest))}
        return F.struct(*[v.alias(n) for n, v in sides.items()])

    sized = targets.filter(g.isNotNull()).select(G.part_boxes(g).alias("b"), G.edges(g).alias("e"), grid.level_of(g).alias("level"))

    def added(items: str, each) -> Column:
        return F.aggregate(F.transform(items, each), F.lit(0).cast("decimal(38,0)"), lambda s, v: (s + v).cast("decimal(38,0)"))

    held = added("e", lambda e: cells(box_of(e)) * _EDGE_BYTES) + added("b", lambda b: cells(b) * _CELL_BYTES)
    row = sized.agg(F.collect_set("level").alias("levels"), F.sum(held).alias("bytes")).first()
    return sorted(row["levels"]), int(row["bytes"] or 0)


def region_cells(targets: DataFrame, grid: Grid, target_id: str, geometry: str = "geometry", attributes: Sequence[str] = ()) -> DataFrame:
    """One row per target and covered cell: ``_tid``, the target's box ``_tb``, its level ``_town``, ``_cx``, ``_cy``, the
    edges ``_te`` that meet the cell, whether its centre is inside (``_middle``), and ``attributes`` in the struct ``_also``.

    A cell that no edge passes lies wholly inside or outside: ``_inside`` answers for all its points, and cells
    outside are dropped.
    """
    g = F.col(geometry)
    also = F.struct(*[N.quoted(c) for c in attributes]) if attributes else F.lit(0)
    rows = targets.filter(g.isNotNull()).select(F.col(target_id).alias("_tid"), also.alias("_also"), g.alias("_g"), geometry_name(geometry).alias("_name"))
    # Equal rows are laid out once and counted, so that they come back as often as they are there.
    rows = rows.groupBy("_tid", "_name", F.xxhash64("_also").alias("_hash"))
    rows = rows.agg(F.first("_g").alias("_g"), F.first("_also").alias("_also"), F.count("*").cast("int").alias("_n"))
    rows = rows.withColumns({"_tb": G.bbox(F.col("_g")), "_town": grid.level_of(F.col("_g"))}).withColumn("_on", F.array("_town"))
    cells = laid_out(rows, grid, ["_tid", "_name", "_hash"], "_g", "_on", ["_also", "_tb", "_town", "_n"])
    cells = cells.withColumnsRenamed({"cx": "_cx", "cy": "_cy", "edges": "_te", "middle": "_middle"})
    cells = cells.withColumn("_n", F.explode(F.array_repeat(F.lit(0), F.col("_n")))).drop("level", "_name", "_hash", "_n")
    centre = {f"_m{c}": grid.centre(F.col(f"_c{c}"), F.col("_town")) for c in "xy"}
    return cells.withColumns({"_inside": F.when(F.size("_te") == 0, F.lit(True)), **centre})


def spatial_join(
    source: DataFrame,
    target: DataFrame,
    target_id: str = "region_id",
    how: str = "left",
    cell_size: float | None = None,
    geometry: str = "geometry",
    source_id: str | None = None,
    srid: int = S.SRID_WORKING,
    broadcast_bytes: int = BROADCAST_BYTES,
    predicate: str = "intersects",
    attributes: Sequence[str] | None = None,
    suffix: str = "_target",
) -> DataFrame:
    """Join source geometries to the target regions for which ``predicate`` holds; by default those they intersect, boundary
    contact included.

    Targets are areas. Sources are points, lines and areas in any mixture, also of several parts. The predicates have their
    usual meaning: ``within`` (the source lies in the target and not only on its outline), ``contains``, ``touches`` (they share
    outline only), ``overlaps`` (areas, either with a part outside the other), ``crosses`` (lines and multipoints, partly inside).
    ``attributes`` are further columns of the target to bring; one that the source has too gets ``suffix``.

    An equi-join on grid cells finds what meets and what happens in the cells decides. For single points the cells of the
    regions are broadcast if a bound on their size, computed from the layer, is at most ``broadcast_bytes``; points then do not move
    at all. Otherwise both sides are shuffled by cell and adaptive execution splits a crowded one. Other sources are
    told apart by their geometry, equal ones are compared once (``source_id`` is not needed and kept for callers that have one).

    ``left`` keeps unmatched sources with a missing target id, ``right`` keeps unmatched targets.
    """
    if how not in ("left", "right", "inner"):
        raise ValueError(f"how must be left, right or inner, not {how!r}")
    if predicate not in PREDICATES:
        raise ValueError(f"predicate must be one of {PREDICATES}, not {predicate!r}")
    S.require(source, geometry, what="source")
    S.require(target, target_id, geometry, *(attributes or ()), what="target")
    source = to_crs(N.drop_present(source, target_id) if target_id != source_id else source, srid, geometry)
    taken = {c.lower() for c in source.columns}
    brought = {c: c + suffix if c.lower() in taken else c for c in attributes or () if c not in (target_id, geometry)}
    regions = to_crs(target.select(target_id, geometry, *brought), srid, geometry).withColumnsRenamed(brought)
    also = list(brought.values())
    grid = Grid(cell_size)
    levels, size = layer_profile(regions, grid, geometry)
    extended = F.coalesce(~G.is_point(F.col(geometry)), F.lit(False))
    shapes = source.filter(extended)
    if shapes.isEmpty():
        joined = _join_points(source, regions, target_id, how, grid, geometry, levels, size <= broadcast_bytes, predicate, also)
    else:
        points = _join_points(source.filter(~extended), regions, target_id, how, grid, geometry, levels, size <= broadcast_bytes, predicate, also)
        joined = points.unionByName(_join_shapes(shapes, regions, target_id, how, grid, geometry, predicate, also))
    return _with_unmatched_targets(joined, regions, target_id, also) if how == "right" else joined


def _join_points(source, regions, target_id, how, grid, geometry, levels, small, predicate, also):
    """A point has one cell per level and a target covers a cell of its level once, so no pair comes twice."""
    columns = source.columns
    cells = region_cells(regions, grid, target_id, geometry, also).withColumnRenamed("_tid", target_id)
    if small:
        cells = F.broadcast(cells)
    points = source.withColumns({"_x": G.point_x(F.col(geometry)), "_y": G.point_y(F.col(geometry))})
    one_level = len(levels) <= 1
    level = F.lit(levels[0] if levels else 0) if one_level else F.explode(F.array(*[F.lit(v) for v in levels]))
    probes = points.withColumn("_level", level)
    probes = probes.withColumns({c: grid.cell(F.col(v), F.col("_level")) for c, v in (("_px", "_x"), ("_py", "_y"))})
    x, y, edges = F.col("_x"), F.col("_y"), F.col("_te")
    cell = P.Centre(F.col("_mx"), F.col("_my"))
    on = F.exists(edges, lambda e: G.on_edge(x, y, e))
    held = {
        "intersects": F.coalesce(F.col("_inside"), P.covers(edges, F.col("_middle"), x, y, cell)),
        "within": F.coalesce(F.col("_inside"), ~on & P.inside(edges, F.col("_middle"), x, y, cell)),
        "touches": F.col("_inside").isNull() & on,
    }.get(predicate, F.lit(False))
    hit = (
        (F.col("_level") == F.col("_town"))
        & (F.col("_px") == F.col("_cx"))
        & (F.col("_py") == F.col("_cy"))
        & x.between(F.col("_tb.x1"), F.col("_tb.x2"))
        & y.between(F.col("_tb.y1"), F.col("_tb.y2"))
        & held
    )
    out = [*columns, target_id, *[F.col("_also")[c].alias(c) for c in also]]
    if how == "left" and one_level:
        return probes.join(cells, hit, "left").select(*out)
    matched = probes.join(cells, hit, "inner")
    if how != "left":
        return matched.select(*out)
    # Whether a point is matched depends on its place only, so places tell the unmatched rows without row ids.
    alone = points.join(matched.select("_x", "_y").distinct(), ["_x", "_y"], "left_anti")
    return matched.select(*out).unionByName(alone.select(*columns), allowMissingColumns=True)


def _join_shapes(source, regions, target_id, how, grid, geometry, predicate, also):
    """Relations depend on geometries alone: each different one is laid out once, and rows are joined to the pairs."""
    named = source.withColumn("_s", geometry_name(geometry))
    targets = regions.withColumn("_t", geometry_name(geometry))
    shapes = [df.select(F.col(c).alias(c[1]), F.col(geometry).alias("geometry")) for df, c in ((named, "_s"), (targets, "_t"))]
    one = [df.groupBy(c).agg(F.first("geometry").alias("geometry")) for df, c in zip(shapes, "st", strict=True)]
    pairs = related(*one, grid, predicate).withColumnsRenamed({"s": "_s", "t": "_t"})
    found = pairs.join(targets.drop(geometry), "_t").drop("_t")
    joined = named.join(found, "_s", "left" if how == "left" else "inner")
    return joined.select(*source.columns, target_id, *also)


def _with_unmatched_targets(matched: DataFrame, regions: DataFrame, target_id: str, also: Sequence[str] = ()) -> DataFrame:
    seen = matched.select(target_id).distinct()
    alone = regions.select(target_id, *also).join(seen, target_id, "left_anti")
    return matched.unionByName(alone, allowMissingColumns=True)


def assign_regions(
    facilities: DataFrame,
    boundaries: DataFrame,
    assign: str = "all",
    region: str = "region_id",
    **options,
) -> DataFrame:
    """Facilities with the region they lie in, unmatched ones dropped.

    A facility on a shared edge belongs to each of its regions and is repeated; ``first`` gives it the smallest
    region id only and needs a ``facility_id``.
    """
    joined = spatial_join(facilities, boundaries, region, "inner", **options)
    if assign == "all":
        return joined
    if assign != "first":
        raise ValueError(f"assign must be 'all' or 'first', not {assign!r}")
    S.require(facilities, "facility_id", "geometry", what="facilities")
    # Per facility and place, so that an id that occurs at several places keeps all of them.
    place = [F.col("facility_id"), G.point_x(F.col("geometry")).alias("_x"), G.point_y(F.col("geometry")).alias("_y")]
    keyed = joined.select("*", *place[1:])
    firsts = joined.groupBy(*place).agg(F.min(region).alias(region))
    return keyed.join(firsts, ["facility_id", "_x", "_y", region], "left_semi").select(*joined.columns)


def total_area(df: DataFrame, geometry: str = "geometry", by: Sequence[str] = ()) -> DataFrame:
    """Area of a coverage without overlaps, in the geometries' CRS: (by..., area). ``arrange.union_area`` counts places under several parts once."""
    return df.groupBy(*by).agg(F.coalesce(F.sum(G.area(F.col(geometry))), F.lit(0.0)).alias("area"))


def dissolve_attributes(
    df: DataFrame,
    region: str,
    order: Sequence[str],
    attributes: Sequence[str] | None = None,
    geometry: str = "geometry",
) -> DataFrame:
    """One row per region: first attribute values by ``order``, number of parts, area and bounding box."""
    if attributes is None:
        attributes = [c for c in df.columns if c not in (region, geometry)]
    b = G.bbox(F.col(geometry))
    first = [F.min_by(c, F.when(F.col(c).isNotNull(), F.struct(*order))).alias(c) for c in attributes]
    return df.groupBy(region).agg(
        *first,
        F.count(geometry).alias("parts"),
        F.coalesce(F.sum(G.area(F.col(geometry))), F.lit(0.0)).alias("area"),
        F.struct(
            F.min(b["x1"]).alias("x1"), F.min(b["y1"]).alias("y1"), F.max(b["x2"]).alias("x2"), F.max(b["y2"]).alias("y2")
        ).alias("bbox"),
    )


def dissolve_outline(df: DataFrame, region: str, geometry: str = "geometry") -> DataFrame:
    """Outline of each region, one row per edge: (region, x1, y1, x2, y2).

    For a coverage whose neighbours share vertices: an edge inside a region belongs to two of its parts and
    cancels. Edges are rows throughout, so a region of any size is spread over the cluster.
    """
    e = df.filter(F.col(geometry).isNotNull()).select(region, F.explode(G.edges(F.col(geometry))).alias("e"))
    forward = (F.col("e.x1") < F.col("e.x2")) | ((F.col("e.x1") == F.col("e.x2")) & (F.col("e.y1") <= F.col("e.y2")))

    def pick(a: str, b: str) -> Column:
        return F.when(forward, F.col(f"e.{a}")).otherwise(F.col(f"e.{b}"))

    canonical = e.select(
        region, pick("x1", "x2").alias("x1"), pick("y1", "y2").alias("y1"), pick("x2", "x1").alias("x2"), pick("y2", "y1").alias("y2")
    )
    counted = canonical.groupBy(region, "x1", "y1", "x2", "y2").agg(F.count("*").alias("n"))
    return counted.filter(F.col("n") % 2 == 1).drop("n")


def overlapping_parts(
    df: DataFrame, part_id: str, geometry: str = "geometry", cell_size: float | None = None, srid: int = S.SRID_WORKING, touching: bool = True
) -> DataFrame:
    """Pairs of parts that meet: (part_id, other), the smaller id first. Neighbours that only share an edge or a corner are
    among them unless ``touching`` is false: then only parts whose interiors overlap."""
    S.require(df, part_id, geometry, what="parts")
    parts = to_crs(df.select(part_id, geometry), srid, geometry).withColumnRenamed(geometry, "geometry")
    sides = [parts.select(F.col(part_id).alias(c), "geometry").dropDuplicates([c]) for c in "st"]
    pairs = related(*sides, Grid(cell_size), "intersects" if touching else INTERIORS, ordered=True)
    return pairs.select(F.col("s").alias(part_id), F.col("t").alias("other"))
