"""Covered area, outlines that meet themselves, and dissolved geometries."""

import math
import random

import pytest
from pyspark.sql import functions as F

from regional_balance.functions import geometry as G
from regional_balance.operators import arrange as A
from regional_balance.operators import rings as R
from regional_balance.operators import spatial as X
from tests.test_spatial import geom, inside, layer, pairs, square

W = 3857


def boxes_union(boxes):
    """Area under axis-parallel boxes, by compressed coordinates."""
    xs, ys = sorted({v for b in boxes for v in (b[0], b[2])}), sorted({v for b in boxes for v in (b[1], b[3])})
    return sum(
        (x2 - x1) * (y2 - y1)
        for x1, x2 in zip(xs, xs[1:])
        for y1, y2 in zip(ys, ys[1:])
        if any(b[0] <= x1 and x2 <= b[2] and b[1] <= y1 and y2 <= b[3] for b in boxes)
    )


def test_boxes_of_all_kinds(spark):
    rnd = random.Random(3)
    boxes = [(0, 0, 0.6, 1), (0, 0, 0.6, 1), (0.2, 0.2, 0.4, 0.4)]
    boxes += [(x, y, x + w, y + h) for x, y, w, h in ((rnd.uniform(0, 9), rnd.uniform(0, 9), rnd.uniform(0.1, 3), rnd.uniform(0.1, 3)) for _ in range(40))]
    boxes.append((5, 5, 60, 8))
    rows = [(k % 3, geom([[(a, b), (c, b), (c, d), (a, d), (a, b)]])) for k, (a, b, c, d) in enumerate(boxes)]
    df = layer(spark, [*rows, (7, None), (8, geom([[(1, 1), (2, 2)]], "linestring"))], "k int")
    for size in (None, 0.5, 7.0):
        assert A.union_area(df, cell_size=size).first().area == pytest.approx(boxes_union(boxes))
        got = {r.k: r.area for r in A.union_area(df, by=["k"], cell_size=size).collect()}
        want = {k: boxes_union([b for i, b in enumerate(boxes) if i % 3 == k]) for k in range(3)}
        assert got == pytest.approx({**want, 7: 0.0, 8: 0.0})
    two = layer(spark, [("a", geom([[(0, 0), (0.6, 0), (0.6, 1), (0, 1), (0, 0)]]))] * 2)
    assert A.union_area(two).first().area == pytest.approx(0.6)
    assert A.union_area(df.limit(0)).first().area == 0.0


def test_slanted_shapes_with_holes(spark):
    """Against counting lattice points and against areas known exactly."""
    rnd = random.Random(5)
    ring = lambda cx, cy, r, n, turn: [(cx + r * math.cos(turn + 2 * math.pi * k / n), cy + r * math.sin(turn + 2 * math.pi * k / n)) for k in range(n)]
    shapes = []
    for _ in range(12):
        cx, cy, r, n, turn = rnd.uniform(0, 8), rnd.uniform(0, 8), rnd.uniform(0.5, 3), rnd.randrange(3, 9), rnd.uniform(0, 6)
        outer, hole = ring(cx, cy, r, n, turn), ring(cx, cy, r / 3, n, turn + 1)
        shapes.append([outer + outer[:1], hole + hole[:1]] if rnd.random() < 0.5 else [outer + outer[:1]])
    df = layer(spark, [(k, geom(s)) for k, s in enumerate(shapes)], "k int")
    steps = [(-4 + 16 * (i + 0.5) / 200, -4 + 16 * (j + 0.5) / 200) for i in range(200) for j in range(200)]
    counted = sum(any(inside(s, x, y) for s in shapes) for x, y in steps) * (16 / 200) ** 2
    areas = [A.union_area(df, cell_size=c).first().area for c in (None, 1.0, 4.0)]
    assert areas[0] == pytest.approx(areas[1]) == pytest.approx(areas[2])
    assert areas[0] == pytest.approx(counted, rel=0.01)
    for s in shapes[:4]:
        one = layer(spark, [(0, geom(s)), (1, geom(s[::1]))], "k int")
        assert A.union_area(one).first().area == pytest.approx(one.select(G.area(F.col("geometry"))).first()[0])
    star = [(0, 0), (4, 4), (8, 0), (4, 9), (0, 0)]
    both = layer(spark, [(0, geom([star])), (1, geom([[(0, 0), (8, 0), (4, 4), (0, 0)]])), (2, geom([[(0, 0), (8, 0), (4, 9), (0, 0)]]))], "k int")
    assert A.union_area(both).first().area == pytest.approx(36.0)


BOW = [(0, 0), (2, 2), (2, 0), (0, 2), (0, 0)]
UNEVEN = [(0, 0), (4, 4), (4, 0), (0, 1), (0, 0)]


def test_outlines_that_meet_themselves(spark):
    many = [(math.cos(k / 300 * math.pi) * 50, math.sin(k / 300 * math.pi) * 50) for k in range(600)]
    knot = many[:100] + [(0.0, -60.0)] + many[100:]
    rows = [
        ("ok", geom([square(0, 0)])),
        ("hole", geom([square(0, 0, 9), square(2, 2, 3)])),
        ("hole in a corner", geom([square(0, 0, 9), [(0, 0), (3, 2), (2, 3), (0, 0)]])),
        ("bow", geom([BOW])),
        ("uneven bow", geom([UNEVEN])),
        ("spike", geom([[(0, 0), (4, 0), (4, 4), (7, 4), (4, 4), (0, 4), (0, 0)]])),
        ("spike at the start", geom([[(0, 0), (4, 0), (4, 4), (0, 4), (0, 0), (-3, 0), (0, 0)]])),
        ("touching", geom([[(0, 0), (4, 0), (4, 4), (2, 0), (0, 4), (0, 0)]])),
        ("pinched", geom([[(0, 0), (2, 2), (4, 0), (4, 4), (2, 2), (0, 4), (0, 0)]])),
        ("hole across", geom([square(0, 0, 4), square(3, 3, 4)])),
        ("hole on the edge", geom([square(0, 0, 4), square(0, 1, 1)])),
        ("parts beside", (W, "multipolygon", [geom([square(0, 0)])[2][0], geom([square(1, 0)])[2][0]])),
        ("parts in a corner", (W, "multipolygon", [geom([square(0, 0)])[2][0], geom([square(1, 1)])[2][0]])),
        ("round", geom([many + many[:1]])),
        ("knot", geom([knot + knot[:1]])),
        ("flat", geom([[(0, 0), (1, 1), (2, 2), (0, 0)]])),
        ("open", geom([square(0, 0)[:-1]])),
        ("twice", geom([[(0, 0), (0, 0), (4, 0), (4, 4), (4, 4), (0, 4), (0, 0)]])),
        ("line", geom([[(0, 0), (2, 2), (2, 0), (0, 2)]], "linestring")),
        ("none", None),
    ]
    df = layer(spark, rows)
    got = {r.region_id: r.problem for r in A.with_problem(df).collect()}
    crossing, along, spike, touching = A._REASONS
    bad = {"bow": crossing, "uneven bow": crossing, "spike": spike, "spike at the start": spike, "touching": touching, "pinched": touching}
    bad |= {"hole across": crossing, "hole on the edge": along, "parts beside": along, "knot": crossing}
    bad |= {"flat": "zero area", "open": "unclosed ring", "none": "no geometry"}
    assert got == {name: bad.get(name) for name, _ in rows}
    place = {r.region_id: (r.problem_x, r.problem_y) for r in A.with_problem(df).collect()}
    assert place["bow"] == (1.0, 1.0) and place["spike"] == (4.0, 4.0) and place["pinched"] == (2.0, 2.0) and place["ok"] == (None, None)
    audit = {r.problem: r.n for r in X.audit_geometry(df).collect()}
    assert audit[crossing] == 4 and audit[spike] == 2 and audit["ok"] == len(rows) - len(bad)
    kept = {r.region_id for r in X.repair_geometry(df, drop_crossing=True).collect()}
    assert kept == {name for name, _ in rows if got[name] is None or name == "open"}


def shape_of(g):
    """Rings as sets of directed edges, so that where a ring starts does not matter."""
    return {frozenset((tuple(a), tuple(b)) for a, b in zip(r, r[1:])) for p in g.polygons for r in p}


def test_dissolved_geometry(spark):
    cells = {"frame": [(x, y) for x in range(5) for y in range(5) if not (1 <= x <= 3 and 1 <= y <= 3)] + [(2, 2)], "core": [(1, 1), (1, 2), (1, 3), (2, 1), (2, 3), (3, 1), (3, 2), (3, 3)]}
    cells["corner"] = [(10, 10), (11, 11), (12, 10)]
    cells["row"] = [(x, 20) for x in range(70)]
    rows = [(name, i, geom([square(x, y)[:: 1 if i % 2 else -1]])) for name, spots in cells.items() for i, (x, y) in enumerate(spots)]
    from regional_balance.schema import GEOMETRY_TYPE

    df = spark.createDataFrame(rows, f"region_id string, pid int, geometry {GEOMETRY_TYPE}").repartition(5)
    whole = {r.region_id: r.geometry for r in R.dissolve_geometry(df, "region_id").collect()}
    g = whole["frame"]
    assert g.kind == "multipolygon" and sorted(len(p) for p in g.polygons) == [1, 2]
    assert whole["core"].kind == "polygon" and len(whole["core"].polygons[0]) == 2
    assert whole["corner"].kind == "multipolygon" and [len(p) for p in whole["corner"].polygons] == [1, 1, 1]
    assert whole["row"].kind == "polygon" and len(whole["row"].polygons[0][0]) == 143
    shapes = R.dissolve(df, "region_id", ["pid"])
    area = {r.region_id: r.a for r in shapes.select("region_id", G.area(F.col("geometry")).alias("a")).collect()}
    assert area == {name: float(len(spots)) for name, spots in cells.items()}
    assert A.with_problem(shapes.select("region_id", "geometry")).filter("problem is not null").isEmpty()
    # Points that lie in a part lie in the dissolved region, and in no other.
    points = [(f"{name} {x} {y}", (W, "point", [[[(x + 0.5, y + 0.5)]]])) for name, spots in cells.items() for x, y in spots]
    src = spark.createDataFrame(points, f"place string, geometry {GEOMETRY_TYPE}")
    joined = pairs(X.spatial_join(src, shapes, how="inner"), "place", "region_id")
    assert joined == sorted((p, p.split()[0]) for p, _ in points)
    outer = [r for p in g.polygons for r in p if len(r) > 13]
    assert all(len(set(map(tuple, r))) == len(r) - 1 for r in outer)


def test_dissolving_nothing(spark):
    assert R.dissolve_geometry(layer(spark, [("a", None)]), "region_id").count() == 0
    assert R.dissolve(layer(spark, [("a", None)]), "region_id", ["region_id"]).first().geometry is None


def test_cuts_of_a_cell_are_computed_once(spark, plan):
    df = layer(spark, [(1, geom([square(0, 0)]))], "k int")
    assert plan(A.union_area(df, cell_size=1.0)).count("array_distinct") == 1
