"""Predicates of the spatial join against exact arithmetic without cells."""

import math
import random
from fractions import Fraction as Q

import pytest
from pyspark.sql import functions as F

from regional_balance.operators import cells as C
from regional_balance.operators import spatial as X
from tests.test_spatial import geom, layer, pairs, point, square

W = 3857


def edges(g):
    _, kind, parts = g
    rings = [r for p in parts for r in p]
    if "point" in kind:
        return [(Q(x), Q(y), Q(x), Q(y)) for r in rings for x, y in r]
    return [(*map(Q, a), *map(Q, b)) for r in rings for a, b in zip(r, r[1:])]


def on(e, x, y):
    x1, y1, x2, y2 = e
    return (x2 - x1) * (y - y1) == (x - x1) * (y2 - y1) and min(x1, x2) <= x <= max(x1, x2) and min(y1, y2) <= y <= max(y1, y2)


def odd_right(es, x, y):
    """Parity of the edges right of a place; the place itself lies just right of any edge through it."""
    n = 0
    for x1, y1, x2, y2 in es:
        if (y1 > y) != (y2 > y) and x1 + (y - y1) * (x2 - x1) / (y2 - y1) > x:
            n += 1
    return n % 2 == 1


def flipped(es):
    return [(y1, x1, y2, x2) for x1, y1, x2, y2 in es]


def facts(a, b, area_a):
    """Kinds of the pieces of a against the area b."""
    out = set()
    for e in a:
        x1, y1, x2, y2 = e
        if (x1, y1) == (x2, y2):
            out.add("on" if any(on(f, x1, y1) for f in b) else "in" if odd_right(b, x1, y1) else "out")
            continue
        dx, dy, cuts = x2 - x1, y2 - y1, {Q(0), Q(1)}
        along = lambda x, y: (x - x1) / dx if dx else (y - y1) / dy  # noqa: E731,B023
        for f in b:
            fx, fy = f[2] - f[0], f[3] - f[1]
            d = dx * fy - dy * fx
            if d:
                t = ((f[0] - x1) * fy - (f[1] - y1) * fx) / d
                u = ((f[0] - x1) * dy - (f[1] - y1) * dx) / d
                if 0 <= u <= 1:
                    cuts.add(t)
            elif dx * (f[1] - y1) == dy * (f[0] - x1):
                cuts |= {along(f[0], f[1]), along(f[2], f[3])}
        cuts = sorted(t for t in cuts if 0 <= t <= 1)
        for s, t in zip(cuts, cuts[1:]):
            x, y = x1 + (s + t) / 2 * dx, y1 + (s + t) / 2 * dy
            if not any(on(f, x, y) for f in b):
                out.add("in" if odd_right(b, x, y) else "out")
            elif not area_a:
                out.add("on")
            else:
                side = [odd_right(g, x, y) if dy else odd_right(flipped(g), y, x) for g in (a, b)]
                out.add("same" if side[0] == side[1] else "opposite")
    return out


def relations(s, t):
    a, b, area = edges(s), edges(t), "polygon" in s[1]
    forth = facts(a, b, area)
    back = facts(b, a, True) if area else set()
    met = any(on(f, *e[:2]) or on(f, *e[2:]) or on(e, *f[:2]) or on(e, *f[2:]) for e in a for f in b)
    inner = "in" in forth or "same" in forth or "in" in back
    beyond = "out" in forth or area and ("in" in back or "opposite" in forth)
    missing = "out" in back or "in" in forth or "opposite" in forth
    intersects = inner or met or bool(forth & {"on", "opposite"})
    out = {
        "intersects": intersects,
        "within": inner and not beyond,
        "contains": area and inner and not missing,
        "touches": intersects and not inner,
        "overlaps": area and inner and beyond and missing,
        "crosses": not area and inner and "out" in forth,
        C.INTERIORS: inner,
    }
    return {k for k, v in out.items() if v}


def star(rnd, cx, cy, size, n):
    """A simple ring through points of a lattice, in the order of their angles."""
    spots = {}
    for _ in range(n):
        dx, dy = rnd.randrange(-size, size + 1), rnd.randrange(-size, size + 1)
        if dx or dy:
            k = math.gcd(dx, dy)
            spots[(dx // k, dy // k)] = (dx, dy)
    if len(spots) < 3:
        return square(cx, cy)
    turns = sorted(spots, key=lambda d: math.atan2(d[1], d[0]))
    angles = [math.atan2(d[1], d[0]) for d in turns]
    gaps = [(b - a) % (2 * math.pi) for a, b in zip(angles, angles[1:] + angles[:1])]
    if max(gaps) >= math.pi - 1e-9:
        return square(cx, cy)
    ring = [(cx + spots[d][0], cy + spots[d][1]) for d in turns]
    return ring + ring[:1]


def shapes():
    rnd = random.Random(11)
    targets = [geom([square(0, 0, 6)]), geom([square(6, 0, 6)]), geom([square(0, 6, 6), square(2, 8, 2)]), geom([square(20, 20, 1)])]
    targets += [geom([star(rnd, rnd.randrange(14), rnd.randrange(14), rnd.choice([2, 4, 9]), 9)]) for _ in range(14)]
    targets.append((W, "multipolygon", [geom([square(0, 0, 2)])[2][0], geom([square(30, 30, 8), square(32, 32, 2)])[2][0]]))
    targets.append(geom([star(rnd, 6, 6, 40, 300)]))  # many edges: smaller cells
    sources = [*targets, geom([square(2, 8, 2)]), geom([square(1, 1, 2)]), geom([square(-9, -9, 99)]), geom([square(3, 0, 6)]), geom([square(12, 6, 1)])]
    sources += [geom([star(rnd, rnd.randrange(14), rnd.randrange(14), rnd.choice([1, 3, 7]), 7)]) for _ in range(14)]
    sources.append((W, "multipolygon", [geom([square(0, 0, 2)])[2][0], geom([square(90, 90)])[2][0]]))
    lines = [[(0, 0), (6, 0)], [(0, 0), (6, 6)], [(1, 1), (2, 5)], [(-5, 3), (30, 3)], [(6, 6), (9, 9)], [(6, -4), (6, 20)], [(2, 8), (4, 8), (4, 10)], [(3, 9), (3, 9.5)]]
    sources += [geom([p], "linestring") for p in lines]
    sources += [geom([[(rnd.randrange(20), rnd.randrange(20)) for _ in range(3)]], "linestring") for _ in range(8)]
    sources += [(W, "multipoint", [[[(float(x), float(y))]] for x, y in spots]) for spots in ([(1, 1), (50, 50)], [(0, 0), (2, 1)], [(0, 0), (0, 3)], [(3, 9)])]
    sources += [point(rnd.randrange(15), rnd.randrange(15)) for _ in range(25)] + [point(0.5, 0.5)]
    return sources, targets


@pytest.fixture(scope="module")
def related():
    sources, targets = shapes()
    return {(i, j): relations(s, t) for i, s in enumerate(sources) for j, t in enumerate(targets)}


@pytest.mark.parametrize("predicate, size", [*((p, None) for p in C.PREDICATES), ("within", 3.0), ("intersects", 3.0)])
def test_predicates_equal_exact_arithmetic(spark, related, predicate, size):
    sources, targets = shapes()
    src, tgt = layer(spark, list(enumerate(sources)), "sid int"), layer(spark, list(enumerate(targets)), "region_id int")
    got = pairs(X.spatial_join(src, tgt, how="inner", predicate=predicate, cell_size=size), "sid", "region_id")
    want = sorted((k for k, v in related.items() if predicate in v), key=str)
    assert got == want


def test_pairs_whose_interiors_overlap(spark, related):
    _, targets = shapes()
    parts = layer(spark, list(enumerate(targets)), "pid int")
    got = pairs(X.overlapping_parts(parts, "pid", touching=False), "pid", "other")
    assert got == sorted(((i, j) for (i, j), v in related.items() if i < j < len(targets) and i < len(targets) and C.INTERIORS in v), key=str)


def test_target_attributes_and_repeated_rows(spark):
    tgt = layer(spark, [("A", geom([square(0, 0)])), ("A", geom([square(0, 0)])), ("B", geom([square(5, 5)])), ("C", None)])
    tgt = tgt.withColumns({"name": F.lower("region_id"), "note": F.concat(F.lit("n"), "region_id")})
    src = layer(spark, [("p", point(0.5, 0.5)), ("a", geom([square(0.2, 0.2, 0.1)])), ("a", geom([square(0.2, 0.2, 0.1)])), ("none", None), ("far", point(9, 9))], "name string")
    left = X.spatial_join(src, tgt, attributes=["name", "note"])
    rows = pairs(left, "name", "region_id", "name_target", "note")
    assert rows == sorted([("p", "A", "a", "nA")] * 2 + [("a", "A", "a", "nA")] * 4 + [("far", None, None, None), ("none", None, None, None)], key=str)
    right = pairs(X.spatial_join(src, tgt, how="right", attributes=["note"]), "name", "region_id", "note")
    assert (None, "B", "nB") in right and (None, "C", "nC") in right and len(right) == 8
    with pytest.raises(ValueError):
        X.spatial_join(src, tgt, predicate="near")


def test_parts_far_apart_cost_what_they_cost_alone(spark):
    """The cells of a geometry of two parts are those of its parts, whatever lies between."""
    far = (W, "multipolygon", [geom([square(0, 0)])[2][0], geom([square(1000, 1000)])[2][0]])
    rows = layer(spark, [("far", far)])
    cells = X.region_cells(rows, X.Grid(), "region_id")
    assert cells.count() <= 8
    detailed = geom([[(round(50 * math.cos(k / 500 * math.pi), 6), round(50 * math.sin(k / 500 * math.pi), 6)) for k in range(1000)] + [(50.0, 0.0)]])
    cells = X.region_cells(layer(spark, [("round", detailed)]), X.Grid(), "region_id")
    assert cells.agg(F.max(F.size("_te"))).first()[0] <= 200 and cells.filter("_inside").count() > 0
