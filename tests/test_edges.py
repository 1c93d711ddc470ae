"""Kernels over flat edges, and the grid of edges, against plain versions in fractions."""

import math
import random
from fractions import Fraction

import pytest
from plan_text import plan_of
from pyspark.sql import functions as F

from parcelgrid import session
from parcelgrid.functions import edges as E
from parcelgrid.functions import ring as R
from parcelgrid.functions import simple as S
from parcelgrid.functions.box import BOX_FIELDS
from parcelgrid.operators import edge_grid, overlap
from parcelgrid.operators.nearest_ring import nearest_ring
from parcelgrid.operators.shared_area import areas_by_place, shared_areas, square

SHAPES = {
    "square": [[(0, 0), (6, 0), (6, 6), (0, 6)]],
    "ell": [[(0, 0), (9, 0), (9, 3), (3, 3), (3, 9), (0, 9)]],
    "triangle": [[(0, 0), (9, 0), (0, 9)]],
    "holed": [[(0, 0), (9, 0), (9, 9), (0, 9)], [(3, 3), (6, 3), (6, 6), (3, 6)]],
    "clockwise": [[(0, 9), (9, 9), (9, 0), (0, 0)], [(3, 3), (3, 6), (6, 6), (6, 3)]],
    "arrow": [[(0, 0), (8, 4), (0, 8), (3, 4)]],
    "comb": [[(0, 0), (11, 0), (11, 2), (9, 8), (8, 2), (6, 8), (5, 2), (3, 8), (2, 2), (0, 8)]],
}


def moved(rings, dx, dy):
    return [[(x + dx, y + dy) for x, y in (*r, r[0])] for r in rings]


def floats(rings):
    return rings and [[(float(x), float(y)) for x, y in r] for r in rings]


def frame(spark, rows, extra=""):
    rows = [(i, floats(rings), *more) for i, rings, *more in rows]
    schema = f"id int, rings {R.RINGS_TYPE}{extra}"
    return spark.createDataFrame(rows, schema)


def inside(rings, x, y):
    """Boundary included, in exact arithmetic."""
    x, y, odd = Fraction(x), Fraction(y), False
    for ring in rings:
        for (ax, ay), (bx, by) in zip(ring, ring[1:]):
            ax, ay, bx, by = map(Fraction, (ax, ay, bx, by))
            if (bx - ax) * (y - ay) == (by - ay) * (x - ax) and min(ax, bx) <= x <= max(ax, bx) and min(ay, by) <= y <= max(ay, by):
                return True
            if (ay <= y) != (by <= y) and ax + (y - ay) * (bx - ax) / (by - ay) < x:
                odd = not odd
    return odd


def strip_area(one, two):
    """Shared area of two polygons by vertical strips between all corners and crossings."""
    lines = [[(a, b) for r in rings for a, b in zip(r, r[1:]) if a[0] != b[0]] for rings in (one, two)]
    xs = {Fraction(p[0]) for rings in (one, two) for r in rings for p in r}
    both = lines[0] + lines[1]
    for (a, b) in both:
        for (c, d) in both:
            den = (b[0] - a[0]) * (d[1] - c[1]) - (b[1] - a[1]) * (d[0] - c[0])
            if den:
                t = Fraction((c[0] - a[0]) * (d[1] - c[1]) - (c[1] - a[1]) * (d[0] - c[0]), den)
                if 0 <= t <= 1:
                    xs.add(a[0] + t * (b[0] - a[0]))
    xs, total = sorted(xs), Fraction(0)
    height = lambda e, x: e[0][1] + Fraction(e[1][1] - e[0][1]) * (x - e[0][0]) / (e[1][0] - e[0][0])
    for left, right in zip(xs, xs[1:]):
        middle = (left + right) / 2
        bands = []
        for own in lines:
            at = sorted(height(e, middle) for e in own if min(e[0][0], e[1][0]) <= left and max(e[0][0], e[1][0]) >= right)
            bands.append(list(zip(at[::2], at[1::2])))
        total += (right - left) * sum(max(Fraction(0), min(h, k) - max(g, j)) for g, h in bands[0] for j, k in bands[1])
    return total


def test_shared_area_of_all_shapes(spark):
    rng = random.Random(3)
    pairs = []
    for a in SHAPES.values():
        for b in SHAPES.values():
            for _ in range(4):
                pairs.append((moved(a, 0, 0), moved(b, rng.randint(-8, 8), rng.randint(-8, 8))))
    rows = [(i, *p) for i, p in enumerate(pairs)] + [(-1, None, pairs[0][1]), (-2, pairs[0][0], [])]
    rows = [(i, floats(a), floats(b)) for i, a, b in rows]
    df = spark.createDataFrame(rows, f"id int, a {R.RINGS_TYPE}, b {R.RINGS_TYPE}").repartition(3)
    got = {r.id: r.area for r in df.select("id", E.intersection_area("a", "b").alias("area")).collect()}
    assert got[-1] is None and got[-2] == 0.0
    for i, (a, b) in enumerate(pairs):
        assert got[i] == pytest.approx(float(strip_area(a, b)), abs=1e-9)


def test_shared_area_in_small_steps_and_far_off(spark, monkeypatch):
    monkeypatch.setattr(E, "PAIRS_AT_ONCE", 7)
    import pyarrow as pa

    def column(rings):
        return pa.array([[[{"x": float(x), "y": float(y)} for x, y in r] for r in moved(s, d, d)] for s, d in rings])

    left = column([(SHAPES["comb"], 0), (SHAPES["holed"], 5e6)])
    right = column([(SHAPES["holed"], 1), (SHAPES["ell"], 5e6 + 1)])
    want = [strip_area(moved(SHAPES["comb"], 0, 0), moved(SHAPES["holed"], 1, 1)), strip_area(moved(SHAPES["holed"], 0, 0), moved(SHAPES["ell"], 1, 1))]
    assert E.shared_area(left, right).tolist() == pytest.approx([float(w) for w in want], rel=1e-9)


def test_distances(spark):
    rows = []
    for i, (name, rings) in enumerate(SHAPES.items()):
        own = moved(rings, 0, 0)
        rows += [(100 * i + k, own, float(x), float(y)) for k, (x, y) in enumerate([(4, 4), (4.5, 4.5), (-3, -4), (20, 5), (0, 0), (7, 7)])]
    rows += [(-1, None, 0.0, 0.0), (-2, moved(SHAPES["square"], 0, 0), None, 0.0)]
    df = frame(spark, rows, ", x double, y double")
    got = {r.id: r.d for r in df.select("id", E.distance_to_polygon("rings", "x", "y").alias("d")).collect()}
    assert got.pop(-1) is None and got.pop(-2) is None

    def apart(ring, x, y):
        best = math.inf
        for (ax, ay), (bx, by) in zip(ring, ring[1:]):
            t = max(0, min(1, ((x - ax) * (bx - ax) + (y - ay) * (by - ay)) / ((bx - ax) ** 2 + (by - ay) ** 2)))
            best = min(best, math.hypot(ax + t * (bx - ax) - x, ay + t * (by - ay) - y))
        return best

    for i, rings, x, y in rows[:-2]:
        want = 0.0 if inside(rings, x, y) else min(apart(r, x, y) for r in rings)
        assert got[i] == pytest.approx(want, abs=1e-12)


def star(rng, corners, radius):
    """A closed outline around (0, 0) with whole coordinates, spiky, each angle once."""
    out = []
    for k in range(corners):
        r, a = radius * rng.uniform(0.3, 1), 2 * math.pi * (k + 0.25) / corners
        out.append((round(r * math.cos(a)), round(r * math.sin(a))))
    return [[*out, out[0]]]


def test_points_in_rings_against_fractions(spark, monkeypatch):
    """Points on corners, edges and borders of cells, many of them, in all shapes and in spiky stars."""
    rng = random.Random(8)
    polygons = [(i, moved(s, 20 * i, 5 * i)) for i, s in enumerate(SHAPES.values())]
    polygons += [(50, moved([r[:-1] for r in star(rng, 300, 40)], 40, 20)), (60, None), (61, [])]
    spots = rng.sample([(float(x) / 2, float(y) / 2) for x in range(-10, 300) for y in range(-40, 130)], 8000)
    points = spark.createDataFrame([(k, x, y) for k, (x, y) in enumerate(spots)] + [(-1, None, 1.0), (-2, math.nan, 1.0)], "query_id int, x double, y double")
    df = frame(spark, polygons).withColumnRenamed("id", "field_id")
    want = set()
    for i, rings in polygons:
        if rings:
            xs, ys = [[p[c] for r in rings for p in r] for c in (0, 1)]
            want |= {
                (k, i)
                for k, (x, y) in enumerate(spots)
                if min(xs) <= x <= max(xs) and min(ys) <= y <= max(ys) and inside(rings, x, y)
            }
    got = [tuple(r) for r in edge_grid.points_in_rings(points, df).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_cells_stay_small_however_long_the_outline(spark):
    """Edges per cell do not grow with the ring, for a star and for a comb of 10,000 corners."""
    rng = random.Random(2)
    teeth = [p for k in range(2500) for p in ((4 * k, 0), (4 * k + 1, 9000), (4 * k + 2, 9000), (4 * k + 3, 0))]
    comb = [[*teeth, (10000, -50), (0, -50), teeth[0]]]
    for size in (1000, 10_000):
        rows = [(1, star(rng, size, 10**6))] + ([(2, comb)] if size == 10_000 else [])
        df = frame(spark, rows).withColumnRenamed("id", "field_id")
        _, cells = edge_grid.edge_cells(df)
        per_cell = cells.groupBy("poly_id").agg(F.avg(F.size("edges")), F.count("*")).collect()
        assert all(r[1] < 250 for r in per_cell) and max(r[2] for r in per_cell) >= size / 8


def test_nearest_ring_against_all_polygons(spark):
    """All shapes, copies, one inside the hole of another, ties, and a long outline; points without a position."""
    rng = random.Random(4)
    polygons = [(i, moved(s, 25 * i, 10 * (i % 3))) for i, s in enumerate(SHAPES.values())]
    polygons += [(20, polygons[3][1]), (21, moved(SHAPES["triangle"], 300, 300)), (22, moved([r[:-1] for r in star(rng, 200, 60)], 80, 120))]
    polygons += [(23, moved([[(0, 0), (1, 0), (1, 1), (0, 1)]], 79, 4)), (30, None), (31, [])]
    spots = [(float(rng.randint(-60, 340)), float(rng.randint(-60, 340))) for _ in range(250)] + [(78.0, 4.0), (79.5, 4.5), (0.0, 0.0)]
    rows = [(k, x, y) for k, (x, y) in enumerate(spots)] + [(900, None, 0.0), (901, math.nan, 0.0)]
    points = spark.createDataFrame(rows, "query_id int, x double, y double")
    df = frame(spark, polygons).withColumnRenamed("id", "field_id").cache()
    got = {r.query_id: (r.nearest_poly_id, r.distance_m) for r in nearest_ring(points, df).collect()}
    assert got.pop(900) == got.pop(901) == (None, math.inf)
    every = points.where("query_id < 900").crossJoin(df)
    d = E.distance_to_polygon("rings", "x", "y")
    want = every.withColumn("d", d).where("d is not null").groupBy("query_id").agg(F.min(F.struct(F.round("d", 9), "field_id")).alias("b")).collect()
    assert {r.query_id: r.b.field_id for r in want} == {k: v[0] for k, v in got.items()}
    assert all(got[r.query_id][1] == pytest.approx(r.b[0], abs=1e-8) for r in want)
    none = nearest_ring(points, df.where("field_id >= 30")).collect()
    assert len(none) == len(rows) and all(r.nearest_poly_id is None for r in none)


def plainly_simple(ring):
    """Every pair of edges in whole numbers."""
    points = [p for k, p in enumerate(ring) if k == 0 or p != ring[k - 1]]
    es = list(zip(points, points[1:]))
    turn = lambda a, b, c: (b[0] - a[0]) * (c[1] - a[1]) - (b[1] - a[1]) * (c[0] - a[0])
    within = lambda a, b, c: min(a[0], b[0]) <= c[0] <= max(a[0], b[0]) and min(a[1], b[1]) <= c[1] <= max(a[1], b[1])

    def meet(p, q):
        (a, b), (c, d) = p, q
        o = [turn(a, b, c), turn(a, b, d), turn(c, d, a), turn(c, d, b)]
        if (o[0] > 0) != (o[1] > 0) and (o[2] > 0) != (o[3] > 0) and all(o):
            return True
        return any(t == 0 and within(*s, r) for t, s, r in zip(o, (p, p, q, q), (c, d, a, b)))

    for i, (a, b) in enumerate(es):
        _, c = es[(i + 1) % len(es)]
        if turn(a, b, c) == 0 and (b[0] - a[0]) * (c[0] - b[0]) + (b[1] - a[1]) * (c[1] - b[1]) < 0:
            return False
        for j in range(i + 2, len(es)):
            if not (i == 0 and j == len(es) - 1) and meet(es[i], es[j]):
                return False
    return True


def arrow_rings(polygons):
    import pyarrow as pa

    point = pa.struct([("x", pa.float64()), ("y", pa.float64())])
    rows = [p and [[{"x": float(x), "y": float(y)} for x, y in r] for r in p] for p in polygons]
    return pa.array(rows, pa.list_(pa.list_(point)))


@pytest.mark.parametrize("short", [64, 3])
def test_simple_rings_against_all_pairs(monkeypatch, short):
    """Random rings on few whole coordinates, so that they touch, fold and repeat; with and without the grid."""
    monkeypatch.setattr(S, "SHORT", short)
    monkeypatch.setattr(S, "PAIRS_AT_ONCE", 50)
    rng = random.Random(5)
    polygons, want = [None, []], [True, True]
    for _ in range(600):
        corners = [(rng.randint(0, 9), rng.randint(0, 9)) for _ in range(rng.randint(3, 7))]
        if rng.random() < 0.3:
            corners.insert(1, corners[0])
        ring = [*corners, corners[0]]
        other = moved(SHAPES["comb"], 0, 0)[0]
        polygons.append([ring, other])
        want.append(plainly_simple(ring))
    polygons += [star(rng, 90, 500), [[(0, 0), (math.nan, 1), (2, 2), (0, 0)]]]
    want += [plainly_simple(polygons[-2][0]), True]
    assert S.simple_polygons(arrow_rings(polygons)).tolist() == want
    assert sum(want) > 50


def test_long_ring_is_checked_in_about_linear_time():
    import time

    angle = [2 * math.pi * k / 100_000 for k in range(100_000)]
    at = [(1 + 0.3 * math.sin(7 * a) + 0.05 * math.sin(300 * a), a) for a in angle]
    ring = [(round(10**9 * r * math.cos(a)), round(10**9 * r * math.sin(a))) for r, a in at]
    ring.append(ring[0])
    crossed = [*ring[:50_000], ring[50_001], ring[50_000], *ring[50_002:]]
    column = arrow_rings([[ring]])
    started = time.perf_counter()
    assert S.simple_polygons(column).tolist() == [True]
    assert time.perf_counter() - started < 4
    assert S.simple_polygons(arrow_rings([[crossed]])).tolist() == [False]


def test_a_comb_is_cut_between_its_teeth(spark):
    """Cells are long along the teeth, whichever way they point: an edge is listed a few times."""
    teeth = [p for k in range(2500) for p in ((4 * k, 0), (4 * k + 1, 9000), (4 * k + 2, 9000), (4 * k + 3, 0))]
    comb = [*teeth, (10000, -50), (0, -50), teeth[0]]
    df = frame(spark, [(1, [comb]), (2, [[(y, x) for x, y in comb]])]).withColumnRenamed("id", "field_id")
    _, cells = edge_grid.edge_cells(df)
    listed = cells.groupBy("poly_id").agg(F.sum(F.size("edges")).alias("n")).collect()
    assert len(listed) == 2 and all(r.n < 6 * len(comb) for r in listed)


def test_short_outlines_meet_points_by_place(spark):
    """Polygons of few edges are not joined a second time, pair by pair."""
    df = frame(spark, [(i, moved(SHAPES["triangle"], 9 * i, 0)) for i in range(20)]).withColumnRenamed("id", "field_id")
    points = spark.range(50).selectExpr("id AS query_id", "CAST(id AS DOUBLE) AS x", "1D AS y")
    plan = plan_of(edge_grid.points_in_rings(points, df))
    assert "FlatMapCoGroupsInArrow" in plan and "Join" not in plan


def test_outlines_are_never_broadcast(spark):
    df = frame(spark, [(1, SHAPES["triangle"])]).withColumnRenamed("id", "field_id")
    points = spark.range(5).selectExpr("id AS query_id", "CAST(id AS DOUBLE) AS x", "1D AS y")
    found = shared_areas(points, df, 1.0, square(1.0))
    assert "SortMergeJoin" in plan_of(found)


def test_corners_of_a_comb_are_told_fast():
    """Every border meets every edge that crosses it, and few of its corners one by one."""
    import time

    import numpy as np

    teeth = [p for k in range(10_000) for p in ((4 * k, 0), (4 * k + 1, 9000), (4 * k + 2, 9000), (4 * k + 3, 0))]
    ring = np.array([*teeth, (40_000, -50), (0, -50), teeth[0]], float)
    ends = ring[:-1, 0], ring[:-1, 1], ring[1:, 0], ring[1:, 1]
    edges = E.Edges(*ends, np.zeros(len(ring) - 1, int), np.ones(len(ring) - 1, int), 1)
    grid = E.Grid(0.0, -50.0, 4.01, 4525.0, 9970, 2)
    started = time.perf_counter()
    found = grid.corners_inside(edges)
    assert time.perf_counter() - started < 2
    for i in range(0, grid.nx, 199):
        for j, border in enumerate((-50.0, 4475.0)):
            over = edges.of(np.flatnonzero((np.minimum(edges.ay, edges.by) <= border) & (np.maximum(edges.ay, edges.by) > border)))
            corner = np.full(len(over.ax), 4.01 * i), np.full(len(over.ax), border)
            assert found[i, j] == (E.after(over, *corner).sum() % 2 == 1)


def test_cells_share_a_call_of_the_kernel(spark):
    """Points that are each alone in their cell do not cost a call each, nor a task."""
    df = frame(spark, [(i, moved(SHAPES["square"], 10_000 * i, 0)) for i in range(300)]).withColumnRenamed("id", "field_id")
    points = spark.range(3000).selectExpr("id AS query_id", "CAST(1000 * id AS DOUBLE) AS x", "1D AS y")
    listed = overlap.list_boxes(edge_grid.edge_cells(df)[1].select("poly_id", *BOX_FIELDS, "edges"), 0.0)
    left, right, keys = overlap.by_place(points, listed)
    assert left.select(*keys).distinct().count() <= 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    got = sorted(tuple(r) for r in edge_grid.points_in_rings(points, df).collect())
    assert got == [(10 * i, i) for i in range(300)]


def test_points_inside_look_for_no_outline(spark):
    """Only points outside all polygons meet stretches: what is written for them does not grow with those inside."""
    df = frame(spark, [(i, moved(SHAPES["square"], i, 0)) for i in range(40)]).withColumnRenamed("id", "field_id")
    inside = spark.range(400).selectExpr("id AS query_id", "CAST(id % 40 AS DOUBLE) AS x", "1D AS y")
    away = spark.createDataFrame([(900, -3.0, 2.0), (901, 49.0, 10.0), (902, None, 1.0)], "query_id long, x double, y double")

    def groups(points):
        """The points grouped for the search, and the answers."""
        with session.intermediates(spark):
            found = {r.query_id: (r.nearest_poly_id, r.distance_m) for r in nearest_ring(points, df).collect()}
            written = [p for p in session._written.paths if "/groups-" in p]
            return sum(spark.read.parquet(p).agg(F.sum("n")).first()[0] for p in written), found

    assert groups(inside) == (0, {k: (max(k % 40 - 6, 0), 0.0) for k in range(400)})
    found = {900: (0, 3.0), 901: (39, math.sqrt(32)), 902: (None, math.inf)}
    assert groups(inside.union(away)) == (2, {k: (max(k % 40 - 6, 0), 0.0) for k in range(400)} | found)


@pytest.mark.parametrize("pairs", [None, 40])
def test_points_in_polygons_against_every_pair(spark, monkeypatch, pairs):
    """Copies of an outline, holes, points on outlines, without a position and with one id; found in a kernel."""
    if pairs:
        monkeypatch.setattr(overlap, "PAIRS_WITH_COPIES", pairs)  # cells are dealt out
    rng = random.Random(8)
    polygons = [(i, moved(s, 4 * i, i % 3), f"p{i}") for i, s in enumerate(SHAPES.values())] * 3
    polygons = [(k, *rest) for k, (_, *rest) in enumerate(polygons)] + [(90, None, "none"), (91, [], None), (92, [[(1, 1)]], "spot")]
    df = frame(spark, polygons, ", name string").withColumnRenamed("id", "field_id")
    rows = [(k, float(rng.randint(-2, 40)), float(rng.randint(-2, 14)), f"s{k}") for k in range(300)]
    rows += [(7, 1.0, 1.0, "twice"), (None, 2.0, 2.0, None), (800, None, 1.0, "x"), (801, 1.0, math.nan, "y")]
    points = spark.createDataFrame(rows, "query_id int, x double, y double, tag string")
    want = points.crossJoin(df).where(R.contains_point(F.col("rings"), F.col("x"), F.col("y"))).collect()
    found = overlap.points_in_polygons(points, df)
    assert found.columns == [*points.columns, *df.columns]
    assert sorted(map(repr, found.collect())) == sorted(map(repr, want)) and len(want) > 300
    bare = overlap.points_in_polygons(points, df, outlines=False, how="left")
    assert bare.columns == [*points.columns, "field_id", "name"]
    pairs_of = lambda got: sorted(repr((r.query_id, r.tag, r.field_id)) for r in got)
    alone = [r.tag for r in overlap.points_in_polygons(points, df, how="anti").collect()]
    got = bare.collect()
    assert pairs_of(r for r in got if r.field_id is not None) == pairs_of(want)
    assert sorted(map(str, alone)) == sorted(str(r.tag) for r in got if r.field_id is None) and {"x", "y"} <= set(alone)
    plan = plan_of(overlap.points_in_polygons(points, df, outlines=False))
    assert "FlatMapCoGroupsInArrow" in plan and "BroadcastHashJoin" not in plan.split("FlatMapCoGroupsInArrow")[0]


@pytest.mark.parametrize("pairs", [None, 40])
def test_shared_areas_by_place_and_by_polygon(spark, monkeypatch, pairs):
    """Short outlines are not joined pair by pair; both ways give what every pair gives."""
    if pairs:
        monkeypatch.setattr(overlap, "PAIRS_PER_GROUP", pairs)
    rng = random.Random(9)
    polygons = [(i, moved(s, 5 * i, i % 3)) for i, s in enumerate(SHAPES.values())] + [(20, moved([r[:-1] for r in star(rng, 100, 9)], 9, 9)), (30, None), (31, [])]
    df = frame(spark, polygons).withColumnRenamed("id", "field_id")
    rows = [(k, rng.uniform(-3, 45), rng.uniform(-3, 14)) for k in range(120)] + [(900, None, 1.0), (901, 1.0, math.nan), (None, 3.0, 3.0)]
    points = spark.createDataFrame(rows, "query_id int, x double, y double")
    figure = square(2.5)
    found = {(r[0], r[1]): r[2] for r in shared_areas(points, df, 2.5, figure).collect()}
    every = points.where("x IS NOT NULL AND NOT isnan(y)").crossJoin(df.where("field_id < 30"))
    area = E.intersection_area(figure(F.col("x"), F.col("y")), F.col("rings"))
    want = {(r[0], r[1]): r[2] for r in every.select("query_id", "field_id", area.alias("a")).collect()}
    assert {k for k, v in want.items() if v > 1e-9} <= set(found) <= set(want) and (None, 0) in found
    assert all(v == pytest.approx(want[k], abs=1e-9) for k, v in found.items())
    assert any(i == 20 and v > 1 for (_, i), v in found.items())
    # ids that come twice give each extent with each outline, as a join by id does
    twice = shared_areas(points, df.union(df), 2.5, figure).groupBy("query_id", "field_id").count().collect()
    assert {(r[0], r[1]) for r in twice} == set(found) and {r[2] for r in twice} == {4}
    extent = df.where("field_id < 20").withColumn("extent", R.bounds_struct(F.col("rings"))).select(F.col("field_id").alias("poly_id"), "rings", "extent.*")
    plan = plan_of(areas_by_place(points.where("x > 0"), extent, 2.5, figure))
    assert "FlatMapCoGroupsInArrow" in plan and (pairs or "Join" not in plan)
