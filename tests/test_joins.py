"""Joins against brute force in numpy, on both the broadcast and the shuffle path."""

import math

import numpy as np
import pytest
from plan_text import plan_of
from pyspark.sql import functions as F

from parcelgrid import session
from parcelgrid.functions import box as B
from parcelgrid.functions import ring as R
from parcelgrid.operators import nearest, overlap, skew, spots
from parcelgrid.operators.nearest import build_pyramid, nearest_box
from parcelgrid.plans.zone_lookup import zone_lookup
from parcelgrid.sources import synthetic

BOXES = "field_id bigint, crop_type string, minx double, miny double, maxx double, maxy double"
POINTS = "query_id bigint, x double, y double"


def layouts():
    rng = np.random.default_rng(7)

    def boxes(x, y, w, h):
        return np.column_stack([x, y, x + w, y + h])

    n = 400
    even = boxes(*rng.uniform(0, 10_000, (2, n)), *rng.uniform(1, 60, (2, n)))
    # a third in one small spot, a third exact copies, the rest even, some huge
    spot = boxes(*(5000 + rng.uniform(0, 2, (2, n))), *rng.uniform(0.001, 0.01, (2, n)))
    copies = np.tile(np.array([[200.0, 200.0, 260.0, 230.0]]), (n, 1))
    huge = boxes(*rng.uniform(0, 4000, (2, 8)), *rng.uniform(3000, 6000, (2, 8)))
    flat = even.copy()
    flat[:, 2] = flat[:, 0]
    grid = np.array([(x, y, x + 10.0, y + 10.0) for x in range(0, 400, 20) for y in range(0, 400, 20)])
    clustered_far = boxes(*(9_000_000 + rng.uniform(0, 50, (2, n))), *rng.uniform(0, 1, (2, n)))
    points = rng.uniform(-500, 10_500, (600, 2))
    hot = np.concatenate([points[:200], np.tile([[5001.0, 5001.0]], (200, 1)), 5000 + rng.uniform(0, 2, (200, 2))])
    mids = np.array([(x + 15.0, y + 5.0) for x in range(0, 400, 20) for y in range(0, 400, 20)])
    return {
        "even": (even, points),
        "skewed": (np.concatenate([spot, copies, even, huge]), hot),
        "flat": (flat, points),
        "ties": (grid, mids),
        "far": (clustered_far, points),
        "single": (even[:1], points[:20]),
    }


LAYOUTS = layouts()


def frames(spark, name):
    boxes, points = LAYOUTS[name]
    b = spark.createDataFrame(
        [(i, f"crop{i % 3}", *map(float, row)) for i, row in enumerate(boxes)], BOXES
    )
    p = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(points)], POINTS)
    return p, b, points, boxes


def distances(points, boxes):
    x, y = points[:, :1], points[:, 1:]
    dx = np.maximum(np.maximum(boxes[:, 0] - x, 0), x - boxes[:, 2])
    dy = np.maximum(np.maximum(boxes[:, 1] - y, 0), y - boxes[:, 3])
    return np.sqrt(dx * dx + dy * dy)


def assert_nearest(result, points, boxes):
    d = distances(points, boxes)
    rows = {r["query_id"]: r for r in result.collect()}
    assert len(rows) == len(points)
    for i, best in enumerate(d.argmin(axis=1)):
        assert rows[i]["nearest_poly_id"] == best and rows[i]["distance_m"] == d[i, best]


@pytest.mark.parametrize("name", LAYOUTS)
def test_nearest_equals_brute_force(spark, name):
    p, b, points, boxes = frames(spark, name)
    assert_nearest(nearest_box(p, b), points, boxes)


def test_nearest_shuffled_and_salted(spark, no_broadcast, monkeypatch):
    monkeypatch.setattr(skew, "ROWS_PER_TASK", 50)
    p, b, points, boxes = frames(spark, "skewed")
    result = nearest_box(p, b)
    plan = plan_of(result)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert_nearest(result, points, boxes)


def test_pyramid_splits_crowded_spots(spark):
    _, b, _, _ = frames(spark, "skewed")
    pyramid = build_pyramid(b)
    assert pyramid.grid.n_boxes == 400 + 1 + 400 + 8  # copies count once
    fullest = (
        pyramid.items.where(F.col("step") == pyramid.grid.steps)
        .groupBy("nx", "ny").count().agg(F.max("count")).first()[0]
    )
    assert fullest <= nearest.TOLERATED_PER_CELL


def test_points_at_one_spot_are_looked_up_as_one(spark, no_broadcast, monkeypatch):
    monkeypatch.setattr(skew, "ROWS_PER_TASK", 50)
    p, b, points, boxes = frames(spark, "skewed")
    lost = spark.createDataFrame([(900, None, 2.0), (901, None, None), (902, math.nan, 4.0), (903, 3.0, math.inf)], POINTS)
    own = spots.located(p.union(lost), "query_id", "x", "y")
    held = spots.spots_of(own)
    assert held.count() == len(np.unique(points, axis=0)) and held.agg(F.sum("n")).first()[0] == len(points)
    assert held.agg(F.max("n")).first()[0] > 50  # dealt over tasks
    d = distances(points, boxes)
    rows = {r["query_id"]: r for r in zone_lookup(p.union(lost), b, 80.0).collect()}
    assert len(rows) == len(points) + 4
    assert all(rows[i]["nearest_poly_id"] == best for i, best in enumerate(d.argmin(axis=1)))
    assert all(rows[i]["nearest_poly_id"] is None and math.isinf(rows[i]["min_distance_m"]) and rows[i]["nearby_covered_area_m2"] == 0 for i in range(900, 904))
    areas = {r[0]: r[1] for r in overlap.covered_area(p.union(lost), b, 80.0).collect()}
    assert areas == {i: pytest.approx(r["nearby_covered_area_m2"]) for i, r in rows.items()}


def test_candidates_are_worked_out_once(spark):
    p, b, points, boxes = frames(spark, "ties")
    with session.intermediates(spark):
        found = nearest_box(p, b)
        assert sum("/candidates-" in path for path in session._written.paths) == 1
        assert "Window" not in plan_of(found)  # the descent is not planned again
        assert_nearest(found, points, boxes)


def test_group_candidates_stay_few(spark):
    """A hot spot of points among crowded boxes never meets them all."""
    p, b, points, boxes = frames(spark, "skewed")
    pyramid = build_pyramid(b)
    grid = pyramid.grid
    cells = p.select("x", "y", grid.index(F.col("x"), grid.x0).alias("gx"), grid.index(F.col("y"), grid.y0).alias("gy"))
    groups = nearest.query_groups(cells)
    per_group = nearest.group_candidates(groups, pyramid).groupBy("gx", "gy").count()
    assert groups.count() < len(points)
    assert per_group.agg(F.max("count")).first()[0] <= nearest.TOLERATED_PER_CELL


def test_nearest_without_boxes_or_position(spark):
    p, b, _, _ = frames(spark, "single")
    none = nearest_box(p, b.where("false")).collect()
    assert len(none) == 20 and all(r["nearest_poly_id"] is None and math.isinf(r["distance_m"]) for r in none)
    lost = spark.createDataFrame(
        [(1, None, 2.0), (2, 3.0, 4.0), (3, math.nan, 4.0), (4, 3.0, math.inf)], POINTS
    )
    rows = {r["query_id"]: r for r in nearest_box(lost, b).collect()}
    assert rows[2]["nearest_poly_id"] == 0
    assert all(rows[i]["nearest_poly_id"] is None and math.isinf(rows[i]["distance_m"]) for i in (1, 3, 4))


def test_null_boxes_are_passed_over(spark):
    p, b, points, boxes = frames(spark, "ties")
    extra = spark.createDataFrame(
        [(9999, "none", None, 1.0, 2.0, 3.0), (9998, "none", 0.0, math.nan, 9.0, 9.0), (9997, "none", 0.0, 0.0, math.inf, 9.0)],
        BOXES,
    )
    assert_nearest(nearest_box(p, b.union(extra)), points, boxes)
    assert overlap.points_in_boxes(p, extra).count() == 0


@pytest.mark.parametrize("name", ["even", "skewed", "ties"])
@pytest.mark.parametrize("radius", [0.0, 35.0])
def test_points_near_boxes(spark, name, radius):
    p, b, points, boxes = frames(spark, name)
    expected = {tuple(map(int, pair)) for pair in np.argwhere(distances(points, boxes) <= radius)}
    rows = overlap.points_near_boxes(p, b, radius).select("query_id", "field_id").collect()
    assert len(rows) == len(expected) and {tuple(r) for r in rows} == expected


def test_join_kinds(spark):
    p, b, points, boxes = frames(spark, "even")
    hit = (distances(points, boxes) == 0).any(axis=1)
    ids = lambda how: {r[0] for r in overlap.points_in_boxes(p, b, how=how).select("query_id").collect()}
    assert ids("semi") == ids("inner") == set(np.flatnonzero(hit).tolist())
    assert ids("anti") == set(np.flatnonzero(~hit).tolist())
    assert ids("left") == set(range(len(points)))
    with pytest.raises(ValueError):
        overlap.points_in_boxes(p, b, how="right")


def test_shuffled_cell_join_is_salted(spark, no_broadcast, monkeypatch):
    monkeypatch.setattr(skew, "ROWS_PER_TASK", 20)
    p, b, points, boxes = frames(spark, "skewed")
    result = overlap.points_near_boxes(p, b, 35.0).select("query_id", "field_id")
    plan = plan_of(result)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    expected = {tuple(map(int, pair)) for pair in np.argwhere(distances(points, boxes) <= 35.0)}
    rows = result.collect()
    assert len(rows) == len(expected) and {tuple(r) for r in rows} == expected


@pytest.mark.parametrize("pairs", [skew.PAIRS_PER_TASK, 300])
def test_left_pairs_are_not_shuffled_and_copies_are_tested_as_one(spark, no_broadcast, monkeypatch, pairs):
    monkeypatch.setattr(skew, "PAIRS_PER_TASK", pairs)
    monkeypatch.setattr(overlap, "COPIES_PER_ROW", 30)
    p, b, points, boxes = frames(spark, "skewed")
    inside = [[int(i), int(j)] for i, j in np.argwhere(distances(points, boxes) == 0)]
    alone = [[i, None] for i in sorted(set(range(len(points))) - {i for i, _ in inside})]
    found = overlap.points_in_boxes(p, b, how="left").select("query_id", "crop_type", "field_id")
    rows = [tuple(r) for r in found.collect()]
    assert sorted(rows, key=str) == sorted(((i, j if j is None else f"crop{j % 3}", j) for i, j in inside + alone), key=str)
    # no join of the points with their pairs; only hot cells are marked by one
    assert pairs == 300 or "LeftOuter" not in plan_of(found)
    listed = overlap.merged_copies(b, 0.0)
    assert 400 + 1 + 400 + 8 < listed.n_boxes < 400 + 30 + 400 + 8
    assert listed.copies_by_cell().agg(F.sum("n")).first()[0] >= len(boxes)


def test_points_without_a_box_are_found_by_the_first_pair(spark, no_broadcast):
    p, b, _, _ = frames(spark, "skewed")
    for how in ("semi", "anti"):
        found = overlap.points_in_boxes(p, b, how=how)
        assert found.columns == p.columns
        assert plan_of(found).count("LeftSemi") >= 1


def test_hot_keys_by_rows_of_either_side_and_by_pairs(spark, monkeypatch):
    monkeypatch.setattr(skew, "ROWS_PER_TASK", 10)
    monkeypatch.setattr(skew, "PAIRS_PER_TASK", 50)
    left = spark.createDataFrame([("a", 35), ("b", 10), ("c", 1), ("d", 10), ("e", 2)], "k string, n bigint")
    right = spark.createDataFrame([("a", 1), ("b", 5), ("c", 25), ("d", 10)], "k string, n bigint")
    found = {r["k"]: (r["left_salts"], r["right_salts"]) for r in skew.hot_keys(left, right, ["k"]).collect()}
    assert found == {"a": (4, 1), "c": (1, 3), "d": (2, 1)}


@pytest.mark.parametrize("sizes", [(300, 2), (2, 300), (80, 80)])
def test_a_key_hot_on_either_side_is_split(spark, no_broadcast, monkeypatch, sizes):
    monkeypatch.setattr(skew, "ROWS_PER_TASK", 20)
    monkeypatch.setattr(skew, "PAIRS_PER_TASK", 500)
    n, m = sizes
    left = spark.range(n).selectExpr("id AS a", "1 AS k").unionByName(spark.range(3).selectExpr("id + 900 AS a", "int(id) + 5 AS k"))
    right = spark.range(m).selectExpr("id AS b", "1 AS k").unionByName(spark.range(1).selectExpr("900 AS b", "6 AS k"))
    pairs = skew.salted_join(left, right, ["k"], "a", "inner").select("a", "b").collect()
    assert len(pairs) == len(set(pairs)) == n * m + 1
    kept = skew.salted_join(left, right, ["k"], "a", "left").groupBy("a").agg(F.count("b").alias("n")).collect()
    assert {r["a"]: r["n"] for r in kept} == {**{i: m for i in range(n)}, 900: 0, 901: 1, 902: 0}


def test_wide_polygons_are_not_broadcast(spark):
    p, b, _, _ = frames(spark, "even")
    polygons = b.select("field_id", R.polygon_of_box(B.box()).alias("rings"))
    assert "BroadcastHashJoin" in plan_of(overlap.points_in_boxes(p, b))
    listed = overlap.list_boxes(polygons.select("*", R.bounds_struct(F.col("rings")).alias("e")).select("*", "e.*"), 0.0)
    assert not listed.small


def clip(outline, low, high, axis):
    """One half-plane pair of the textbook polygon clip."""
    for limit, sign in ((low, 1), (high, -1)):
        out = []
        for p, q in zip(outline, outline[1:] + outline[:1]):
            a, b = sign * (p[axis] - limit), sign * (q[axis] - limit)
            if a >= 0:
                out.append(p)
            if (a >= 0) != (b >= 0):
                t = a / (a - b)
                out.append((p[0] + t * (q[0] - p[0]), p[1] + t * (q[1] - p[1])))
        outline = out
    return outline


def textbook_area(x, y, radius, b):
    outline = [(x + dx, y + dy) for dx, dy in R.regular_offsets(radius)[:-1]]
    outline = clip(clip(outline, b[0], b[2], 0), b[1], b[3], 1) if outline else []
    return abs(sum(p[0] * q[1] - q[0] * p[1] for p, q in zip(outline, outline[1:] + outline[:1]))) / 2


@pytest.mark.parametrize("name", ["even", "skewed"])
def test_covered_area_equals_textbook_clip(spark, name):
    p, b, points, boxes = frames(spark, name)
    rows = {r[0]: r[1] for r in overlap.covered_area(p, b, 80.0).collect()}
    assert len(rows) == len(points)
    d = distances(points, boxes)
    for i, (x, y) in enumerate(points):
        expected = sum(textbook_area(x, y, 80.0, boxes[j]) for j in np.flatnonzero(d[i] <= 80.0))
        assert rows[i] == pytest.approx(expected, rel=1e-9, abs=1e-5)


ANCHORS = [
    ((-1000, -1000, 1000, 1000), 784137.1226),
    ((-50, -50, 50, 50), 10000),
    ((0, -1000, 1000, 1000), 392068.5613),
    ((0, 0, 1000, 1000), 196034.2807),
    ((300, 100, 700, 400), 36101.3772),
    ((360, 360, 900, 900), 0),
    ((499.5 * math.cos(math.pi / 64), 499.5 * math.sin(math.pi / 64), 900, 900), 0),
]


def test_overlap_anchors(spark):
    rows = [(i, 0.0, 0.0, *map(float, b)) for i, (b, _) in enumerate(ANCHORS)]
    df = spark.createDataFrame(rows, "i int, x double, y double, minx double, miny double, maxx double, maxy double")
    got = {r["i"]: r["a"] for r in overlap.with_buffer_overlap(df, "x", "y", 500.0, "a").collect()}
    for i, (_, expected) in enumerate(ANCHORS):
        assert got[i] == pytest.approx(expected, abs=1e-4)


def test_zone_lookup_columns(spark):
    p, b, points, boxes = frames(spark, "skewed")
    rows = {r["query_id"]: r for r in zone_lookup(p, b, 80.0).collect()}
    d = distances(points, boxes)
    for i, best in enumerate(d.argmin(axis=1)):
        assert rows[i]["nearest_poly_id"] == best and rows[i]["min_distance_m"] == d[i, best]
        assert rows[i]["nearest_crop"] == f"crop{best % 3}"
        assert (rows[i]["nearby_covered_area_m2"] == 0) == (not (d[i] < 79.9).any())


def test_zone_lookup_plan(spark):
    p, b, _, _ = frames(spark, "skewed")
    plan = plan_of(zone_lookup(p, b, 80.0))
    for avoided in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInArrow"):
        assert avoided not in plan


def test_candidate_counts(spark):
    p, b, points, boxes = frames(spark, "skewed")
    mids = (boxes[:, :2] + boxes[:, 2:]) / 2
    rows = {r[0]: r[1] for r in overlap.candidate_counts(p, b, 100.0).collect()}
    inside = (np.abs(points[:, None] - mids[None]) < 100.0).all(axis=2).sum(axis=1)
    assert rows == dict(enumerate(inside.tolist()))


def test_candidates_are_counted_not_paired(spark, monkeypatch):
    """Spots and points on the squares' sides, copies, and a point without a position; crowded cells in pieces."""
    monkeypatch.setattr(skew, "ROWS_PER_TASK", 50)
    monkeypatch.setattr(overlap, "SPOTS_PER_CELL", 40)
    rng = np.random.default_rng(5)
    spots, points = rng.integers(0, 30, (400, 2)).astype(float), rng.integers(0, 30, (300, 2)).astype(float)
    b = spark.createDataFrame([(i, *map(float, s), *map(float, s)) for i, s in enumerate(spots)], "field_id long, minx double, miny double, maxx double, maxy double")
    p = spark.createDataFrame([*((i, *map(float, q)) for i, q in enumerate(points)), (300, None, 1.0)], "query_id long, x double, y double")
    found = overlap.candidate_counts(p, b, 4.0)
    inside = (np.abs(points[:, None] - spots[None]) < 4.0).all(axis=2).sum(axis=1)
    assert {r[0]: r[1] for r in found.collect()} == dict(enumerate([*inside.tolist(), 0]))
    # points and spots meet by cell, and no pair of them is a row
    assert "FlatMapCoGroupsInArrow" in plan_of(found)


def test_synthetic_tables_are_repeatable(spark):
    a, b = synthetic.boxes(spark, 500), synthetic.boxes(spark, 500).repartition(7)
    assert a.exceptAll(b).count() == 0 and a.where("maxx <= minx").count() == 0
    assert synthetic.boxes(spark, 500, seed=1).exceptAll(a).count() == 500
    p = synthetic.points(spark, 200)
    pts = np.array([(r["x"], r["y"]) for r in p.orderBy("query_id").collect()])
    bxs = np.array([r[:] for r in a.orderBy("field_id").select("minx", "miny", "maxx", "maxy").collect()])
    assert_nearest(nearest_box(p, a), pts, bxs)
