import math
import struct

import pytest
from pyspark.sql import functions as F

from parcelgrid.functions import box as B
from parcelgrid.functions import ring as R
from parcelgrid.functions import scalar as S
from parcelgrid.functions.ring import RINGS_TYPE
from parcelgrid.functions.sql import register_sql_functions
from parcelgrid.functions.wkb import point_of_wkb, polygon_of_wkb, wkb_of_point, wkb_of_polygon
from parcelgrid.functions.wkt import polygon_of_wkt, window_of_wkt

SHAPES = {
    "square": [[(0, 0), (10, 0), (10, 10), (0, 10), (0, 0)]],
    "triangle": [[(0, 0), (4, 0), (0, 3), (0, 0)]],
    "ell": [[(0, 0), (4, 0), (4, 1), (1, 1), (1, 4), (0, 4), (0, 0)]],
    "holed": [
        [(0, 0), (10, 0), (10, 10), (0, 10), (0, 0)],
        [(2, 2), (2, 4), (4, 4), (4, 2), (2, 2)],
    ],
    "reversed": [[(0, 0), (0, 10), (10, 10), (10, 0), (0, 0)]],
    "bow_tie": [[(0, 0), (4, 4), (4, 0), (0, 4), (0, 0)]],
    "unclosed": [[(0, 0), (4, 0), (4, 4), (0, 4)]],
    "flat": [[(0, 0), (0, 5), (0, 5), (0, 0), (0, 0)]],
    "spike": [[(0, 0), (4, 0), (8, 0), (4, 0), (4, 4), (0, 0)]],
    "hole_outside": [
        [(0, 0), (4, 0), (4, 4), (0, 4), (0, 0)],
        [(6, 6), (7, 6), (7, 7), (6, 6)],
    ],
    "repeated_vertex": [[(0, 0), (4, 0), (4, 0), (4, 4), (0, 4), (0, 0)]],
    "empty": [],
    "missing": None,
}


def doubles(rings):
    return rings if rings is None else [[(float(x), float(y)) for x, y in r] for r in rings]


@pytest.fixture(scope="module")
def shapes(spark):
    rows = [(name, doubles(rings)) for name, rings in SHAPES.items()]
    return spark.createDataFrame(rows, f"name string, rings {RINGS_TYPE}").cache()


def by_name(df, column):
    return {r["name"]: r["v"] for r in df.select("name", column.alias("v")).collect()}


def test_ring_area_and_length(shapes):
    area = by_name(shapes.where("size(rings) > 0"), R.area(F.col("rings")))
    assert area["square"] == 100 and area["reversed"] == 100
    assert area["triangle"] == 6 and area["ell"] == 7 and area["holed"] == 96
    length = by_name(shapes.where("size(rings) > 0"), R.length(F.col("rings")))
    assert length["square"] == 40 and length["triangle"] == 12 and length["holed"] == 48


def test_centroid(shapes):
    c = by_name(shapes.where("size(rings) > 0"), R.centroid(F.col("rings")))
    assert (c["square"].x, c["square"].y) == (5, 5)
    assert c["reversed"].x == pytest.approx(5)
    assert (c["triangle"].x, c["triangle"].y) == (pytest.approx(4 / 3), 1)
    assert c["ell"].x == pytest.approx((4 * 2 + 3 * 0.5) / 7)
    assert c["holed"].x == pytest.approx((100 * 5 - 4 * 3) / 96)
    assert (c["flat"].x, c["flat"].y) == (0, 2.5)


def test_validity(shapes):
    ok = by_name(shapes, R.is_valid(F.col("rings")))
    good = {"square", "triangle", "ell", "holed", "reversed", "repeated_vertex"}
    assert {n for n, v in ok.items() if v} == good
    assert ok["missing"] is None and ok["empty"] is False


def test_close_ring(shapes):
    closed = shapes.where("name = 'unclosed'").select(
        F.transform("rings", R.close_ring).alias("r")
    ).first()["r"][0]
    assert len(closed) == 5 and closed[0] == closed[-1]


def test_distance_and_containment(shapes):
    d = lambda x, y: by_name(shapes.where("size(rings) > 0"), R.distance_to_point(F.col("rings"), x, y))
    inside = d(3, 3)
    assert inside["square"] == 0 and inside["holed"] == 1 and inside["ell"] == 2
    assert d(10, 5)["square"] == 0  # on the edge
    assert d(13, 14)["square"] == 5
    assert d(2, 2)["holed"] == 0  # on the hole's corner


def test_clipped_area_of_any_polygon(shapes):
    window = B.Box(*(F.lit(float(v)) for v in (0.5, 0.5, 3, 20)))
    area = by_name(shapes.where("size(rings) > 0"), R.clipped_area(F.col("rings"), window))
    assert area["square"] == pytest.approx(2.5 * 9.5)
    assert area["holed"] == pytest.approx(2.5 * 9.5 - 1 * 2)
    assert area["ell"] == pytest.approx(2.5 * 0.5 + 0.5 * 3)


def test_polygon_predicates(shapes):
    window = polygon_of_wkt(F.lit("POLYGON((-1 -1, 5 -1, 5 5, -1 5, -1 -1))"))
    some = shapes.where("name in ('square', 'triangle', 'ell')")
    assert by_name(some, R.within(F.col("rings"), window)) == {"square": False, "triangle": True, "ell": True}
    far = polygon_of_wkt(F.lit("POLYGON((2 2, 3 2, 3 3, 2 3, 2 2))"))
    assert by_name(some, R.intersects(F.col("rings"), far)) == {"square": True, "triangle": False, "ell": False}


def test_point_buffer(spark):
    row = spark.range(1).select(
        R.area(R.buffer_point(5.0, 7.0, 500)).alias("a"), F.size(R.shell(R.buffer_point(5.0, 7.0, 500))).alias("n")
    ).first()
    assert row["a"] == pytest.approx(784137.1226, abs=1e-4) and row["n"] == 65


def test_convex_buffer(shapes):
    grown = by_name(shapes.where("name in ('square', 'triangle', 'reversed')"), R.area(R.buffer_convex(F.col("rings"), 1.0)))
    assert grown["square"] == pytest.approx(100 + 40 + 32 * math.sin(math.pi / 32))
    assert grown["reversed"] == pytest.approx(grown["square"])
    assert 6 + 12 + 3.0 < grown["triangle"] < 6 + 12 + math.pi
    with pytest.raises(Exception, match="concave"):
        shapes.where("name = 'ell'").select(R.buffer_convex(F.col("rings"), 1.0)).collect()
    with pytest.raises(Exception, match="holes"):
        shapes.where("name = 'holed'").select(R.buffer_convex(F.col("rings"), 1.0)).collect()
    with pytest.raises(ValueError):
        R.buffer_convex(F.lit(None), -1.0)


def test_box_functions(spark):
    df = spark.createDataFrame([(4.0, 3.0, 0.0, 0.0), (0.0, 0.0, 4.0, 0.0), (None, None, None, None)], "a double, b double, c double, d double")
    b = B.box_from_corners(*(F.col(c) for c in "abcd"))
    rows = df.where("a is not null").select(
        B.area(b), B.length(b), B.is_valid(b), B.distance_to_point(b, 7, 7), B.compactness(B.area(b), B.length(b))
    ).collect()
    assert tuple(rows[0]) == (12, 14, True, 5, 4 * math.pi * 12 / 196)
    assert rows[1][2] is False and rows[1][0] == 0
    assert df.where("a is null").select(B.distance_to_point(B.Box(*(F.col(c) for c in "abcd")), 0, 0)).first()[0] is None


def test_scalars(spark):
    row = spark.range(1).select(
        S.round_half_even(F.lit(0.125), 2), S.padded_id("F", F.lit(42)), S.padded_id("F", F.lit(12345678)),
        S.safe_ratio(F.lit(1.0), F.lit(0.0)), S.truncate_to_int(F.lit(-1.9)), S.pick(["a", "b"], F.lit(3)),
        S.flat_degree_hectares(F.lit(0.001)), S.clip(F.lit(9), 0, 3), S.mebibytes(F.lit(1048576)),
    ).first()
    assert tuple(row)[:6] == (0.12, "F000042", "F12345678", math.inf, -1, "b")
    assert row[6] == pytest.approx(0.867, abs=1e-3) and row[7] == 3 and row[8] == 1


def big_endian_square():
    ring = [(0, 0), (1, 0), (1, 1), (0, 1), (0, 0)]
    return struct.pack(">BIII", 0, 3, 1, len(ring)) + b"".join(struct.pack(">dd", *p) for p in ring)


def test_wkb_round_trip(shapes, spark):
    stored = shapes.select("name", "rings", wkb_of_polygon("rings").alias("wkb"))
    back = stored.select("name", "rings", polygon_of_wkb("wkb").alias("again"), "wkb").collect()
    for r in back:
        assert r["rings"] == r["again"], r["name"]
    square = next(r["wkb"] for r in back if r["name"] == "square")
    assert bytes(square[:13]) == struct.pack("<BIII", 1, 3, 1, 5) and len(square) == 93
    foreign = spark.createDataFrame([(bytearray(big_endian_square()),), (None,)], "wkb binary")
    rows = foreign.select(polygon_of_wkb("wkb").alias("r")).collect()
    assert [tuple(p) for p in rows[0]["r"][0]][2] == (1.0, 1.0) and rows[1]["r"] is None


def test_wkb_points_and_errors(spark):
    points = spark.createDataFrame([(1.5, -2.5), (None, 1.0)], "x double, y double")
    back = points.select(point_of_wkb(wkb_of_point("x", "y")).alias("p")).collect()
    assert tuple(back[0]["p"]) == (1.5, -2.5) and back[1]["p"] is None
    with pytest.raises(Exception, match="only polygons"):
        points.where("x is not null").select(polygon_of_wkb(wkb_of_point("x", "y"))).collect()
    short = spark.createDataFrame([(bytearray(big_endian_square()[:40]),)], "wkb binary")
    with pytest.raises(Exception, match="end early"):
        short.select(polygon_of_wkb("wkb")).collect()


def test_wkt(spark):
    text = "POLYGON((0 0, 10 0, 10 10, 0 10, 0 0), (2 2, 2 4, 4 4, 4 2, 2 2))"
    assert spark.range(1).select(R.area(polygon_of_wkt(F.lit(text)))).first()[0] == 96
    assert window_of_wkt("POLYGON((0 1, 4 1, 4 3, 0 3, 0 1))") == (0, 1, 4, 3)
    assert window_of_wkt("POLYGON((0 0, 4 0, 0 3, 0 0))") is None
    with pytest.raises(ValueError):
        window_of_wkt("POINT(1 2)")


def test_sql_functions(shapes, spark):
    register_sql_functions(spark)
    shapes.where("size(rings) > 0").withColumn("wkb", wkb_of_polygon("rings")).createOrReplaceTempView("shapes")
    rows = spark.sql("SELECT name, poly_area(poly_from_wkb(wkb)) AS a FROM shapes").collect()
    area = {r["name"]: r["a"] for r in rows}
    assert area["holed"] == 96 and area["triangle"] == 6
    assert spark.sql("SELECT box_area(0, 0, 4, 3), box_within(1, 1, 2, 2, 0, 0, 4, 4), box_intersects(0, 0, 1, 1, 1, 1, 2, 2)").first()[:] == (12, True, True)
