"""Polygon predicates on triangles, L-shapes, holes and broken rings."""

import pytest
from pyspark.sql import functions as F

from parcelgrid.functions import crs
from parcelgrid.functions import ring as R
from parcelgrid.functions.ring import GEOMETRY_TYPE
from parcelgrid.functions.sql import register_sql_functions
from parcelgrid.functions.wkt import polygon_of_wkt
from parcelgrid.operators import verify

SQUARE = "(0 0, 10 0, 10 10, 0 10, 0 0)"
HOLE = "(4 4, 6 4, 6 6, 4 6, 4 4)"
ELL = "(0 0, 10 0, 10 4, 4 4, 4 10, 0 10, 0 0)"


def poly(*rings):
    return f"POLYGON({', '.join(rings)})"


WITHIN = [
    (poly("(1 1, 9 1, 9 9, 1 9, 1 1)"), poly(SQUARE), True),
    (poly("(1 1, 9 1, 9 9, 1 9, 1 1)"), poly(SQUARE, HOLE), False),  # the hole lies in the polygon
    (poly("(1 1, 3 1, 3 3, 1 3, 1 1)"), poly(SQUARE, HOLE), True),
    (poly(HOLE), poly(SQUARE, HOLE), False),  # the polygon is the hole
    (poly("(4.5 4.5, 5 4.5, 5 5, 4.5 4.5)"), poly(SQUARE, HOLE), False),
    (poly("(1 1, 9 1, 9 9, 1 9, 1 1)", HOLE), poly(SQUARE, HOLE), True),  # the same hole in both
    (poly("(1 1, 9 1, 9 9, 1 9, 1 1)", "(3 3, 7 3, 7 7, 3 7, 3 3)"), poly(SQUARE, HOLE), True),
    (poly("(0 8, 2 2, 8 0, 0 8)"), poly(ELL), True),  # an edge through the inner corner
    (poly("(0 9, 2 2, 8 0, 0 9)"), poly(ELL), False),
    (poly("(0 0, 4 0, 4 4, 0 4, 0 0)"), poly(ELL), True),  # along the edges
    (poly("(2 6, 6 2, 2 2, 2 6)"), poly(ELL), True),  # touches the inner corner
    (poly("(0 10, 10 10, 10 0, 0 10)"), poly("(0 0, 10 0, 10 10, 0 10, 0 0)"), True),
    (poly("(0 10, 10 0, 0 0, 0 10)"), poly("(0 0, 10 0, 4 4, 0 10, 0 0)"), False),
    (poly(SQUARE), poly("(0 0, 5 0, 5 5, 10 5, 10 0, 12 0, 12 12, 0 12, 0 0)"), False),
    # edges run through two corners of a notch: both ends and the middle inside, the notch not
    (poly("(0 4, 16 4, 16 1, 0 1, 0 4)"), poly("(0 0, 16 0, 16 6, 4 6, 4 4, 3 3, 2 4, 2 6, 0 6, 0 0)"), False),
]

VALID = [
    (poly(SQUARE), True),
    (poly(SQUARE, HOLE), True),
    (poly(ELL, "(3 8, 8 3, 2 2, 3 8)"), False),  # the hole crosses the inner corner
    (poly(SQUARE, HOLE, "(5 5, 7 5, 7 7, 5 7, 5 5)"), False),  # holes overlap
    (poly(SQUARE, HOLE, "(4.5 4.5, 5.5 4.5, 5.5 5.5, 4.5 4.5)"), False),  # a hole in a hole
    (poly(SQUARE, HOLE, HOLE), False),
    (poly(SQUARE, "(1 1, 2 1, 2 2, 1 1)", "(7 7, 8 7, 8 8, 7 7)"), True),
    (poly(SQUARE, "(4 4, 5 4, 5 5, 4 4)", "(5 5, 6 5, 6 6, 5 5)"), True),  # holes touch in a corner
    (poly(SQUARE, "(8 8, 12 8, 12 12, 8 8)"), False),
    (poly("(0 0, 4 4, 4 0, 0 4, 0 0)"), False),
    (poly("(0 0, 3 0, 0 0)"), False),
]


def test_within(spark):
    rows = spark.createDataFrame([(i, a, b) for i, (a, b, _) in enumerate(WITHIN)], "i int, a string, b string")
    got = rows.select("i", R.within(polygon_of_wkt(F.col("a")), polygon_of_wkt(F.col("b"))).alias("w"))
    assert {r.i: r.w for r in got.collect()} == {i: w for i, (_, _, w) in enumerate(WITHIN)}


def test_validity(spark):
    rows = spark.createDataFrame([(i, a) for i, (a, _) in enumerate(VALID)], "i int, a string")
    got = rows.select("i", R.is_valid(polygon_of_wkt(F.col("a"))).alias("v"))
    assert {r.i: r.v for r in got.collect()} == {i: v for i, (_, v) in enumerate(VALID)}


@pytest.mark.parametrize("text", ["MULTIPOLYGON(((0 0, 1 0, 1 1, 0 0)),((2 0, 3 0, 3 1, 2 0)))", "POINT(1 2)", "", "POLYGON((1 2, 3"])
def test_other_text_raises(spark, text):
    register_sql_functions(spark)
    row = spark.createDataFrame([(text,)], "t string")
    with pytest.raises(Exception, match="not a polygon"):
        row.select(polygon_of_wkt(F.col("t"))).collect()
    with pytest.raises(Exception, match="not a polygon"):
        row.selectExpr("poly_from_wkt(t)").collect()


def test_text_forms_agree(spark):
    register_sql_functions(spark)
    texts = [poly(SQUARE), " polygon\t((0\t0 ,1  0,\n1 1 , 0 0 ))", "POLYGON EMPTY", None, poly(SQUARE, HOLE)]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    got = rows.select(polygon_of_wkt(F.col("t")).alias("a"), F.expr("poly_from_wkt(t)").alias("b")).collect()
    assert all(r.a == r.b for r in got)
    assert [None if r.a is None else [len(x) for x in r.a] for r in got] == [[5], [4], [], None, [5, 5]]


def test_sql_window_must_be_a_box(spark):
    register_sql_functions(spark)
    rows = spark.createDataFrame([(poly(HOLE),)], "t string")
    inside = lambda window: rows.selectExpr(f"poly_within_box(poly_from_wkt(t), poly_from_wkt('{window}')) AS w").first().w
    assert inside(poly(SQUARE)) is True and inside(poly("(5 5, 9 5, 9 9, 5 9, 5 5)")) is False
    with pytest.raises(Exception, match="axis-aligned"):
        inside(poly("(0 0, 10 0, 0 10, 0 0)"))


def test_null_geometry_stays_null(spark):
    rows = spark.createDataFrame([(1, (4326, None)), (2, None), (3, (32611, [[(0.0, 0.0), (1.0, 0.0), (0.0, 1.0), (0.0, 0.0)]]))], f"i int, geom {GEOMETRY_TYPE}")
    moved = {r.i: r.geom.rings for r in crs.harmonise_rings(rows, 32611).collect()}
    assert moved[1] is None and moved[2] is None and len(moved[3][0]) == 4
    points = spark.createDataFrame([(1, None, None, None), (2, 5.0, 6.0, 32611)], "i int, x double, y double, srid int")
    assert [r.x for r in crs.harmonise_points(points, 32611).orderBy("i").collect()] == [None, 5.0]
    wrong = spark.createDataFrame([(1, 5.0, 6.0, None)], "i int, x double, y double, srid int")
    with pytest.raises(Exception, match="unsupported SRID NULL"):
        crs.harmonise_points(wrong, 32611).collect()


def test_duplicate_keys_are_reported(spark):
    two = spark.createDataFrame([(1, "a", 1.0), (1, "a", 2.0), (2, "b", 3.0)], "k int, c string, v double")
    one = spark.createDataFrame([(1, "a", 1.0), (2, "b", 3.0)], "k int, c string, v double")
    row = verify.reconcile(two, one, ["k"], ["c"], ["v"]).first()
    assert (row.n_left, row.n_right, row.n_duplicate_keys, row.n_common, row.verdict) == (3, 2, 1, 1, "MISMATCH")
    assert verify.reconcile(one, one, ["k"], ["c"], ["v"]).first().verdict == "MATCH"


def test_every_point_of_an_outline_is_contained(spark):
    df = spark.sql("SELECT CAST(id AS DOUBLE) / 10 AS v FROM range(1, 200000, 37)")
    rings = polygon_of_wkt(F.lit("POLYGON((113 7, 30113 7, 30113 20007, 113 20007, 113 7))"))
    on = [R.contains_point(rings, F.lit(x), 7 + F.col("v")) for x in (113.0, 30113.0)]
    on += [R.contains_point(rings, 113 + F.col("v"), F.lit(y)) for y in (7.0, 20007.0)]
    assert df.select(F.count_if(~(on[0] & on[1] & on[2] & on[3]))).first()[0] == 0
