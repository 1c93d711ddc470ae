import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from parcelgrid.functions import crs
from parcelgrid.functions.ring import GEOMETRY_TYPE

ANCHORS = [
    (-122.4784, 37.8199, 32610, 545907.0150, 4185960.9900),
    (-115.5, 33.0, 32611, 640130.3133, 3652286.1149),
    (-117.0, 45.0, 32611, 500000.0, 4982950.4002),
    (-117.0, 0.0, 32611, 500000.0, 0.0),
]


@pytest.mark.parametrize("lon, lat, srid, east, north", ANCHORS)
def test_anchors(spark, lon, lat, srid, east, north):
    e, n = crs.to_utm(lon, lat, srid)
    row = spark.range(1).select(e.alias("e"), n.alias("n")).first()
    assert row["e"] == pytest.approx(east, abs=1e-4) and row["n"] == pytest.approx(north, abs=1e-4)
    e, n = crs.to_utm(lat, lon, srid, axis_order="yx")
    assert spark.range(1).select(e.alias("e")).first()["e"] == row["e"]


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.floats(-3, 3), st.floats(-80, 80)), min_size=1, max_size=20))
def test_symmetries(spark, offsets):
    rows = [(-117.0 + dx, -117.0 - dx, lat) for dx, lat in offsets]
    df = spark.createDataFrame(rows, "east double, west double, lat double")
    a = crs.to_utm(F.col("east"), F.col("lat"), 32611)
    b = crs.to_utm(F.col("west"), F.col("lat"), 32611)
    south = crs.to_utm(F.col("east"), -F.col("lat"), 32711)
    for r in df.select(a[0], a[1], b[0], b[1], south[0], south[1]).collect():
        assert r[0] + r[2] == pytest.approx(1_000_000, abs=1e-4)
        assert r[1] == pytest.approx(r[3], abs=1e-4)
        assert r[4] == pytest.approx(r[0], abs=1e-4) and r[5] == pytest.approx(10_000_000 - r[1], abs=1e-4)


def test_out_of_range_latitude_has_no_position(spark):
    df = spark.createDataFrame([(-122.4784, 37.8199)], "lon double, lat double")
    row = crs.axis_swap_audit(df, "lon", "lat", 32610).first()
    assert row["axis_error_m"] is None and row["axis_suspect"] is True
    swapped = crs.with_utm(df, "lat", "lon", 32610).first()
    assert swapped["easting"] is None and swapped["northing"] is None


def test_axis_swap_is_measured(spark):
    df = spark.createDataFrame([(10.0, 50.0)], "lon double, lat double")
    row = crs.axis_swap_audit(df, "lon", "lat", 32632).first()
    assert row["axis_error_m"] > 100 and row["axis_suspect"] is True


def test_unsupported_codes():
    for srid in (3857, 32661, 32700):
        with pytest.raises(ValueError):
            crs.utm_zone(srid)
    with pytest.raises(ValueError):
        crs.transform_rings(F.lit(None), 32610, 32611)


def test_rings_match_points(spark):
    geom = (4326, [[(-115.5, 33.0), (-115.4, 33.0), (-115.4, 33.1), (-115.5, 33.0)]])
    df = spark.createDataFrame([(geom,)], f"geom {GEOMETRY_TYPE}")
    ring = crs.harmonise_rings(df, 32611).first()["geom"]
    assert ring["srid"] == 32611 and ring["rings"][0][0]["x"] == pytest.approx(640130.3133, abs=1e-4)
    same = crs.harmonise_rings(crs.harmonise_rings(df, 32611), 32611).first()["geom"]
    assert same == ring


def test_unknown_srid_raises(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3857)], "x double, y double, srid int")
    with pytest.raises(Exception, match="unsupported SRID 3857"):
        crs.harmonise_points(df, 32611).collect()
