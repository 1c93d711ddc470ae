"""Registered queries with their SQL twins.

Each entry reads whole given tables. Doubles that depend on summation order or
on the math library's last digit are rounded the same way on both sides.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelgrid.functions import box as B
from parcelgrid.functions import crs
from parcelgrid.functions import ring as R
from parcelgrid.functions.scalar import (
    hectares,
    padded_id,
    pick,
    safe_ratio,
)
from parcelgrid.functions.sql import register_sql_functions
from parcelgrid.functions.wkb import point_of_wkb, polygon_of_wkb, wkb_of_point, wkb_of_polygon
from parcelgrid.functions.wkt import polygon_of_wkt, tagged, window_of_wkt
from parcelgrid.operators import overlap, summaries, tiles, verify
from parcelgrid.operators.nearest import nearest_box
from parcelgrid.plans import etl
from parcelgrid.plans.fixtures import fixture, oracle_with, spread, table
from parcelgrid.plans.zone_lookup import RADIUS_M, zone_lookup
from parcelgrid.session import shared_path
from parcelgrid.sources import geojson, geoparquet, lake
from parcelgrid.streaming.ingest import ingest_geojson
from parcelgrid.streaming.zones import stream_zone_lookup

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

UTM_11N = 32611
N_COLS, N_ROWS = 4, 4
CANDIDATE_RADIUS_M = 2000.0

# The window of the example map view, lon/lat.
WINDOW_WKT = "POLYGON((-116 32.6, -114.4 32.6, -114.4 33.4, -116 33.4, -116 32.6))"


def query(name: str, sql: str | None = None):
    def add(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql.strip()
        return function

    return add


def fixed(value: Column, places: int) -> Column:
    """Round half up by floor; the SQL twin uses the same formula."""
    scale = float(10**places)
    return F.floor(value * scale + 0.5) / F.lit(scale)


def fixed_sql(value: str, places: int) -> str:
    scale = f"CAST({10**places} AS DOUBLE)"
    return f"floor(({value}) * {scale} + CAST(0.5 AS DOUBLE)) / {scale}"


def fields_with_rings(spark: SparkSession, sf_dir: str, name: str, srid: int) -> DataFrame:
    """A box fixture with its polygon and ``bbox`` struct in place of the four columns."""
    b = B.box()
    return (
        spread(spark, sf_dir, name)
        .withColumns({"geom": tagged(R.polygon_of_box(b), srid), "bbox": B.as_struct(b)})
        .drop(*B.BOX_FIELDS)
    )


# --- geometry scalars -------------------------------------------------------

@query(
    "geom_scalars_box",
    oracle_with("fields_m")
    + f"""
    SELECT field_id, (maxx - minx) * (maxy - miny) AS area_m2,
           (maxx - minx) * (maxy - miny) / CAST(10000 AS DOUBLE) AS area_ha_computed,
           2 * ((maxx - minx) + (maxy - miny)) AS perimeter_m,
           (minx + maxx) / 2 AS centroid_x, (miny + maxy) / 2 AS centroid_y,
           CASE WHEN (maxx - minx) + (maxy - miny) <> 0 THEN
             {fixed_sql("4 * pi() * ((maxx - minx) * (maxy - miny)) / ((2 * ((maxx - minx) + (maxy - miny))) * (2 * ((maxx - minx) + (maxy - miny))))", 6)}
           END AS compactness
    FROM fields_m""",
)
def geom_scalars_box(spark, sf_dir):
    b = B.box()
    return fixture(spark, sf_dir, "fields_m").select(
        "field_id",
        B.area(b).alias("area_m2"),
        hectares(B.area(b)).alias("area_ha_computed"),
        B.length(b).alias("perimeter_m"),
        B.centroid_x(b).alias("centroid_x"),
        B.centroid_y(b).alias("centroid_y"),
        fixed(B.compactness(B.area(b), B.length(b)), 6).alias("compactness"),
    )


@query(
    "ring_area_length",
    oracle_with("fields_m")
    + """
    SELECT field_id, abs((maxx - minx) * (maxy - miny)) AS area_m2,
           2 * ((maxx - minx) + (maxy - miny)) AS perimeter_m,
           (minx + maxx) / 2 AS centroid_x, (miny + maxy) / 2 AS centroid_y, 5 AS n_vertices
    FROM fields_m""",
)
def ring_area_length(spark, sf_dir):
    rings = F.col("geom.rings")
    framed = fields_with_rings(spark, sf_dir, "fields_m", UTM_11N)
    return framed.withColumn("centre", R.centroid(rings)).select(
        "field_id",
        R.area(rings).alias("area_m2"),
        R.length(rings).alias("perimeter_m"),
        F.col("centre.x").alias("centroid_x"),
        F.col("centre.y").alias("centroid_y"),
        F.size(R.xs(R.shell(rings))).alias("n_vertices"),
    )


@query(
    "dist_to_point",
    oracle_with("fields_m")
    + """
    SELECT field_id, d AS box_distance_m, d AS ring_distance_m FROM (
      SELECT field_id, sqrt(dx * dx + dy * dy) AS d FROM (
        SELECT field_id, greatest(minx - 50000, CAST(0 AS DOUBLE), 50000 - maxx) AS dx,
               greatest(miny - 50000, CAST(0 AS DOUBLE), 50000 - maxy) AS dy FROM fields_m))""",
)
def dist_to_point(spark, sf_dir):
    rings = R.polygon_of_box(B.box())
    return fixture(spark, sf_dir, "fields_m").select(
        "field_id",
        B.distance_to_point(B.box(), 50000, 50000).alias("box_distance_m"),
        R.distance_to_point(rings, 50000, 50000).alias("ring_distance_m"),
    )


@query(
    "bounds_validity",
    oracle_with("fields_m")
    + """
    SELECT field_id, minx, miny, maxx, maxy, maxx > minx AND maxy > miny AS box_valid,
           maxx > minx AND maxy > miny AS ring_valid FROM fields_m""",
)
def bounds_validity(spark, sf_dir):
    framed = fields_with_rings(spark, sf_dir, "fields_m", UTM_11N)
    extent = framed.withColumn("extent", R.bounds_struct(F.col("geom.rings")))
    return extent.select(
        "field_id",
        *B.as_columns(B.box_of("extent")),
        B.is_valid(B.box_of("extent")).alias("box_valid"),
        R.is_valid(F.col("geom.rings")).alias("ring_valid"),
    )


_BUFFER_CORNERS = 32 * math.sin(math.pi / 32)


@query(
    "buffer_area",
    oracle_with("fields_m")
    + f"""
    SELECT field_id, {fixed_sql(f"(maxx - minx) * (maxy - miny) + 2 * ((maxx - minx) + (maxy - miny)) + CAST({_BUFFER_CORNERS!r} AS DOUBLE)", 3)} AS box_buffer_m2,
           {fixed_sql(f"(maxx - minx) * (maxy - miny) + 2 * ((maxx - minx) + (maxy - miny)) + CAST({_BUFFER_CORNERS!r} AS DOUBLE)", 3)} AS ring_buffer_m2
    FROM fields_m WHERE maxx > minx AND maxy > miny""",
)
def buffer_area(spark, sf_dir):
    b = B.box()
    outline = R.buffer_convex(R.polygon_of_box(b), 1.0)
    return spread(spark, sf_dir, "fields_m").where(B.is_valid(b)).select(
        "field_id",
        fixed(B.buffer_area(b, 1.0), 3).alias("box_buffer_m2"),
        fixed(R.area(outline), 3).alias("ring_buffer_m2"),
    )


@query(
    "point_buffer",
    oracle_with("sensors_m")
    + f"""
    SELECT query_id, {fixed_sql(repr(R.buffer_point_area(RADIUS_M)), 2)} AS buffer_m2, 65 AS n_vertices,
           {fixed_sql("x - 500", 3)} AS minx, {fixed_sql("y + 500", 3)} AS maxy FROM sensors_m""",
)
def point_buffer(spark, sf_dir):
    rings = R.buffer_point(F.col("x"), F.col("y"), RADIUS_M)
    framed = spread(spark, sf_dir, "sensors_m").withColumn("rings", rings)
    extent = R.bounds(F.col("rings"))
    return framed.select(
        "query_id",
        fixed(R.area(F.col("rings")), 2).alias("buffer_m2"),
        F.size(R.shell(F.col("rings"))).alias("n_vertices"),
        fixed(extent.minx, 3).alias("minx"),
        fixed(extent.maxy, 3).alias("maxy"),
    )


@query(
    "field_labels",
    oracle_with("fields_m")
    + """
    SELECT 'F' || CASE WHEN length(CAST(field_id AS VARCHAR)) >= 6 THEN CAST(field_id AS VARCHAR)
                       ELSE lpad(CAST(field_id AS VARCHAR), 6, '0') END AS field_label,
           crop_type, least(greatest(area_ha, CAST(10 AS DOUBLE)), CAST(100 AS DOUBLE)) AS clipped_ha,
           CAST(trunc(yield_tha) AS INT) AS whole_yield,
           CASE WHEN area_ha - 1 > 0 THEN yield_tha / (area_ha - 1) ELSE CAST('Infinity' AS DOUBLE) END AS guarded_ratio
    FROM fields_m""",
)
def field_labels(spark, sf_dir):
    return fixture(spark, sf_dir, "fields_m").select(
        padded_id("F", F.col("field_id")).alias("field_label"),
        "crop_type",
        F.least(F.greatest(F.col("area_ha"), F.lit(10.0)), F.lit(100.0)).alias("clipped_ha"),
        F.col("yield_tha").cast("int").alias("whole_yield"),
        safe_ratio(F.col("yield_tha"), F.col("area_ha") - 1.0).alias("guarded_ratio"),
    )


# --- filters ---------------------------------------------------------------

@query(
    "within_window",
    oracle_with("fields_ll")
    + """
    SELECT field_id, crop_type, minx, miny FROM fields_ll
    WHERE minx >= CAST(-116 AS DOUBLE) AND miny >= CAST(32.6 AS DOUBLE)
      AND maxx <= CAST(-114.4 AS DOUBLE) AND maxy <= CAST(33.4 AS DOUBLE) AND year = 2024""",
)
def within_window(spark, sf_dir):
    fields = fixture(spark, sf_dir, "fields_ll").where(F.col("year") == 2024)
    return overlap.within_window(fields, window_of_wkt(WINDOW_WKT)).select(
        "field_id", "crop_type", "minx", "miny"
    )


_TRIANGLE_WKT = "POLYGON((-116.4 32.6, -114.6 32.6, -115.5 33.9, -116.4 32.6))"


def _left_of(px: str, py: str, ax: float, ay: float, bx: float, by: float) -> str:
    return (
        f"(CAST({bx} AS DOUBLE) - CAST({ax} AS DOUBLE)) * ({py} - CAST({ay} AS DOUBLE)) - "
        f"(CAST({by} AS DOUBLE) - CAST({ay} AS DOUBLE)) * ({px} - CAST({ax} AS DOUBLE)) >= 0"
    )


_TRIANGLE_EDGES = [(-116.4, 32.6, -114.6, 32.6), (-114.6, 32.6, -115.5, 33.9), (-115.5, 33.9, -116.4, 32.6)]


@query(
    "within_polygon",
    oracle_with("fields_ll")
    + " SELECT field_id, crop_type FROM fields_ll WHERE "
    + " AND ".join(
        _left_of(px, py, *edge)
        for px in ("minx", "maxx")
        for py in ("miny", "maxy")
        for edge in _TRIANGLE_EDGES
    ),
)
def within_polygon(spark, sf_dir):
    window = polygon_of_wkt(F.lit(_TRIANGLE_WKT))
    near = spread(spark, sf_dir, "fields_ll").where("minx >= -116.4 and maxx <= -114.6 and miny >= 32.6 and maxy <= 33.9")
    return near.where(R.within(R.polygon_of_box(B.box()), window)).select("field_id", "crop_type")


@query(
    "sql_functions",
    oracle_with("fields_ll")
    + f"""
    SELECT field_id, {fixed_sql("(maxx - minx) * (maxy - miny) * 1000000", 4)} AS area_udeg2
    FROM fields_ll
    WHERE minx >= CAST(-116 AS DOUBLE) AND miny >= CAST(32.6 AS DOUBLE)
      AND maxx <= CAST(-114.4 AS DOUBLE) AND maxy <= CAST(33.4 AS DOUBLE) AND year = 2024""",
)
def sql_functions(spark, sf_dir):
    register_sql_functions(spark)
    fields_with_rings(spark, sf_dir, "fields_ll", crs.WGS84).select(
        "field_id", "year", wkb_of_polygon("geom.rings").alias("geometry")
    ).createOrReplaceTempView("fields_of_year")
    return spark.sql(
        f"""
        SELECT field_id, floor(poly_area(poly_from_wkb(geometry)) * 1000000 * 10000D + 0.5D) / 10000D AS area_udeg2
        FROM fields_of_year
        WHERE poly_within_box(poly_from_wkb(geometry), poly_from_wkt('{WINDOW_WKT}')) AND year = 2024"""
    )


@query(
    "bbox_intersects",
    oracle_with("fields_m")
    + """
    SELECT field_id, crop_type, greatest(least(maxx, 60000) - greatest(minx, 40000), CAST(0 AS DOUBLE))
           * greatest(least(maxy, 60000) - greatest(miny, 40000), CAST(0 AS DOUBLE)) AS overlap_m2
    FROM fields_m WHERE minx <= 60000 AND maxx >= 40000 AND miny <= 60000 AND maxy >= 40000""",
)
def bbox_intersects(spark, sf_dir):
    window = B.box_from_corners(60000, 60000, 40000, 40000)
    return fixture(spark, sf_dir, "fields_m").where(B.intersects(B.box(), window)).select(
        "field_id", "crop_type", B.overlap_area(B.box(), window).alias("overlap_m2")
    )


@query(
    "polygon_intersects_polygon",
    oracle_with("fields_ll")
    + " SELECT field_id, crop_type FROM fields_ll WHERE minx <= CAST(-114.6 AS DOUBLE) AND maxx >= CAST(-116.4 AS DOUBLE)"
    + " AND miny <= CAST(33.9 AS DOUBLE) AND maxy >= CAST(32.6 AS DOUBLE) AND "
    + " AND ".join(
        # separating-axis test: some corner of the box is on the inner side of each edge
        "(" + " OR ".join(_left_of(px, py, *edge) for px in ("minx", "maxx") for py in ("miny", "maxy")) + ")"
        for edge in _TRIANGLE_EDGES
    ),
)
def polygon_intersects_polygon(spark, sf_dir):
    window = polygon_of_wkt(F.lit(_TRIANGLE_WKT))
    near = spread(spark, sf_dir, "fields_ll").where("minx <= -114.6 and maxx >= -116.4 and miny <= 33.9 and maxy >= 32.6")
    return near.where(R.intersects(R.polygon_of_box(B.box()), window)).select("field_id", "crop_type")


# --- coordinate systems ------------------------------------------------------

def _utm_sql(lon: str, lat: str, alias: str, source: str, keep: str, central: float = -117.0) -> str:
    """The projection as nested SELECTs: ``keep`` columns plus ``alias``_e and _n."""

    def d(value):
        return f"CAST({value!r} AS DOUBLE)"

    eccentricity = crs._E
    radius = crs.UTM_SCALE * crs.RECTIFYING_RADIUS
    e_terms = "".join(
        f" + {d(a)} * cos(xi * {2.0 * j}) * sinh(eta * {2.0 * j})" for j, a in enumerate(crs.KRUGER_ALPHA, 1)
    )
    n_terms = "".join(
        f" + {d(a)} * sin(xi * {2.0 * j}) * cosh(eta * {2.0 * j})" for j, a in enumerate(crs.KRUGER_ALPHA, 1)
    )
    return f"""
    SELECT {keep}, {d(crs.FALSE_EASTING)} + {d(radius)} * (eta{e_terms}) AS {alias}_e,
           {d(radius)} * (xi{n_terms}) AS {alias}_n
    FROM (SELECT {keep}, atan2(t, cos(dl)) AS xi, asinh(sin(dl) / sqrt(t * t + cos(dl) * cos(dl))) AS eta
          FROM (SELECT {keep}, radians({lon} - {d(central)}) AS dl,
                       sinh(atanh(sin(radians({lat}))) - {d(eccentricity)} * atanh({d(eccentricity)} * sin(radians({lat})))) AS t
                FROM {source}))"""


@query(
    "reproject_points",
    oracle_with("points_ll")
    + f"""
    SELECT point_id, lon, lat, {fixed_sql("p_e", 3)} AS easting, {fixed_sql("p_n", 3)} AS northing
    FROM ({_utm_sql("lon", "lat", "p", "points_ll", "point_id, lon, lat")})""",
)
def reproject_points(spark, sf_dir):
    moved = crs.with_utm(fixture(spark, sf_dir, "points_ll"), "lon", "lat", UTM_11N)
    return moved.select(
        "point_id", "lon", "lat", fixed(F.col("easting"), 3).alias("easting"), fixed(F.col("northing"), 3).alias("northing")
    )


_CORNERS_SQL = """
    corners AS (
      SELECT field_id, crop_type, area_ha, 0 AS k, minx AS lon, miny AS lat FROM fields_ll
      UNION ALL SELECT field_id, crop_type, area_ha, 1, maxx, miny FROM fields_ll
      UNION ALL SELECT field_id, crop_type, area_ha, 2, maxx, maxy FROM fields_ll
      UNION ALL SELECT field_id, crop_type, area_ha, 3, minx, maxy FROM fields_ll),
    moved AS (""" + _utm_sql("lon", "lat", "p", "corners", "field_id, crop_type, area_ha, k") + """),
    rings AS (
      SELECT field_id, any_value(crop_type) AS crop_type, any_value(area_ha) AS area_ha,
             max(CASE WHEN k = 0 THEN p_e END) AS e0, max(CASE WHEN k = 0 THEN p_n END) AS n0,
             max(CASE WHEN k = 1 THEN p_e END) AS e1, max(CASE WHEN k = 1 THEN p_n END) AS n1,
             max(CASE WHEN k = 2 THEN p_e END) AS e2, max(CASE WHEN k = 2 THEN p_n END) AS n2,
             max(CASE WHEN k = 3 THEN p_e END) AS e3, max(CASE WHEN k = 3 THEN p_n END) AS n3
      FROM moved GROUP BY field_id)"""

_RING_AREA_SQL = "abs((e1 - e0) * (n2 - n0) - (e2 - e0) * (n1 - n0) + (e2 - e0) * (n3 - n0) - (e3 - e0) * (n2 - n0)) / 2"


@query(
    "reproject_polygons",
    oracle_with("fields_ll")
    + ","
    + _CORNERS_SQL
    + f"""
    SELECT field_id, {fixed_sql(_RING_AREA_SQL, 2)} AS area_m2,
           {fixed_sql("least(e0, e1, e2, e3)", 3)} AS minx, {fixed_sql("least(n0, n1, n2, n3)", 3)} AS miny,
           {fixed_sql("greatest(e0, e1, e2, e3)", 3)} AS maxx, {fixed_sql("greatest(n0, n1, n2, n3)", 3)} AS maxy
    FROM rings""",
)
def reproject_polygons(spark, sf_dir):
    moved = crs.harmonise_rings(fields_with_rings(spark, sf_dir, "fields_ll", crs.WGS84), UTM_11N)
    extent = moved.withColumn("extent", R.bounds_struct(F.col("geom.rings")))
    return extent.select(
        "field_id",
        fixed(R.area(F.col("geom.rings")), 2).alias("area_m2"),
        *(fixed(F.col(f"extent.{f}"), 3).alias(f) for f in B.BOX_FIELDS),
    )


@query(
    "attr_filter_area_m2",
    oracle_with("fields_ll")
    + ","
    + _CORNERS_SQL
    + f" SELECT field_id, crop_type, {fixed_sql(_RING_AREA_SQL, 2)} AS area_m2 FROM rings WHERE area_ha > CAST(0.5 AS DOUBLE)",
)
def attr_filter_area_m2(spark, sf_dir):
    kept = etl.keep_large_fields(fields_with_rings(spark, sf_dir, "fields_ll", crs.WGS84), UTM_11N)
    return kept.select("field_id", "crop_type", fixed(F.col("area_m2"), 2).alias("area_m2"))


@query(
    "axis_swap_audit",
    oracle_with("points_ll")
    + """
    SELECT point_id, CASE WHEN abs(lon) < 90 THEN CAST(0 AS DOUBLE) END AS axis_error_m,
           abs(lon) >= 90 AS axis_suspect FROM points_ll""",
)
def axis_swap_audit(spark, sf_dir):
    return crs.axis_swap_audit(fixture(spark, sf_dir, "points_ll"), "lon", "lat", UTM_11N).select(
        "point_id", "axis_error_m", "axis_suspect"
    )


_BOTH_ORDERS = (
    _utm_sql("lon", "lat", "r", "near", "point_id, lon, lat", 3.0),
    _utm_sql("lat", "lon", "w", "near", "point_id, lon, lat", 3.0),
)


@query(
    "axis_swap_metres",
    oracle_with("points_ll")
    + f""", near AS (SELECT point_id, lon + 118 AS lon, lat FROM points_ll),
    r AS ({_BOTH_ORDERS[0]}), w AS ({_BOTH_ORDERS[1]}),
    d AS (SELECT point_id, r_e - w_e AS dx, r_n - w_n AS dy FROM r JOIN w USING (point_id))
    SELECT point_id, {fixed_sql("sqrt(dx * dx + dy * dy)", 2)} AS axis_error_m, TRUE AS axis_suspect FROM d""",
)
def axis_swap_metres(spark, sf_dir):
    """Points whose longitude is a possible latitude too: swapped, they are somewhere else, so many metres away."""
    near = fixture(spark, sf_dir, "points_ll").withColumn("lon", F.col("lon") + 118)
    audited = crs.axis_swap_audit(near, "lon", "lat", 32631)
    return audited.select("point_id", fixed(F.col("axis_error_m"), 2).alias("axis_error_m"), "axis_suspect")


@query(
    "crs_harmonise",
    oracle_with("points_ll", "sensors_m")
    + f""", moved AS ({_utm_sql("lon", "lat", "p", "points_ll", "point_id")})
    SELECT 'lonlat' AS source, point_id AS id, 32611 AS srid, {fixed_sql("p_e", 3)} AS x, {fixed_sql("p_n", 3)} AS y FROM moved
    UNION ALL SELECT 'metres', query_id, 32611, x, y FROM sensors_m""",
)
def crs_harmonise(spark, sf_dir):
    lonlat = fixture(spark, sf_dir, "points_ll").selectExpr(
        "'lonlat' as source", "point_id as id", "lon as x", "lat as y", "4326 as srid"
    )
    metres = fixture(spark, sf_dir, "sensors_m").selectExpr(
        "'metres' as source", "query_id as id", "x", "y", "32611 as srid"
    )
    moved = crs.harmonise_points(lonlat.unionByName(metres), UTM_11N)
    return moved.select(
        "source",
        "id",
        "srid",
        *(F.when(F.col("source") == "lonlat", fixed(F.col(c), 3)).otherwise(F.col(c)).alias(c) for c in "xy"),
    )


# --- joins ------------------------------------------------------------------

_DISTANCES_SQL = """
    pairs AS (
      SELECT query_id, field_id, crop_type, sqrt(dx * dx + dy * dy) AS d FROM (
        SELECT query_id, field_id, crop_type, greatest(minx - x, CAST(0 AS DOUBLE), x - maxx) AS dx,
               greatest(miny - y, CAST(0 AS DOUBLE), y - maxy) AS dy
        FROM sensors_m, fields_m)),
    least_d AS (SELECT query_id, min(d) AS d FROM pairs GROUP BY query_id),
    nearest AS (
      SELECT p.query_id, min(p.field_id) AS nearest_poly_id, any_value(p.d) AS distance_m
      FROM pairs p JOIN least_d m ON p.query_id = m.query_id AND p.d = m.d GROUP BY p.query_id)"""


@query(
    "nearest_polygon",
    oracle_with("fields_m", "sensors_m") + "," + _DISTANCES_SQL
    + " SELECT query_id, nearest_poly_id, distance_m FROM nearest",
)
def nearest_polygon(spark, sf_dir):
    return nearest_box(fixture(spark, sf_dir, "sensors_m"), fixture(spark, sf_dir, "fields_m"))


@query(
    "nearest_left_outer",
    oracle_with("fields_m", "sensors_m")
    + "," + _DISTANCES_SQL
    + """ SELECT s.query_id, CASE WHEN s.query_id % 7 <> 0 THEN nearest_poly_id END AS nearest_poly_id,
      CASE WHEN s.query_id % 7 <> 0 THEN distance_m ELSE CAST('Infinity' AS DOUBLE) END AS distance_m
    FROM sensors_m s JOIN nearest n ON s.query_id = n.query_id""",
)
def nearest_left_outer(spark, sf_dir):
    """Every seventh sensor has no position; it keeps its row, unmatched."""
    lost = F.when(F.col("query_id") % 7 != 0, F.col("x"))
    sensors = fixture(spark, sf_dir, "sensors_m").withColumn("x", lost)
    return nearest_box(sensors, fixture(spark, sf_dir, "fields_m"))


@query(
    "nearest_links_top30",
    oracle_with("fields_m", "sensors_m") + "," + _DISTANCES_SQL
    + """
    SELECT query_id, nearest_poly_id, s.x AS from_x, s.y AS from_y,
           (minx + maxx) / 2 AS to_x, (miny + maxy) / 2 AS to_y
    FROM nearest JOIN sensors_m s USING (query_id) JOIN fields_m ON field_id = nearest_poly_id
    ORDER BY query_id LIMIT 30""",
)
def nearest_links_top30(spark, sf_dir):
    # every query keeps its row, so the report's rows are taken first
    sensors = summaries.first_rows(fixture(spark, sf_dir, "sensors_m"), 30, "query_id")
    nearest = nearest_box(sensors, fixture(spark, sf_dir, "fields_m"), carry={f: f for f in B.BOX_FIELDS})
    return nearest.join(sensors, "query_id").select(
        "query_id",
        "nearest_poly_id",
        F.col("x").alias("from_x"),
        F.col("y").alias("from_y"),
        B.centroid_x(B.box()).alias("to_x"),
        B.centroid_y(B.box()).alias("to_y"),
    )


@query(
    "nearest_centroid",
    oracle_with("fields_m", "sensors_m")
    + """, pairs AS (
      SELECT query_id, field_id, sqrt(dx * dx + dy * dy) AS d FROM (
        SELECT query_id, field_id, greatest((minx + maxx) / 2 - x, CAST(0 AS DOUBLE), x - (minx + maxx) / 2) AS dx,
               greatest((miny + maxy) / 2 - y, CAST(0 AS DOUBLE), y - (miny + maxy) / 2) AS dy
        FROM sensors_m, fields_m)),
    least_d AS (SELECT query_id, min(d) AS d FROM pairs GROUP BY query_id)
    SELECT p.query_id, min(p.field_id) AS nearest_poly_id, any_value(p.d) AS distance_m
    FROM pairs p JOIN least_d m ON p.query_id = m.query_id AND p.d = m.d GROUP BY p.query_id""",
)
def nearest_centroid(spark, sf_dir):
    b = B.box()
    spots = fixture(spark, sf_dir, "fields_m").select(
        "field_id",
        B.centroid_x(b).alias("minx"),
        B.centroid_y(b).alias("miny"),
        B.centroid_x(b).alias("maxx"),
        B.centroid_y(b).alias("maxy"),
    )
    return nearest_box(fixture(spark, sf_dir, "sensors_m"), spots)


@query(
    "point_in_polygon",
    oracle_with("fields_m", "sensors_m")
    + """ SELECT query_id, field_id, crop_type FROM sensors_m JOIN fields_m
    ON x BETWEEN minx AND maxx AND y BETWEEN miny AND maxy""",
)
def point_in_polygon(spark, sf_dir):
    fields = fixture(spark, sf_dir, "fields_m").select("field_id", "crop_type", *B.BOX_FIELDS)
    return overlap.points_in_boxes(fixture(spark, sf_dir, "sensors_m").select("query_id", "x", "y"), fields).select(
        "query_id", "field_id", "crop_type"
    )


@query(
    "point_in_ring",
    oracle_with("fields_m", "sensors_m")
    + """ SELECT query_id, field_id FROM sensors_m JOIN fields_m
    ON x BETWEEN minx AND maxx AND y BETWEEN miny AND maxy""",
)
def point_in_ring(spark, sf_dir):
    polygons = fields_with_rings(spark, sf_dir, "fields_m", UTM_11N).select(
        "field_id", F.col("geom.rings").alias("rings")
    )
    points = fixture(spark, sf_dir, "sensors_m").select("query_id", "x", "y")
    return overlap.points_in_polygons(points, polygons, outlines=False).select("query_id", "field_id")


@query(
    "points_in_any_zone",
    oracle_with("fields_m", "sensors_m")
    + """ SELECT query_id, x, y FROM sensors_m s WHERE EXISTS (
      SELECT 1 FROM fields_m WHERE s.x BETWEEN minx AND maxx AND s.y BETWEEN miny AND maxy)""",
)
def points_in_any_zone(spark, sf_dir):
    return overlap.points_in_boxes(
        fixture(spark, sf_dir, "sensors_m"), fixture(spark, sf_dir, "fields_m"), how="semi"
    ).select("query_id", "x", "y")


@query(
    "points_in_no_zone",
    oracle_with("fields_m", "sensors_m")
    + """ SELECT query_id, x, y FROM sensors_m s WHERE NOT EXISTS (
      SELECT 1 FROM fields_m WHERE s.x BETWEEN minx AND maxx AND s.y BETWEEN miny AND maxy)""",
)
def points_in_no_zone(spark, sf_dir):
    return overlap.points_in_boxes(
        fixture(spark, sf_dir, "sensors_m"), fixture(spark, sf_dir, "fields_m"), how="anti"
    ).select("query_id", "x", "y")


@query(
    "points_with_zone_left",
    oracle_with("fields_m", "sensors_m")
    + """ SELECT query_id, field_id FROM sensors_m LEFT JOIN fields_m
    ON x BETWEEN minx AND maxx AND y BETWEEN miny AND maxy""",
)
def points_with_zone_left(spark, sf_dir):
    fields = fixture(spark, sf_dir, "fields_m").select("field_id", *B.BOX_FIELDS)
    return overlap.points_in_boxes(fixture(spark, sf_dir, "sensors_m").select("query_id", "x", "y"), fields, how="left").select(
        "query_id", "field_id"
    )


@query(
    "points_near_fields",
    oracle_with("fields_m", "sensors_m") + "," + _DISTANCES_SQL
    + " SELECT query_id, field_id, d AS distance_m FROM pairs WHERE d <= 500",
)
def points_near_fields(spark, sf_dir):
    fields = fixture(spark, sf_dir, "fields_m").select("field_id", *B.BOX_FIELDS)
    return overlap.points_near_boxes(fixture(spark, sf_dir, "sensors_m").select("query_id", "x", "y"), fields, RADIUS_M).select("query_id", "field_id", "distance_m")


@query(
    "bbox_candidates",
    oracle_with("fields_m", "sensors_m")
    + f""" SELECT query_id, count(field_id) AS n_candidates FROM sensors_m LEFT JOIN fields_m
    ON (minx + maxx) / 2 > x - {CANDIDATE_RADIUS_M} AND (minx + maxx) / 2 < x + {CANDIDATE_RADIUS_M}
    AND (miny + maxy) / 2 > y - {CANDIDATE_RADIUS_M} AND (miny + maxy) / 2 < y + {CANDIDATE_RADIUS_M}
    GROUP BY query_id""",
)
def bbox_candidates(spark, sf_dir):
    return overlap.candidate_counts(
        fixture(spark, sf_dir, "sensors_m"), fixture(spark, sf_dir, "fields_m"), CANDIDATE_RADIUS_M
    )


def _covered_sql() -> str:
    """Area under the 64-gon inside each box, as a sum over outline edges.

    Each edge is cut at the box's left and right side, then split where it
    meets the box's bottom and top; the pieces are trapezoids or rectangles.
    """
    offsets = R.regular_offsets(RADIUS_M)
    rows = ", ".join(
        f"(CAST({ax!r} AS DOUBLE), CAST({ay!r} AS DOUBLE), CAST({bx!r} AS DOUBLE), CAST({by!r} AS DOUBLE))"
        for (ax, ay), (bx, by) in zip(offsets, offsets[1:])
    )
    return f""",
    outline(ax, ay, bx, b_y) AS (VALUES {rows}),
    near AS (
      SELECT query_id, field_id, minx - x AS x0, miny - y AS y0, maxx - x AS x1, maxy - y AS y1
      FROM sensors_m JOIN fields_m
      ON minx <= x + {RADIUS_M} AND maxx >= x - {RADIUS_M} AND miny <= y + {RADIUS_M} AND maxy >= y - {RADIUS_M}),
    cut AS (
      SELECT query_id, field_id, y0, y1, least(greatest(ax, x0), x1) AS xa, least(greatest(bx, x0), x1) AS xb,
             ax, ay, (b_y - ay) / (bx - ax) AS slope FROM near, outline WHERE ax <> bx),
    ends AS (
      SELECT query_id, field_id, y0, y1, xb - xa AS run, ay + (xa - ax) * slope AS p, ay + (xb - ax) * slope AS q
      FROM cut WHERE xa <> xb),
    spans AS (SELECT *, least(p, q) AS lo, greatest(p, q) AS hi FROM ends),
    strips AS (
      SELECT query_id, field_id, run * CASE WHEN hi > lo THEN (
          greatest(least(hi, y0) - lo, CAST(0 AS DOUBLE)) * y0 + greatest(hi - greatest(lo, y1), CAST(0 AS DOUBLE)) * y1
          + (least(greatest(hi, y0), y1) - least(greatest(lo, y0), y1))
            * (least(greatest(hi, y0), y1) + least(greatest(lo, y0), y1)) / 2) / (hi - lo)
        ELSE least(greatest(lo, y0), y1) END AS part FROM spans),
    shared AS (SELECT query_id, field_id, abs(sum(part)) AS m2 FROM strips GROUP BY query_id, field_id),
    covered AS (SELECT query_id, sum(m2) AS m2 FROM shared GROUP BY query_id)"""


@query(
    "buffer_overlap_area",
    oracle_with("fields_m", "sensors_m") + _covered_sql()
    + f""" SELECT query_id, {fixed_sql("coalesce(m2, CAST(0 AS DOUBLE))", 2)} AS nearby_covered_area_m2
    FROM sensors_m LEFT JOIN covered USING (query_id)""",
)
def buffer_overlap_area(spark, sf_dir):
    covered = overlap.covered_area(
        fixture(spark, sf_dir, "sensors_m"), fixture(spark, sf_dir, "fields_m"), RADIUS_M
    )
    return covered.withColumn("nearby_covered_area_m2", fixed(F.col("nearby_covered_area_m2"), 2))


_ZONES_SQL = (
    oracle_with("fields_m", "sensors_m") + "," + _DISTANCES_SQL + _covered_sql()
    + f"""
    SELECT query_id, nearest_poly_id, distance_m AS min_distance_m, crop_type AS nearest_crop,
           {fixed_sql("coalesce(m2, CAST(0 AS DOUBLE))", 2)} AS nearby_covered_area_m2
    FROM nearest JOIN fields_m ON field_id = nearest_poly_id LEFT JOIN covered USING (query_id)"""
)


@query("zone_lookup", _ZONES_SQL)
def zone_lookup_query(spark, sf_dir):
    found = zone_lookup(fixture(spark, sf_dir, "sensors_m"), fixture(spark, sf_dir, "fields_m"))
    return found.withColumn("nearby_covered_area_m2", fixed(F.col("nearby_covered_area_m2"), 2))


@query("stream_zone_lookup", _ZONES_SQL)
def stream_zone_lookup_query(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    stream = (
        spark.readStream.schema(events.schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    )
    readings = stream.selectExpr(
        "event_id as query_id",
        "CAST((event_id * 15485863 + 101) % 1000000 AS DOUBLE) / 10 as x",
        "CAST((event_id * 32452843 + 307) % 1000000 AS DOUBLE) / 10 as y",
    )
    target = shared_path(spark, "zones")
    run = stream_zone_lookup(
        readings, fixture(spark, sf_dir, "fields_m"), target, shared_path(spark, "zones-progress")
    )
    run.awaitTermination()
    found = spark.read.parquet(target).drop("batch")
    return found.withColumn("nearby_covered_area_m2", fixed(F.col("nearby_covered_area_m2"), 2))


# --- tiles -------------------------------------------------------------------

_TILES_SQL = f"""
    extent AS (SELECT min(minx) AS x0, min(miny) AS y0, max(maxx) AS x1, max(maxy) AS y1 FROM fields_m),
    tiled AS (
      SELECT f.*, CAST(
        least(greatest(CAST(trunc(((miny + maxy) / 2 - y0) / ((y1 - y0) / {N_ROWS})) AS INT), 0), {N_ROWS - 1}) * {N_COLS}
        + least(greatest(CAST(trunc(((minx + maxx) / 2 - x0) / ((x1 - x0) / {N_COLS})) AS INT), 0), {N_COLS - 1}) AS INT) AS tile_id
      FROM fields_m f, extent)"""


def _tiled(spark, sf_dir):
    return tiles.assign_tiles(fixture(spark, sf_dir, "fields_m"), N_COLS, N_ROWS)


@query("tile_assign", oracle_with("fields_m") + "," + _TILES_SQL + " SELECT field_id, tile_id FROM tiled")
def tile_assign(spark, sf_dir):
    return _tiled(spark, sf_dir).select("field_id", "tile_id")


_TILE_FEATURES_SQL = oracle_with("fields_m") + "," + _TILES_SQL + """,
    centres AS (SELECT tile_id, avg((minx + maxx) / 2) AS tx, avg((miny + maxy) / 2) AS ty, count(*) AS n FROM tiled GROUP BY tile_id),
    shapes AS (SELECT t.*, (maxx - minx) * (maxy - miny) AS a, 2 * ((maxx - minx) + (maxy - miny)) AS p,
                      (minx + maxx) / 2 AS cx, (miny + maxy) / 2 AS cy FROM tiled t)
    SELECT field_id, crop_type, area_ha, a AS computed_area_m2, a / CAST(10000 AS DOUBLE) AS computed_area_ha,
           p AS perimeter_m, round_even(4 * pi() * a / (p * p) * CAST(1000000 AS DOUBLE), 0) / CAST(1000000 AS DOUBLE) AS compactness,
           cx AS centroid_x, cy AS centroid_y,
           round_even(sqrt((cx - tx) * (cx - tx) + (cy - ty) * (cy - ty)) * CAST(100 AS DOUBLE), 0) / CAST(100 AS DOUBLE) AS dist_to_tile_center_m,
           tile_id AS partition_id, n AS n_in_partition
    FROM shapes JOIN centres USING (tile_id)"""


@query("tile_features", _TILE_FEATURES_SQL)
def tile_features(spark, sf_dir):
    return tiles.tile_features(_tiled(spark, sf_dir))


def _rank_in_tile(frame):
    """A user's function that needs its whole tile: places by area, and each field's share of it."""
    size = (frame["maxx"] - frame["minx"]) * (frame["maxy"] - frame["miny"])
    ordered = frame.assign(area_m2=size).sort_values(["area_m2", "field_id"], ascending=[False, True])
    ordered["place"] = range(1, len(ordered) + 1)
    ordered["above_mean"] = ordered["area_m2"] > size.sum() / len(size)
    return ordered[["tile_id", "field_id", "place", "above_mean"]]


@query(
    "tile_rank",
    oracle_with("fields_m") + "," + _TILES_SQL + """
    SELECT tile_id, field_id, row_number() OVER (PARTITION BY tile_id ORDER BY a DESC, field_id) AS place,
      a > sum(a) OVER (PARTITION BY tile_id) / count(*) OVER (PARTITION BY tile_id) AS above_mean
    FROM (SELECT *, (maxx - minx) * (maxy - miny) AS a FROM tiled)""",
)
def tile_rank(spark, sf_dir):
    schema = "tile_id int, field_id bigint, place bigint, above_mean boolean"
    return tiles.apply_per_tile(_tiled(spark, sf_dir), _rank_in_tile, schema)


def _crop_sums(frame):
    return frame.groupby(["tile_id", "crop_type"], as_index=False).agg(n=("field_id", "size"), last=("field_id", "max"))


def _largest_crop(frame):
    sums = frame.groupby(["tile_id", "crop_type"], as_index=False).agg(n=("n", "sum"), last=("last", "max"))
    return sums.sort_values(["n", "crop_type"], ascending=[False, True]).head(1)


@query(
    "tile_fold",
    oracle_with("fields_m") + "," + _TILES_SQL + """,
    sums AS (SELECT tile_id, crop_type, count(*) AS n, max(field_id) AS last FROM tiled GROUP BY tile_id, crop_type)
    SELECT tile_id, crop_type, n, last FROM sums QUALIFY row_number() OVER (PARTITION BY tile_id ORDER BY n DESC, crop_type) = 1""",
)
def tile_fold(spark, sf_dir):
    schema = "tile_id int, crop_type string, n bigint, last bigint"
    return tiles.fold_per_tile(_tiled(spark, sf_dir), _crop_sums, schema, _largest_crop, schema)


def _chunk_report(frame):
    import pandas as pd

    kept = frame[frame["area_ha"] > etl.MIN_AREA_HA]
    return pd.DataFrame(
        {"chunk": frame["chunk"].iloc[:1], "n_read": len(frame), "n_kept": len(kept), "first_id": frame["field_id"].min(), "last_id": frame["field_id"].max()}
    )


@query(
    "chunk_function",
    oracle_with("fields_ll")
    + """ SELECT CAST(floor((k - 1) / 250) AS BIGINT) AS chunk, count(*) AS n_read,
      count(*) FILTER (WHERE area_ha > CAST(0.5 AS DOUBLE)) AS n_kept, min(field_id) AS first_id, max(field_id) AS last_id
    FROM (SELECT *, row_number() OVER (ORDER BY field_id) AS k FROM fields_ll) GROUP BY 1""",
)
def chunk_function(spark, sf_dir):
    schema = "chunk bigint, n_read bigint, n_kept bigint, first_id bigint, last_id bigint"
    return tiles.apply_per_chunk(fixture(spark, sf_dir, "fields_ll"), _chunk_report, schema, 250, ["field_id"])


@query(
    "tile_occupancy",
    oracle_with("fields_m") + "," + _TILES_SQL
    + f""" SELECT count(*) AS n_tiles, min(n) AS min_features, max(n) AS max_features,
    {fixed_sql("avg(n)", 6)} AS mean_features FROM (SELECT count(*) AS n FROM tiled GROUP BY tile_id)""",
)
def tile_occupancy(spark, sf_dir):
    return tiles.tile_occupancy(_tiled(spark, sf_dir)).withColumn(
        "mean_features", fixed(F.col("mean_features"), 6)
    )


@query(
    "tile_sizes",
    oracle_with("fields_m") + "," + _TILES_SQL + " SELECT tile_id, count(*) AS n_in_tile FROM tiled GROUP BY tile_id",
)
def tile_sizes(spark, sf_dir):
    return tiles.tile_sizes(_tiled(spark, sf_dir))


@query(
    "tile_ids",
    oracle_with("fields_m") + "," + _TILES_SQL + " SELECT DISTINCT tile_id FROM tiled ORDER BY tile_id",
)
def tile_ids(spark, sf_dir):
    return tiles.tile_ids(_tiled(spark, sf_dir))


@query(
    "tile_tasks",
    oracle_with("fields_m") + "," + _TILES_SQL + " SELECT tile_id, count(*) AS n_rows, 1 AS n_tasks FROM tiled GROUP BY tile_id",
)
def tile_tasks(spark, sf_dir):
    """Rows brought together by tile: each tile lies in one task."""
    together = tiles.by_tile(_tiled(spark, sf_dir)).withColumn("task", F.spark_partition_id())
    return together.groupBy("tile_id").agg(F.count("*").alias("n_rows"), F.count_distinct("task").alias("n_tasks"))


@query(
    "tile_sample",
    oracle_with("fields_m") + "," + _TILES_SQL + """ SELECT tile_id, field_id FROM tiled
    QUALIFY row_number() OVER (PARTITION BY tile_id ORDER BY md5('42:' || CAST(field_id AS VARCHAR)), field_id) <= 50""",
)
def tile_sample(spark, sf_dir):
    return tiles.sample_per_tile(_tiled(spark, sf_dir), 50, "field_id").select("tile_id", "field_id")


# --- summaries -------------------------------------------------------------

@query(
    "filter_counts",
    oracle_with("fields_ll")
    + " SELECT count(*) AS n_processed, count(*) FILTER (WHERE area_ha > CAST(0.5 AS DOUBLE)) AS n_filtered FROM fields_ll",
)
def filter_counts(spark, sf_dir):
    return summaries.filter_counts(fixture(spark, sf_dir, "fields_ll"), F.col("area_ha") > etl.MIN_AREA_HA)


@query(
    "total_bounds",
    oracle_with("fields_m") + " SELECT min(minx) AS minx, min(miny) AS miny, max(maxx) AS maxx, max(maxy) AS maxy FROM fields_m",
)
def total_bounds(spark, sf_dir):
    return summaries.extent(fixture(spark, sf_dir, "fields_m"))


@query(
    "bounds_by_partition",
    oracle_with("fields_ll")
    + """ SELECT county, year, count(*) AS n, min(minx) AS minx, min(miny) AS miny, max(maxx) AS maxx, max(maxy) AS maxy
    FROM fields_ll GROUP BY county, year""",
)
def bounds_by_partition(spark, sf_dir):
    return summaries.extent_by(fixture(spark, sf_dir, "fields_ll"), "county", "year")


@query(
    "crop_yield_mean",
    oracle_with("fields_m")
    + f" SELECT crop_type, {fixed_sql('avg(yield_tha)', 6)} AS mean_yield_tha FROM fields_m GROUP BY crop_type",
)
def crop_yield_mean(spark, sf_dir):
    means = summaries.group_mean(fixture(spark, sf_dir, "fields_m"), "crop_type", "yield_tha", "mean_yield_tha")
    return means.withColumn("mean_yield_tha", fixed(F.col("mean_yield_tha"), 6))


@query(
    "crop_value_counts",
    oracle_with("fields_ll") + " SELECT crop_type, count(*) AS n FROM fields_ll GROUP BY crop_type ORDER BY n DESC, crop_type",
)
def crop_value_counts(spark, sf_dir):
    return summaries.value_counts(fixture(spark, sf_dir, "fields_ll"), "crop_type")


@query(
    "metric_mean_max",
    oracle_with("fields_m")
    + f""" SELECT {fixed_sql("avg((maxx - minx) * (maxy - miny))", 3)} AS mean_area_m2,
    max((maxx - minx) * (maxy - miny)) AS max_area_m2 FROM fields_m""",
)
def metric_mean_max(spark, sf_dir):
    a = B.area(B.box())
    return fixture(spark, sf_dir, "fields_m").agg(
        fixed(F.avg(a), 3).alias("mean_area_m2"), F.max(a).alias("max_area_m2")
    )


@query(
    "chunk_statistics",
    oracle_with("fields_ll")
    + """ SELECT field_id // 250 AS chunk, count(*) AS n_features,
    count(*) FILTER (WHERE area_ha > CAST(0.5 AS DOUBLE)) AS n_kept FROM fields_ll GROUP BY 1""",
)
def chunk_statistics(spark, sf_dir):
    fields = summaries.numbered(fixture(spark, sf_dir, "fields_ll"))
    return summaries.chunk_statistics(
        fields, summaries.chunk_of(F.col("row_number")), F.col("area_ha") > etl.MIN_AREA_HA
    )


@query(
    "first_fields",
    oracle_with("fields_ll") + " SELECT field_id, crop_type, county FROM fields_ll ORDER BY field_id LIMIT 5",
)
def first_fields(spark, sf_dir):
    return summaries.first_rows(fixture(spark, sf_dir, "fields_ll"), 5, "field_id").select(
        "field_id", "crop_type", "county"
    )


# --- verification -----------------------------------------------------------

@query(
    "reconcile",
    oracle_with("fields_m")
    + """ SELECT count(*) AS n_left, count(*) AS n_right, 0 AS n_duplicate_keys, count(*) AS n_common, count(*) AS n_match_crop_type,
    count(*) AS n_match_area_m2, CAST(0 AS DOUBLE) AS max_error_area_m2, CAST(100 AS DOUBLE) AS match_pct_crop_type,
    CAST(100 AS DOUBLE) AS match_pct_area_m2, 'MATCH' AS verdict FROM fields_m""",
)
def reconcile(spark, sf_dir):
    fields = fixture(spark, sf_dir, "fields_m")
    by_box = fields.select("field_id", "crop_type", B.area(B.box()).alias("area_m2"))
    by_ring = fields.select("field_id", "crop_type", R.area(R.polygon_of_box(B.box())).alias("area_m2"))
    return verify.reconcile(by_box, by_ring, ["field_id"], ["crop_type"], ["area_m2"])


@query("comparison_report", ORACLES["reconcile"])
def comparison_report(spark, sf_dir):
    path = shared_path(spark, "report")
    verify.comparison_report(reconcile(spark, sf_dir), path)
    return spark.read.json(path)


@query(
    "reconcile_mismatch",
    oracle_with("fields_m")
    + """, a AS (SELECT field_id, crop_type, yield_tha FROM fields_m WHERE area_ha > 20),
    b AS (SELECT field_id, CASE WHEN area_ha > 150 THEN 'rye' ELSE crop_type END AS crop_type,
                 yield_tha + CASE WHEN crop_type = 'corn' THEN CAST(0.5 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS yield_tha
          FROM fields_m WHERE area_ha < 180),
    j AS (SELECT a.field_id AS ka, b.field_id AS kb, a.crop_type AS ca, b.crop_type AS cb, a.yield_tha AS ya, b.yield_tha AS yb
          FROM a FULL OUTER JOIN b ON a.field_id = b.field_id),
    c AS (SELECT count(ka) AS n_left, count(kb) AS n_right, 0 AS n_duplicate_keys, count(*) FILTER (WHERE ka IS NOT NULL AND kb IS NOT NULL) AS n_common,
      count(*) FILTER (WHERE ka IS NOT NULL AND kb IS NOT NULL AND ca = cb) AS n_match_crop_type,
      count(*) FILTER (WHERE ka IS NOT NULL AND kb IS NOT NULL AND abs(ya - yb) <= CAST(1e-8 AS DOUBLE) + CAST(1e-5 AS DOUBLE) * abs(yb)) AS n_match_yield_tha,
      max(abs(ya - yb)) AS max_error_yield_tha FROM j)
    SELECT c.*, n_match_crop_type / n_common * CAST(100 AS DOUBLE) AS match_pct_crop_type,
           n_match_yield_tha / n_common * CAST(100 AS DOUBLE) AS match_pct_yield_tha, 'MISMATCH' AS verdict FROM c""",
)
def reconcile_mismatch(spark, sf_dir):
    fields = fixture(spark, sf_dir, "fields_m")
    changed = fields.where("area_ha < 180").selectExpr(
        "field_id",
        "if(area_ha > 150, 'rye', crop_type) as crop_type",
        "yield_tha + if(crop_type = 'corn', 0.5D, 0D) as yield_tha",
    )
    return verify.reconcile(
        fields.where("area_ha > 20"), changed, ["field_id"], ["crop_type"], ["yield_tha"]
    )


@query(
    "result_differences",
    oracle_with("fields_ll")
    + """ SELECT field_id, crop_type, 'left' AS side FROM fields_ll WHERE area_ha <= CAST(0.5 AS DOUBLE)""",
)
def result_differences(spark, sf_dir):
    fields = fixture(spark, sf_dir, "fields_ll")
    return verify.differences(
        fields.select("field_id", "crop_type"),
        fields.where("area_ha > 0.5").select("field_id", "crop_type"),
    )


# --- storage ------------------------------------------------------------------

_STORED_SQL = " SELECT field_id, crop_type, county, year, area_ha, minx, miny, maxx, maxy FROM fields_ll"
_STORED_PROPERTIES = "field_id bigint, crop_type string, county string, year int, area_ha double"


def _box_columns(df):
    return df.select(
        "field_id", "crop_type", "county", "year", "area_ha", *B.as_columns(B.box_of("bbox"))
    )


@query("wkb_roundtrip", oracle_with("fields_ll") + " SELECT field_id, minx, miny, maxx, maxy, 93 AS n_bytes FROM fields_ll")
def wkb_roundtrip(spark, sf_dir):
    stored = fields_with_rings(spark, sf_dir, "fields_ll", crs.WGS84).select(
        "field_id", wkb_of_polygon("geom.rings").alias("geometry")
    )
    extent = R.bounds_struct(polygon_of_wkb("geometry")).alias("bbox")
    return stored.select("field_id", F.length("geometry").alias("n_bytes"), extent).select(
        "field_id", "n_bytes", *B.as_columns(B.box_of("bbox"))
    )


@query("wkb_points", oracle_with("points_ll") + " SELECT point_id, lon, lat FROM points_ll")
def wkb_points(spark, sf_dir):
    stored = fixture(spark, sf_dir, "points_ll").select("point_id", wkb_of_point("lon", "lat").alias("geometry"))
    return stored.select("point_id", point_of_wkb("geometry").alias("p")).select(
        "point_id", F.col("p.x").alias("lon"), F.col("p.y").alias("lat")
    )


@query("geoparquet_roundtrip", oracle_with("fields_ll") + _STORED_SQL)
def geoparquet_roundtrip(spark, sf_dir):
    path = shared_path(spark, "geoparquet")
    geoparquet.write_geoparquet(fields_with_rings(spark, sf_dir, "fields_ll", crs.WGS84), path, crs.WGS84)
    back = geoparquet.read_geoparquet(spark, path)
    return _box_columns(back.withColumn("bbox", R.bounds_struct(F.col("geom.rings"))))


@query("geoparquet_partitioned", oracle_with("fields_ll") + _STORED_SQL + " WHERE county = 'Imperial'")
def geoparquet_partitioned(spark, sf_dir):
    path = shared_path(spark, "geolake")
    geoparquet.write_geoparquet(
        fields_with_rings(spark, sf_dir, "fields_ll", crs.WGS84),
        path,
        crs.WGS84,
        compression="zstd",
        partition_by=["county", "year"],
    )
    back = geoparquet.read_geoparquet(spark, path, crs.WGS84).where("county = 'Imperial'")
    return _box_columns(back.withColumn("bbox", R.bounds_struct(F.col("geom.rings"))))


@query(
    "geoparquet_mixed_srid",
    oracle_with("fields_ll", "fields_m")
    + """ SELECT field_id, 4326 AS srid, minx, miny, maxx, maxy FROM fields_ll
    UNION ALL SELECT field_id, 32611, minx, miny, maxx, maxy FROM fields_m""",
)
def geoparquet_mixed_srid(spark, sf_dir):
    path = shared_path(spark, "geoparquet")
    degrees = fields_with_rings(spark, sf_dir, "fields_ll", crs.WGS84).select("field_id", "geom", "bbox")
    metres = fields_with_rings(spark, sf_dir, "fields_m", UTM_11N).select("field_id", "geom", "bbox")
    geoparquet.write_geoparquet(degrees.unionByName(metres), path)
    back = geoparquet.read_geoparquet(spark, path).select("field_id", "geom")
    boxed = back.withColumn("bbox", R.bounds_struct(F.col("geom.rings")))
    return boxed.select("field_id", "geom.srid", *B.as_columns(B.box_of("bbox")))


@query(
    "geoparquet_points",
    oracle_with("points_ll") + " SELECT point_id, 4326 AS srid, lon AS x, lat AS y, 'Point' AS kind FROM points_ll",
)
def geoparquet_points(spark, sf_dir):
    path = shared_path(spark, "geoparquet")
    geoparquet.write_geoparquet_points(fixture(spark, sf_dir, "points_ll"), path, crs.WGS84, "lon", "lat")
    kinds = geoparquet.footers(spark, path).select(
        F.get_json_object("geo", "$.columns.geometry.geometry_types[0]").alias("kind")
    )
    back = geoparquet.read_geoparquet_points(spark, path).select("point_id", "srid", "x", "y")
    # one row per kind of geometry
    return back.join(F.broadcast(kinds.distinct()))


@query(
    "geoparquet_metadata",
    oracle_with("fields_ll")
    + """ SELECT count(*) AS n_rows, 4326 AS srid, min(minx) AS minx, min(miny) AS miny, max(maxx) AS maxx, max(maxy) AS maxy
    FROM fields_ll""",
)
def geoparquet_metadata(spark, sf_dir):
    path = shared_path(spark, "geoparquet")
    geoparquet.write_geoparquet(fields_with_rings(spark, sf_dir, "fields_ll", crs.WGS84), path, crs.WGS84)
    return geoparquet.footers(spark, path).groupBy("srid").agg(
        F.sum("n_rows").alias("n_rows"), *B.total_bounds(B.box())
    )


@query("attribute_only_scan", oracle_with("fields_ll") + " SELECT field_id, crop_type, area_ha FROM fields_ll")
def attribute_only_scan(spark, sf_dir):
    path = shared_path(spark, "geoparquet")
    geoparquet.write_geoparquet(fields_with_rings(spark, sf_dir, "fields_ll", crs.WGS84), path, crs.WGS84)
    return geoparquet.read_geoparquet(spark, path, crs.WGS84).select("field_id", "crop_type", "area_ha")


@query(
    "lake_window_scan",
    oracle_with("fields_ll") + _STORED_SQL
    + """ WHERE county = 'Riverside' AND minx <= CAST(-115 AS DOUBLE) AND maxx >= CAST(-116 AS DOUBLE)
    AND miny <= CAST(33.5 AS DOUBLE) AND maxy >= CAST(33 AS DOUBLE)""",
)
def lake_window_scan(spark, sf_dir):
    path = shared_path(spark, "lake")
    lake.write_lake(fields_with_rings(spark, sf_dir, "fields_ll", crs.WGS84), path, ["county", "year"], 0.25)
    rows = spark.read.parquet(path).where("county = 'Riverside'")
    return _box_columns(lake.read_window(rows, (-116.0, 33.0, -115.0, 33.5)))


def _written_geojson(spark, sf_dir):
    path = shared_path(spark, "geojson")
    geojson.write_geojson(
        fields_with_rings(spark, sf_dir, "fields_ll", crs.WGS84),
        path,
        "field_id",
        ["field_id", "crop_type", "county", "year", "area_ha"],
    )
    return path


@query("geojson_roundtrip", oracle_with("fields_ll") + _STORED_SQL)
def geojson_roundtrip(spark, sf_dir):
    return _box_columns(geojson.read_geojson(spark, _written_geojson(spark, sf_dir), _STORED_PROPERTIES, "lines"))


def _feature_collections(spark, sf_dir, id_first: bool, spaced: bool):
    """The fields as collections of one line, one file per crop, as other writers lay them out."""
    fields = fields_with_rings(spark, sf_dir, "fields_ll", crs.WGS84)
    coordinates = geojson.coordinates_of_polygon(F.col("geom.rings"))
    parts = {
        "type": F.lit("Feature"),
        "properties": F.struct("field_id", "crop_type", "county", "year", "area_ha"),
        "geometry": F.struct(F.lit("Polygon").alias("type"), coordinates.alias("coordinates")),
    }
    own_id = {"id": F.col("field_id").cast("string")}
    ordered = {**own_id, **parts} if id_first else {"type": parts["type"], **own_id, **parts}
    text = F.to_json(F.struct(*(value.alias(name) for name, value in ordered.items())))
    if spaced:  # as a dump with default separators has it; no value holds these marks
        text = F.regexp_replace(F.regexp_replace(text, '":', '": '), ',"', ', "')
    path = shared_path(spark, "collections")
    header = F.lit('{"type": "FeatureCollection", "features": [')
    whole = F.concat(header, F.array_join(F.collect_list("text"), ", " if spaced else ","), F.lit("]}"))
    # one file per field_id bucket, so that no file holds more than a bounded share of the table
    bucket = F.floor(F.col("field_id") / 5000)
    fields.select(bucket.alias("bucket"), text.alias("text")).groupBy("bucket").agg(whole.alias("value")).select(
        "value"
    ).write.text(path)
    return path


def _read_collections(spark, path, layout=None):
    return _box_columns(geojson.read_geojson(spark, path, _STORED_PROPERTIES, layout))


@query("geojson_collection", oracle_with("fields_ll") + _STORED_SQL)
def geojson_collection(spark, sf_dir):
    return _read_collections(spark, _feature_collections(spark, sf_dir, id_first=False, spaced=True))


@query("geojson_compact", oracle_with("fields_ll") + _STORED_SQL)
def geojson_compact(spark, sf_dir):
    return _read_collections(spark, _feature_collections(spark, sf_dir, id_first=False, spaced=False))


@query("geojson_id_first", oracle_with("fields_ll") + _STORED_SQL)
def geojson_id_first(spark, sf_dir):
    return _read_collections(spark, _feature_collections(spark, sf_dir, id_first=True, spaced=True))


@query("geojson_document", oracle_with("fields_ll") + _STORED_SQL)
def geojson_document(spark, sf_dir):
    return _read_collections(spark, _feature_collections(spark, sf_dir, id_first=False, spaced=True), "document")


def _ingested(spark, path):
    target = shared_path(spark, "ingested")
    run = ingest_geojson(spark, path, target, shared_path(spark, "ingest-progress"), _STORED_PROPERTIES, UTM_11N)
    run.awaitTermination()
    return spark.read.parquet(target).select("field_id", "crop_type", fixed(F.col("area_m2"), 2).alias("area_m2"))


@query("stream_geojson_ingest", ORACLES["attr_filter_area_m2"])
def stream_geojson_ingest(spark, sf_dir):
    return _ingested(spark, _written_geojson(spark, sf_dir))


@query("stream_geojson_collection", ORACLES["attr_filter_area_m2"])
def stream_geojson_collection(spark, sf_dir):
    return _ingested(spark, _feature_collections(spark, sf_dir, id_first=True, spaced=True))


@query("chunked_etl", ORACLES["attr_filter_area_m2"])
def chunked_etl(spark, sf_dir):
    features = geojson.read_geojson(spark, _written_geojson(spark, sf_dir), _STORED_PROPERTIES, "lines")
    target = shared_path(spark, "etl")
    geoparquet.write_geoparquet(etl.keep_large_fields(features, UTM_11N), target, crs.WGS84)
    return spark.read.parquet(target).select("field_id", "crop_type", fixed(F.col("area_m2"), 2).alias("area_m2"))


@query(
    "lake_etl",
    oracle_with("fields_m")
    + """, zones AS (SELECT s_suppkey AS zone_id, CAST((s_suppkey * 7919) % 90000 AS DOUBLE) AS zx, CAST((s_suppkey * 104729) % 90000 AS DOUBLE) AS zy FROM supplier),
    hits AS (SELECT field_id, min(zone_id) AS zone_id FROM fields_m JOIN zones
      ON (minx + maxx) / 2 BETWEEN zx AND zx + 10000 AND (miny + maxy) / 2 BETWEEN zy AND zy + 10000 GROUP BY field_id)
    SELECT field_id, crop_type, (maxx - minx) * (maxy - miny) AS area_m2, zone_id, TRUE AS is_valid
    FROM fields_m LEFT JOIN hits USING (field_id) WHERE maxx > minx AND maxy > miny
    UNION ALL SELECT field_id, crop_type, NULL, NULL, FALSE FROM fields_m WHERE NOT (maxx > minx AND maxy > miny)""",
)
def lake_etl(spark, sf_dir):
    zones = table(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey as zone_id",
        "CAST((s_suppkey * 7919) % 90000 AS DOUBLE) as minx",
        "CAST((s_suppkey * 104729) % 90000 AS DOUBLE) as miny",
        "CAST((s_suppkey * 7919) % 90000 AS DOUBLE) + 10000 as maxx",
        "CAST((s_suppkey * 104729) % 90000 AS DOUBLE) + 10000 as maxy",
    )
    fields = fields_with_rings(spark, sf_dir, "fields_m", UTM_11N).select("field_id", "crop_type", "geom")
    path, rejected = shared_path(spark, "lake"), shared_path(spark, "rejected")
    etl.lake_load([fields], UTM_11N, zones, path, ["crop_type"], 25_000.0, rejected)
    valid = spark.read.parquet(path).select(
        "field_id", "crop_type", "area_m2", "zone_id", F.lit(True).alias("is_valid")
    )
    refused = spark.read.parquet(rejected).select("field_id", "crop_type", F.lit(False).alias("is_valid"))
    return lake.combined(valid, refused)


@query(
    "schema_evolution_union",
    oracle_with("fields_ll")
    + " SELECT field_id, crop_type, CASE WHEN year = 2025 THEN area_ha END AS area_ha FROM fields_ll",
)
def schema_evolution_union(spark, sf_dir):
    fields = fixture(spark, sf_dir, "fields_ll")
    older, newer = shared_path(spark, "older"), shared_path(spark, "newer")
    fields.where("year < 2025").select("field_id", "crop_type").write.parquet(older)
    fields.where("year = 2025").select("field_id", "crop_type", "area_ha").write.parquet(newer)
    return lake.read_evolved(spark, older, newer).select("field_id", "crop_type", "area_ha")


@query(
    "source_union",
    oracle_with("fields_ll", "fields_m")
    + """ SELECT field_id, crop_type, county, CAST(NULL AS DOUBLE) AS yield_tha FROM fields_ll
    UNION ALL SELECT field_id, crop_type, NULL, yield_tha FROM fields_m""",
)
def source_union(spark, sf_dir):
    return lake.combined(
        fixture(spark, sf_dir, "fields_ll").select("field_id", "crop_type", "county"),
        fixture(spark, sf_dir, "fields_m").select("field_id", "crop_type", "yield_tha"),
    )


@query(
    "short_names",
    oracle_with("fields_ll") + " SELECT field_id, crop_type, area_ha AS computed_a FROM fields_ll",
)
def short_names(spark, sf_dir):
    return lake.short_names(
        fixture(spark, sf_dir, "fields_ll").selectExpr("field_id", "crop_type", "area_ha as computed_area_ha")
    )


@query(
    "written_once",
    oracle_with("fields_ll")
    + """ SELECT field_id, CASE field_id % 3 WHEN 0 THEN 'north' WHEN 1 THEN 'east' ELSE 'south' END AS part FROM fields_ll""",
)
def written_once(spark, sf_dir):
    """The second write finds the first one's files and leaves them."""
    path = shared_path(spark, "once")
    parts = fixture(spark, sf_dir, "fields_ll").select(
        "field_id", pick(["north", "east", "south"], F.col("field_id")).alias("part")
    )
    lake.write_once(parts, path)
    return lake.write_once(parts.withColumn("part", F.lit("other")), path)


@query("size_audit")
def size_audit(spark, sf_dir):
    framed = fields_with_rings(spark, sf_dir, "fields_ll", crs.WGS84)
    paths = {"geojson": _written_geojson(spark, sf_dir)}
    for codec in geoparquet.CODECS:
        paths[f"geoparquet_{codec}"] = shared_path(spark, f"sizes-{codec}")
        geoparquet.write_geoparquet(framed, paths[f"geoparquet_{codec}"], crs.WGS84, compression=codec)
    return lake.size_audit(spark, paths, "geojson")


from parcelgrid.plans import shape_queries  # noqa: E402, F401  registers its queries with the above
