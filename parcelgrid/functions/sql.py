"""Geometry helpers callable from SQL text.

The native ones are SQL functions: Spark puts their body into the plan, so
they prune, push down and compile like hand-written expressions. Only the WKB
reader runs as an Arrow UDF.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from parcelgrid.functions.ring import RINGS_TYPE
from parcelgrid.functions.wkb import polygon_of_wkb
from parcelgrid.functions.wkt import EMPTY_TEXT, POLYGON_TEXT

# name -> (parameters, return type, body)
SQL_FUNCTIONS = {
    "box_area": ("minx DOUBLE, miny DOUBLE, maxx DOUBLE, maxy DOUBLE", "DOUBLE", "(maxx - minx) * (maxy - miny)"),
    "box_within": (
        "minx DOUBLE, miny DOUBLE, maxx DOUBLE, maxy DOUBLE, "
        "wminx DOUBLE, wminy DOUBLE, wmaxx DOUBLE, wmaxy DOUBLE",
        "BOOLEAN",
        "minx >= wminx AND miny >= wminy AND maxx <= wmaxx AND maxy <= wmaxy",
    ),
    "box_intersects": (
        "minx DOUBLE, miny DOUBLE, maxx DOUBLE, maxy DOUBLE, "
        "wminx DOUBLE, wminy DOUBLE, wmaxx DOUBLE, wmaxy DOUBLE",
        "BOOLEAN",
        "minx <= wmaxx AND maxx >= wminx AND miny <= wmaxy AND maxy >= wminy",
    ),
    "poly_area": (
        f"rings {RINGS_TYPE}",
        "DOUBLE",
        """aggregate(
             transform(rings, (r, k) -> if(k = 0, 1D, -1D) * abs(aggregate(
               sequence(1, greatest(size(r) - 1, 1)), 0D,
               (acc, i) -> acc + coalesce(
                 (r[i - 1].x - r[0].x) * (get(r, i).y - r[0].y)
                 - (get(r, i).x - r[0].x) * (r[i - 1].y - r[0].y), 0D))) / 2D),
             0D, (acc, a) -> acc + a)""",
    ),
    "poly_minx": (f"rings {RINGS_TYPE}", "DOUBLE", "array_min(transform(rings[0], p -> p.x))"),
    "poly_miny": (f"rings {RINGS_TYPE}", "DOUBLE", "array_min(transform(rings[0], p -> p.y))"),
    "poly_maxx": (f"rings {RINGS_TYPE}", "DOUBLE", "array_max(transform(rings[0], p -> p.x))"),
    "poly_maxy": (f"rings {RINGS_TYPE}", "DOUBLE", "array_max(transform(rings[0], p -> p.y))"),
    "poly_from_wkt": (
        "wkt STRING",
        RINGS_TYPE,
        rf"""CASE WHEN wkt IS NULL THEN NULL
             WHEN wkt RLIKE r'{POLYGON_TEXT}' THEN transform(regexp_extract_all(wkt, r'\(([^()]+)\)', 1),
               r -> transform(split(r, ','), p -> named_struct(
                 'x', CAST(split(regexp_replace(p, r'^\s+|\s+$', ''), r'\s+')[0] AS DOUBLE),
                 'y', CAST(split(regexp_replace(p, r'^\s+|\s+$', ''), r'\s+')[1] AS DOUBLE))))
             WHEN wkt RLIKE r'{EMPTY_TEXT}' THEN CAST(array() AS {RINGS_TYPE})
             ELSE CAST(raise_error(concat('not a polygon: ', substring(wkt, 1, 80))) AS {RINGS_TYPE}) END""",
    ),
    # the window must be an axis-aligned box, as in a map view; any other raises
    "poly_within_box": (
        f"rings {RINGS_TYPE}, win {RINGS_TYPE}",
        "BOOLEAN",
        """CASE WHEN size(win) = 1 AND size(win[0]) = 5
               AND size(array_distinct(transform(win[0], w -> w.x))) = 2
               AND size(array_distinct(transform(win[0], w -> w.y))) = 2
               AND size(array_distinct(win[0])) = 4
               AND forall(sequence(1, 4), i -> win[0][i].x = win[0][i - 1].x OR win[0][i].y = win[0][i - 1].y)
             THEN forall(rings[0], p ->
               p.x >= array_min(transform(win[0], w -> w.x)) AND p.x <= array_max(transform(win[0], w -> w.x))
               AND p.y >= array_min(transform(win[0], w -> w.y)) AND p.y <= array_max(transform(win[0], w -> w.y)))
             WHEN win IS NULL OR rings IS NULL THEN NULL
             ELSE CAST(raise_error('the window is not an axis-aligned box') AS BOOLEAN) END""",
    ),
}


def register_sql_functions(spark: SparkSession) -> None:
    """Make the helpers available to ``spark.sql`` in this session."""
    for name, (parameters, returns, body) in SQL_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {returns} RETURN {body}")
    spark.udf.register("poly_from_wkb", polygon_of_wkb)
