"""Area that a figure about each point shares with polygons of any shape."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelgrid.functions import ring as R
from parcelgrid.functions.box import BOX_FIELDS, around_point, box, box_from_corners, intersects
from parcelgrid.functions.edges import areas_shared, intersection_area
from parcelgrid.operators.overlap import by_place, cell_pairs, list_boxes
from parcelgrid.session import materialise

#: Vertices of an outline that is carried to the points.
SHORT = 64


def square(reach: float) -> Callable[[Column, Column], Column]:
    """A square about a point, as a polygon."""
    return lambda x, y: R.polygon_of_box(box_from_corners(x - reach, y - reach, x + reach, y + reach))


def shared_areas(
    points: DataFrame,
    polygons: DataFrame,
    reach: float,
    figure: Callable[[Column, Column], Column],
    point_id: str = "query_id",
    polygon_id: str = "field_id",
    rings: str = "rings",
    x: str = "x",
    y: str = "y",
) -> DataFrame:
    """``point_id, polygon_id, shared_m2`` for every pair whose extents meet.

    ``figure`` gives the polygon about a point, which reaches no farther than
    ``reach`` along either axis. Holes and concave outlines count as they are.
    Outlines of few vertices meet the points by place, in an Arrow kernel, and no pair is
    shuffled. Long ones stay at home: their pairs are found by extents, and they join them afterwards, by polygon.
    """
    every = polygons.select(F.col(polygon_id).alias("poly_id"), F.col(rings).alias("rings"))
    every = every.withColumn("extent", R.bounds_struct(F.col("rings"))).select("poly_id", "rings", "extent.*")
    # worked out once, for the many jobs that place them
    every = materialise(every, "outlines")
    extent = every.where("minx IS NOT NULL").drop("rings")
    own = points.select(F.col(point_id).alias("query_id"), F.col(x).alias("x"), F.col(y).alias("y"))
    own = own.where("x IS NOT NULL AND y IS NOT NULL AND NOT isnan(x) AND NOT isnan(y)")
    vertices = F.aggregate("rings", F.lit(0), lambda n, ring: n + F.greatest(F.coalesce(F.size(ring), F.lit(0)), F.lit(0)))
    is_short = F.coalesce(vertices <= SHORT, F.lit(False))
    # outlines are wider than their source's file size tells: never broadcast by that estimate
    outlines = every.select("poly_id", "rings").hint("merge")
    short = areas_by_place(own, extent.join(outlines.where(is_short), "poly_id"), reach, figure)
    long = outlines.where(~is_short)
    extent = extent.join(long.select("poly_id").distinct().hint("merge"), "poly_id", "left_semi")
    ids = [F.col("query_id").alias(point_id), F.col("poly_id").alias(polygon_id)]
    return short.unionByName(areas_by_polygon(own, extent, long, reach, figure)).select(*ids, "shared_m2")


def areas_by_place(points: DataFrame, polygons: DataFrame, reach: float, figure: Callable[[Column, Column], Column]) -> DataFrame:
    """``query_id, poly_id, shared_m2`` of points (query_id, x, y) and polygons (poly_id, rings, extent) of few vertices."""
    left, right, keys = by_place(points, list_boxes(polygons, reach))
    # figures are made where they are used: they would be most of what is shuffled
    tasks = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    left = left.repartition(tasks, *keys).withColumn("figure", figure(F.col("x"), F.col("y")))
    left = left.withColumns({c: F.col(c).cast("double") for c in "xy"})
    schema = T.StructType([points.schema["query_id"], polygons.schema["poly_id"], T.StructField("shared_m2", T.DoubleType())])
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(areas_shared(reach), schema)


def areas_by_polygon(
    points: DataFrame, extent: DataFrame, outlines: DataFrame, reach: float, figure: Callable[[Column, Column], Column]
) -> DataFrame:
    """The same for outlines (poly_id, rings) of any length, apart from their extents (poly_id, sides)."""
    near = intersects(box(), around_point(F.col("x"), F.col("y"), reach))
    met = cell_pairs(points, extent, near, reach).drop(*BOX_FIELDS)
    area = intersection_area(figure(F.col("x"), F.col("y")), F.col("rings"))
    return met.join(outlines.hint("merge"), "poly_id").select("query_id", "poly_id", area.alias("shared_m2"))
