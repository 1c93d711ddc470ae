"""Exact nearest polygon for every query point, for outlines of any shape and length.

Outlines are cut into stretches of a few edges, and the stretches are placed on
the pyramid of ``nearest``: their extents bound the distance from below, their
first vertices from above. What is left for a group of points is a handful of
stretches, and only those are measured edge by edge. So a long outline costs no
more than the part of it that is near, and never travels whole. Points inside a
polygon are found first, by its grid of edges, and are at distance 0; only the
others look for stretches.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelgrid.functions import ring as R
from parcelgrid.functions.box import Box, box
from parcelgrid.functions.edges import distance_to_edges
from parcelgrid.operators.edge_grid import edge_cells, points_in_rings
from parcelgrid.operators.nearest import BoxPyramid, _farthest, build_pyramid, points_and_candidates
from parcelgrid.operators.spots import located
from parcelgrid.session import materialise

#: Edges per stretch.
STRETCH = 8


@dataclass(frozen=True)
class RingIndex:
    """Stretches on a pyramid, and the grids of edges: build once, query many times."""

    pyramid: BoxPyramid
    cells: tuple[DataFrame, DataFrame]


def stretches(polygons: DataFrame, polygon_id: str, rings: str) -> DataFrame:
    """``field_id, edges`` and the extent of each stretch, with its first vertex and a fingerprint."""
    cut = lambda es: F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(es), F.lit(1)), F.lit(STRETCH)), lambda i: F.slice(es, i, STRETCH)
    )
    each = polygons.select(F.col(polygon_id).alias("field_id"), F.explode(rings).alias("ring"))
    parts = each.where("size(ring) > 1").select("field_id", F.explode(R.let(R.edges(F.col("ring")), cut)).alias("edges"))

    def over(fold, choose, c: str) -> Column:
        return fold(F.transform("edges", lambda e: choose(e["a"][c], e["b"][c])))

    extent = {
        "minx": over(F.array_min, F.least, "x"),
        "miny": over(F.array_min, F.least, "y"),
        "maxx": over(F.array_max, F.greatest, "x"),
        "maxy": over(F.array_max, F.greatest, "y"),
    }
    first = F.get("edges", F.lit(0))["a"]
    return parts.withColumns(extent).withColumns(
        {
            "vx": first["x"],
            "vy": first["y"],
            # 128 bits: stretches of equal ones are copies
            "mark": F.struct(F.xxhash64("edges"), F.xxhash64(F.lit(1), "edges")),
        }
    )


def build_stretches(polygons: DataFrame, polygon_id: str, rings: str) -> BoxPyramid:
    return build_pyramid(stretches(polygons, polygon_id, rings), "field_id", ["edges", "vx", "vy"], ["mark"])


def build_ring_index(polygons: DataFrame, polygon_id: str = "field_id", rings: str = "rings") -> RingIndex:
    """Place the stretches and grids of all polygons."""
    return RingIndex(build_stretches(polygons, polygon_id, rings), edge_cells(polygons, polygon_id, rings))


def nearest_ring(
    queries: DataFrame,
    polygons: DataFrame | RingIndex,
    query_id: str = "query_id",
    polygon_id: str = "field_id",
    rings: str = "rings",
    x: str = "x",
    y: str = "y",
) -> DataFrame:
    """``query_id, nearest_poly_id, distance_m``: the polygon nearest to each point, the lowest id on ties.

    The distance is 0 inside a polygon and on its outline; in a hole it is that
    to the nearest outline. ``query_id`` must be unique. Every query keeps its
    row: without any polygon, or without a finite position, the id is NULL and
    the distance infinite. Null and empty polygons are never nearest.
    """
    index = polygons if isinstance(polygons, RingIndex) else None
    cells = index.cells if index else edge_cells(polygons, polygon_id, rings)
    points = located(queries, query_id, x, y)
    inside = points_in_rings(points, cells, "query_id", "poly_id").groupBy("query_id").agg(F.min("poly_id").alias("poly_id"))
    inside = materialise(inside, "inside")
    # wider than its file's size tells: never broadcast by that estimate
    outside = materialise(points.join(inside.select("query_id").hint("merge"), "query_id", "left_anti"), "outside")
    best = inside.select("query_id", F.struct(F.lit(0.0).alias("d"), "poly_id").alias("best"))
    if not outside.isEmpty():
        pyramid = index.pyramid if index else build_stretches(polygons, polygon_id, rings)
        vertex = Box(F.col("item.vx"), F.col("item.vy"), F.col("item.vx"), F.col("item.vy"))
        pairs = points_and_candidates(outside, pyramid, _farthest(box("g_"), vertex))
        measured = pairs.select("query_id", "item.poly_id", distance_to_edges("item.edges", "x", "y").alias("d"))
        found = F.when(F.col("poly_id").isNotNull(), F.struct("d", "poly_id"))
        best = best.unionByName(measured.select("query_id", found.alias("best")))
    best = best.groupBy("query_id").agg(F.min("best").alias("best"))
    return best.select(
        F.col("query_id").alias(query_id),
        F.col("best.poly_id").alias("nearest_poly_id"),
        F.coalesce(F.col("best.d"), F.lit(float("inf"))).alias("distance_m"),
    )
