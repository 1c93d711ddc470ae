"""Well-known text and GeoJSON coordinate arrays to and from polygons."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from parcelgrid.functions.ring import GEOMETRY_TYPE, RINGS_TYPE, close_ring

# Fixed value: how the text form of a polygon starts.
_POLYGON = re.compile(r"^\s*POLYGON\s*\(\s*(\(.*\))\s*\)\s*$", re.IGNORECASE | re.DOTALL)


# Text of a polygon with rings, and of one without.
POLYGON_TEXT = r"(?is)^\s*POLYGON\s*\(\s*\([^()]+\)\s*(,\s*\([^()]+\)\s*)*\)\s*$"
EMPTY_TEXT = r"(?i)^\s*POLYGON\s+EMPTY\s*$"


def polygon_of_wkt(text: Column) -> Column:
    """Rings of ``POLYGON((x y, …), (…))`` text; any other text raises, NULL stays NULL."""
    ring_texts = F.regexp_extract_all(text, F.lit(r"\(([^()]+)\)"), F.lit(1))

    def vertex(pair):
        parts = F.split(F.regexp_replace(pair, r"^\s+|\s+$", ""), r"\s+")
        return F.struct(
            F.get(parts, F.lit(0)).cast("double").alias("x"),
            F.get(parts, F.lit(1)).cast("double").alias("y"),
        )

    rings = F.transform(ring_texts, lambda r: F.transform(F.split(r, ","), vertex))
    refused = F.raise_error(F.concat(F.lit("not a polygon: "), F.substring(text, 1, 80))).cast(RINGS_TYPE)
    return (
        F.when(text.isNull(), F.lit(None))
        .when(text.rlike(POLYGON_TEXT), rings)
        .when(text.rlike(EMPTY_TEXT), F.array().cast(RINGS_TYPE))
        .otherwise(refused)
    )


def window_of_wkt(text: str) -> tuple[float, float, float, float] | None:
    """Bounds of a constant polygon if it is an axis-aligned box, else None."""
    found = _POLYGON.match(text)
    if not found:
        raise ValueError(f"not a polygon: {text!r}")
    rings = re.findall(r"\(([^()]+)\)", found.group(1))
    vertices = [tuple(map(float, pair.split()[:2])) for pair in rings[0].split(",")]
    xs, ys = sorted({x for x, _ in vertices}), sorted({y for _, y in vertices})
    corners = {(x, y) for x in xs for y in ys}
    steps_straight = all(a[0] == b[0] or a[1] == b[1] for a, b in zip(vertices, vertices[1:]))
    if len(rings) == 1 and len(xs) == len(ys) == 2 and set(vertices) == corners and steps_straight:
        return xs[0], ys[0], xs[1], ys[1]
    return None


def polygon_of_coordinates(coordinates: Column) -> Column:
    """Rings of GeoJSON ``coordinates``; open rings are closed."""

    def ring(positions):
        return close_ring(
            F.transform(
                positions,
                lambda p: F.struct(F.get(p, F.lit(0)).alias("x"), F.get(p, F.lit(1)).alias("y")),
            )
        )

    return F.transform(coordinates, ring)


def coordinates_of_polygon(rings: Column) -> Column:
    """GeoJSON ``coordinates`` of a polygon."""
    return F.transform(
        rings, lambda r: F.transform(r, lambda p: F.array(p.getField("x"), p.getField("y")))
    )


def tagged(rings: Column, srid: int | Column) -> Column:
    """A geometry struct carrying its coordinate system."""
    return F.struct(F.lit(srid).alias("srid"), rings.alias("rings")).cast(GEOMETRY_TYPE)
