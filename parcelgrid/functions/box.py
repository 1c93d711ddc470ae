"""Geometry of axis-aligned boxes as whole-stage-codegen arithmetic.

A box is four DOUBLE columns. Every function takes a :class:`Box` of Column
expressions, so boxes may come from top-level columns, from a ``bbox`` struct
(whose fields Parquet prunes by) or from constants.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

from parcelgrid.functions.scalar import lit_double

#: Straight pieces per quarter circle in a buffer outline (fixed value).
QUADRANT_SEGMENTS = 16


class Box(NamedTuple):
    minx: Column
    miny: Column
    maxx: Column
    maxy: Column


BOX_FIELDS = Box._fields


def box(prefix: str = "") -> Box:
    """The box in columns ``{prefix}minx`` … ``{prefix}maxy``."""
    return Box(*(F.col(prefix + name) for name in BOX_FIELDS))


def box_of(struct_name: str) -> Box:
    """The box in the fields of a struct column."""
    return Box(*(F.col(f"{struct_name}.{name}") for name in BOX_FIELDS))


def box_from_corners(x0, y0, x1, y1) -> Box:
    """A box from any two opposite corners; inverted input is put in order."""
    x0, y0, x1, y1 = (lit_double(v) for v in (x0, y0, x1, y1))
    return Box(F.least(x0, x1), F.least(y0, y1), F.greatest(x0, x1), F.greatest(y0, y1))


def as_struct(b: Box) -> Column:
    return F.struct(*(value.alias(name) for value, name in zip(b, BOX_FIELDS)))


def as_columns(b: Box, prefix: str = "") -> list[Column]:
    return [value.alias(prefix + name) for value, name in zip(b, BOX_FIELDS)]


def width(b: Box) -> Column:
    return b.maxx - b.minx


def height(b: Box) -> Column:
    return b.maxy - b.miny


def area(b: Box) -> Column:
    return width(b) * height(b)


def length(b: Box) -> Column:
    return F.lit(2.0) * (width(b) + height(b))


def centroid_x(b: Box) -> Column:
    return (b.minx + b.maxx) / F.lit(2.0)


def centroid_y(b: Box) -> Column:
    return (b.miny + b.maxy) / F.lit(2.0)


def compactness(area_col: Column, length_col: Column) -> Column:
    """4·pi·A / P², NULL for a zero perimeter."""
    squared = length_col * length_col
    return F.when(length_col != 0, F.lit(4.0) * F.pi() * area_col / squared)


def distance_to_point(b: Box, x, y) -> Column:
    """0 on or inside the box, else the distance to its boundary; NULL without a box."""
    x, y = lit_double(x), lit_double(y)
    zero = F.lit(0.0)
    dx = F.greatest(b.minx - x, zero, x - b.maxx)
    dy = F.greatest(b.miny - y, zero, y - b.maxy)
    # greatest() passes over NULLs, so a missing box has to be kept apart
    return F.when(b.minx.isNotNull() & x.isNotNull(), F.sqrt(dx * dx + dy * dy))


def gap(a: Box, b: Box) -> Column:
    """Smallest distance between any two points of two boxes."""
    zero = F.lit(0.0)
    dx = F.greatest(a.minx - b.maxx, zero, b.minx - a.maxx)
    dy = F.greatest(a.miny - b.maxy, zero, b.miny - a.maxy)
    return F.sqrt(dx * dx + dy * dy)


def reach(a: Box, b: Box) -> Column:
    """Largest distance from any point of ``a`` to its nearest point of ``b``."""
    zero = F.lit(0.0)
    dx = F.greatest(b.minx - a.minx, zero, a.maxx - b.maxx)
    dy = F.greatest(b.miny - a.miny, zero, a.maxy - b.maxy)
    return F.sqrt(dx * dx + dy * dy)


def contains_point(b: Box, x, y) -> Column:
    """Closed containment: the boundary counts as inside."""
    x, y = lit_double(x), lit_double(y)
    return x.between(b.minx, b.maxx) & y.between(b.miny, b.maxy)


def strictly_contains_point(b: Box, x, y) -> Column:
    """Open containment: the boundary is outside."""
    x, y = lit_double(x), lit_double(y)
    return (x > b.minx) & (x < b.maxx) & (y > b.miny) & (y < b.maxy)


def within(b: Box, window: Box) -> Column:
    """The box lies in the window; boundaries may touch."""
    return (
        (b.minx >= window.minx)
        & (b.miny >= window.miny)
        & (b.maxx <= window.maxx)
        & (b.maxy <= window.maxy)
    )


def intersects(a: Box, b: Box) -> Column:
    """The closed boxes share at least one point."""
    return (
        (a.minx <= b.maxx) & (a.maxx >= b.minx) & (a.miny <= b.maxy) & (a.maxy >= b.miny)
    )


def overlap(a: Box, b: Box) -> Box:
    """The common box; only meaningful where the boxes intersect."""
    return Box(
        F.greatest(a.minx, b.minx),
        F.greatest(a.miny, b.miny),
        F.least(a.maxx, b.maxx),
        F.least(a.maxy, b.maxy),
    )


def overlap_area(a: Box, b: Box) -> Column:
    common = overlap(a, b)
    zero = F.lit(0.0)
    shared = F.greatest(width(common), zero) * F.greatest(height(common), zero)
    return F.when(a.minx.isNotNull() & b.minx.isNotNull(), shared)


def expand(b: Box, by) -> Box:
    by = lit_double(by)
    return Box(b.minx - by, b.miny - by, b.maxx + by, b.maxy + by)


def around_point(x, y, radius) -> Box:
    x, y, radius = lit_double(x), lit_double(y), lit_double(radius)
    return Box(x - radius, y - radius, x + radius, y + radius)


def is_known(b: Box) -> Column:
    """Every side is there and finite (NULL, NaN and infinities are not)."""
    limit = F.lit(float("inf"))
    # NaN sorts above infinity, so one comparison covers all three
    known = [F.coalesce(F.abs(v) < limit, F.lit(False)) for v in b]
    return known[0] & known[1] & known[2] & known[3]


def is_valid(b: Box) -> Column:
    """Finite and of positive width and height."""
    return is_known(b) & (b.maxx > b.minx) & (b.maxy > b.miny)


def buffer_area(b: Box, d: float) -> Column:
    """Area of the outline at distance ``d`` with 16 straight pieces per corner."""
    if d < 0:
        raise ValueError("only buffers outwards are supported")
    pieces = 2 * QUADRANT_SEGMENTS
    corners = pieces * math.sin(math.pi / pieces) * d * d
    return area(b) + length(b) * F.lit(float(d)) + F.lit(corners)


def total_bounds(b: Box, prefix: str = "") -> list[Column]:
    """Aggregates giving the extent of all boxes."""
    return [
        F.min(b.minx).alias(prefix + "minx"),
        F.min(b.miny).alias(prefix + "miny"),
        F.max(b.maxx).alias(prefix + "maxx"),
        F.max(b.maxy).alias(prefix + "maxy"),
    ]
