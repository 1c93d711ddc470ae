"""Geometry of polygons given as rings, as JVM-side higher-order functions.

A polygon is ``ARRAY<ARRAY<STRUCT<x: DOUBLE, y: DOUBLE>>>``: the shell first,
holes after it, every ring closed (last vertex equal to the first).
Area and length are planar, in units of the coordinates.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from parcelgrid.functions.box import Box, QUADRANT_SEGMENTS, as_struct
from parcelgrid.functions.scalar import lit_double
from parcelgrid.functions.simple import rings_are_simple

VERTEX_TYPE = "struct<x:double,y:double>"
RING_TYPE = f"array<{VERTEX_TYPE}>"
RINGS_TYPE = f"array<{RING_TYPE}>"
GEOMETRY_TYPE = f"struct<srid:int,rings:{RINGS_TYPE}>"


def vertex(x, y) -> Column:
    return F.struct(lit_double(x).alias("x"), lit_double(y).alias("y"))


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and use it several times inside ``body``."""
    return F.element_at(F.transform(F.array(value), body), 1)


def close_ring(ring: Column) -> Column:
    """Append the first vertex where the ring does not end on it."""

    def closed(r):
        first, last = F.get(r, F.lit(0)), F.get(r, F.size(r) - 1)
        is_open = (first.getField("x") != last.getField("x")) | (
            first.getField("y") != last.getField("y")
        )
        return F.when(is_open, F.concat(r, F.array(first))).otherwise(r)

    return let(ring, closed)


def polygon(*rings: Column) -> Column:
    return F.array(*(close_ring(r) for r in rings))


def polygon_of_box(b: Box) -> Column:
    """The box as a closed five-vertex shell, from its lower left corner."""
    return F.array(
        F.array(
            vertex(b.minx, b.miny),
            vertex(b.maxx, b.miny),
            vertex(b.maxx, b.maxy),
            vertex(b.minx, b.maxy),
            vertex(b.minx, b.miny),
        )
    )


def geometry(rings: Column, srid: int) -> Column:
    return F.struct(F.lit(srid).alias("srid"), rings.alias("rings"))


def shell(rings: Column) -> Column:
    return F.get(rings, F.lit(0))


def holes(rings: Column) -> Column:
    return F.slice(rings, F.lit(2), F.greatest(F.size(rings) - 1, F.lit(0)))


def xs(ring: Column) -> Column:
    return F.transform(ring, lambda p: p.getField("x"))


def ys(ring: Column) -> Column:
    return F.transform(ring, lambda p: p.getField("y"))


def bounds(rings: Column) -> Box:
    """The extent of the shell."""
    outer = shell(rings)
    return Box(
        F.array_min(xs(outer)), F.array_min(ys(outer)), F.array_max(xs(outer)), F.array_max(ys(outer))
    )


def bounds_struct(rings: Column) -> Column:
    """The extent as a struct, with the polygon evaluated once."""
    return let(rings, lambda r: as_struct(bounds(r)))


def edges(ring: Column) -> Column:
    """``ARRAY<STRUCT<a: vertex, b: vertex>>`` over consecutive vertices."""

    def pairs(r):
        n = F.greatest(F.size(r) - 1, F.lit(0))
        return F.zip_with(
            F.slice(r, F.lit(1), n),
            F.slice(r, F.lit(2), n),
            lambda a, b: F.struct(a.alias("a"), b.alias("b")),
        )

    return let(ring, pairs)


def _fold(ring: Column, term) -> Column:
    """Sum ``term(ax, ay, bx, by)`` over the edges of a ring."""
    return F.aggregate(
        edges(ring),
        F.lit(0.0),
        lambda acc, e: acc
        + term(
            e.getField("a").getField("x"),
            e.getField("a").getField("y"),
            e.getField("b").getField("x"),
            e.getField("b").getField("y"),
        ),
    )


def signed_ring_area(ring: Column) -> Column:
    """Shoelace sum about the first vertex; positive when counter-clockwise."""

    def about_first(r):
        ox, oy = F.get(r, F.lit(0)).getField("x"), F.get(r, F.lit(0)).getField("y")
        doubled = _fold(
            r, lambda ax, ay, bx, by: (ax - ox) * (by - oy) - (bx - ox) * (ay - oy)
        )
        return doubled / F.lit(2.0)

    return let(ring, about_first)


def ring_length(ring: Column) -> Column:
    return _fold(
        ring,
        lambda ax, ay, bx, by: F.sqrt((bx - ax) * (bx - ax) + (by - ay) * (by - ay)),
    )


def _sum_rings(rings: Column, per_ring) -> Column:
    return F.aggregate(rings, F.lit(0.0), lambda acc, r: acc + per_ring(r))


def area(rings: Column) -> Column:
    """Shell area less hole areas, whatever the ring orientation."""
    return let(
        rings,
        lambda g: F.abs(signed_ring_area(shell(g)))
        - _sum_rings(holes(g), lambda r: F.abs(signed_ring_area(r))),
    )


def length(rings: Column) -> Column:
    """Boundary length over all rings."""
    return _sum_rings(rings, ring_length)


def _moments(ring: Column) -> Column:
    """(area, x moment, y moment) about the first vertex, unsigned, in one pass."""

    def about_first(r):
        first = F.get(r, F.lit(0))
        ox, oy = first.getField("x"), first.getField("y")
        zero = F.struct(F.lit(0.0).alias("a"), F.lit(0.0).alias("mx"), F.lit(0.0).alias("my"))

        def add(acc, e):
            ax, ay = e.getField("a").getField("x") - ox, e.getField("a").getField("y") - oy
            bx, by = e.getField("b").getField("x") - ox, e.getField("b").getField("y") - oy
            cross = ax * by - bx * ay
            return F.struct(
                (acc.getField("a") + cross).alias("a"),
                (acc.getField("mx") + cross * (ax + bx)).alias("mx"),
                (acc.getField("my") + cross * (ay + by)).alias("my"),
            )

        def absolute(m):
            size = F.abs(m.getField("a")) / F.lit(2.0)
            sign = F.signum(m.getField("a")) / F.lit(6.0)
            return F.struct(
                size.alias("a"),
                (size * ox + sign * m.getField("mx")).alias("mx"),
                (size * oy + sign * m.getField("my")).alias("my"),
            )

        return F.aggregate(edges(r), zero, add, absolute)

    return let(ring, about_first)


def centroid(rings: Column) -> Column:
    """Area-weighted centre ``STRUCT<x, y>``, holes taken off.

    Without area the shell counts by length, and a single place is its own centre.
    """

    def line_centre(g):
        def mid(axis):
            def term(ax, ay, bx, by):
                seg = F.sqrt((bx - ax) * (bx - ax) + (by - ay) * (by - ay))
                return seg * ((ax + bx) if axis == "x" else (ay + by)) / F.lit(2.0)

            return term

        along = ring_length(shell(g))
        first = F.get(shell(g), F.lit(0))
        return F.when(
            along > 0,
            vertex(_fold(shell(g), mid("x")) / along, _fold(shell(g), mid("y")) / along),
        ).otherwise(first)

    def balanced(g):
        parts = F.transform(g, _moments)

        def total(ms, field):
            outer = F.get(ms, F.lit(0)).getField(field)
            return outer - F.aggregate(
                F.slice(ms, F.lit(2), F.greatest(F.size(ms) - 1, F.lit(0))),
                F.lit(0.0),
                lambda acc, m: acc + m.getField(field),
            )

        sums = let(
            parts,
            lambda ms: F.struct(*(total(ms, f).alias(f) for f in ("a", "mx", "my"))),
        )
        return let(
            sums,
            lambda t: F.when(
                t.getField("a") > 0,
                vertex(t.getField("mx") / t.getField("a"), t.getField("my") / t.getField("a")),
            ).otherwise(line_centre(g)),
        )

    return let(rings, balanced)


def centroid_x(rings: Column) -> Column:
    return centroid(rings).getField("x")


def centroid_y(rings: Column) -> Column:
    return centroid(rings).getField("y")


def _on_segment_distance2(ax, ay, bx, by, x, y) -> Column:
    dx, dy = bx - ax, by - ay
    span = dx * dx + dy * dy
    along = ((x - ax) * dx + (y - ay) * dy) / F.nullif(span, F.lit(0.0))
    t = F.least(F.greatest(F.coalesce(along, F.lit(0.0)), F.lit(0.0)), F.lit(1.0))
    ex, ey = x - (ax + t * dx), y - (ay + t * dy)
    # ``t`` is rounded: a point on the segment would come out beside it
    within = lambda v, a, b: (v >= F.least(a, b)) & (v <= F.greatest(a, b))
    on = within(x, ax, bx) & within(y, ay, by) & (dx * (y - ay) - dy * (x - ax) == 0)
    return F.when(on, F.lit(0.0)).otherwise(ex * ex + ey * ey)


def _crossings(ring: Column, x: Column, y: Column) -> Column:
    """How often a ray to the right of the point crosses the ring."""
    return _fold(
        ring,
        lambda ax, ay, bx, by: F.when(
            ((ay > y) != (by > y)) & (x < (bx - ax) * (y - ay) / F.nullif(by - ay, F.lit(0.0)) + ax),
            F.lit(1.0),
        ).otherwise(F.lit(0.0)),
    )


def interior_contains_point(rings: Column, x, y) -> Column:
    """Even-odd test over all rings; the boundary itself is undecided."""
    x, y = lit_double(x), lit_double(y)
    return F.pmod(_sum_rings(rings, lambda r: _crossings(r, x, y)), F.lit(2.0)) == 1.0


def boundary_distance(rings: Column, x, y) -> Column:
    x, y = lit_double(x), lit_double(y)
    nearest = F.array_min(
        F.transform(
            F.flatten(F.transform(rings, edges)),
            lambda e: _on_segment_distance2(
                e.getField("a").getField("x"),
                e.getField("a").getField("y"),
                e.getField("b").getField("x"),
                e.getField("b").getField("y"),
                x,
                y,
            ),
        )
    )
    return F.sqrt(nearest)


def distance_to_point(rings: Column, x, y) -> Column:
    """0 on or inside the polygon, else the distance to its boundary."""
    return let(
        rings,
        lambda g: F.when(interior_contains_point(g, x, y), F.lit(0.0)).otherwise(
            boundary_distance(g, x, y)
        ),
    )


def contains_point(rings: Column, x, y) -> Column:
    """Closed containment: the boundary counts as inside."""
    return distance_to_point(rings, x, y) == 0.0


def _turn(ax, ay, bx, by, cx, cy) -> Column:
    return F.signum((bx - ax) * (cy - ay) - (by - ay) * (cx - ax))


def _segments_touch(p, q) -> Column:
    """Two closed segments share a point."""
    ax, ay = p.getField("a").getField("x"), p.getField("a").getField("y")
    bx, by = p.getField("b").getField("x"), p.getField("b").getField("y")
    cx, cy = q.getField("a").getField("x"), q.getField("a").getField("y")
    dx, dy = q.getField("b").getField("x"), q.getField("b").getField("y")
    boxes_meet = (
        (F.least(ax, bx) <= F.greatest(cx, dx))
        & (F.least(cx, dx) <= F.greatest(ax, bx))
        & (F.least(ay, by) <= F.greatest(cy, dy))
        & (F.least(cy, dy) <= F.greatest(ay, by))
    )
    return (
        boxes_meet
        & (_turn(ax, ay, bx, by, cx, cy) * _turn(ax, ay, bx, by, dx, dy) <= 0)
        & (_turn(cx, cy, dx, dy, ax, ay) * _turn(cx, cy, dx, dy, bx, by) <= 0)
    )


def _ring_is_closed(ring: Column) -> Column:
    first, last = F.get(ring, F.lit(0)), F.element_at(ring, -1)
    return (
        (F.size(ring) >= 4)
        & (first.getField("x") == last.getField("x"))
        & (first.getField("y") == last.getField("y"))
    )


def _ring_is_finite(ring: Column) -> Column:
    big = F.lit(float("inf"))
    return F.forall(
        ring,
        lambda p: p.getField("x").isNotNull()
        & p.getField("y").isNotNull()
        & ~F.isnan(p.getField("x"))
        & ~F.isnan(p.getField("y"))
        & (F.abs(p.getField("x")) < big)
        & (F.abs(p.getField("y")) < big),
    )


def is_valid(rings: Column) -> Column:
    """Closed finite simple rings of positive area, each hole inside the shell.

    Whether rings are simple is worked out in Arrow batches, the rest in place.
    """
    # repeated vertices are allowed: they are dropped before corners are counted
    def distinct_run(ring):
        return F.filter(
            ring,
            lambda p, i: (i == 0)
            | (F.get(ring, i - 1).getField("x") != p.getField("x"))
            | (F.get(ring, i - 1).getField("y") != p.getField("y")),
        )

    def ring_ok(ring):
        return F.when(~_ring_is_closed(ring) | ~_ring_is_finite(ring), F.lit(False)).otherwise(
            let(distinct_run(ring), lambda r: (F.size(r) >= 4) & (signed_ring_area(r) != 0))
        )

    def holes_inside(g):
        """Hole outlines stay in the shell and do not overlap one another."""
        outer = F.slice(g, 1, 1)
        inner = holes(g)
        pairs = F.flatten(
            F.transform(
                inner, lambda h, i: F.transform(F.slice(inner, i + 2, F.size(inner)), lambda k: F.struct(h.alias("h"), k.alias("k")))
            )
        )
        return F.forall(inner, lambda h: _outline_inside(h, outer)) & ~F.exists(
            pairs, lambda p: _rings_overlap(p.getField("h"), p.getField("k"))
        )

    return (
        F.when(rings.isNull(), F.lit(None).cast("boolean"))
        .when(F.size(rings) == 0, F.lit(False))
        .when(~F.forall(rings, ring_ok), F.lit(False))
        .when(~rings_are_simple(rings), F.lit(False))
        .when(F.size(rings) == 1, F.lit(True))
        .otherwise(let(rings, holes_inside))
    )


def _properly_cross(p, q) -> Column:
    """Two segments cross at a point inside both."""
    ax, ay = p.getField("a").getField("x"), p.getField("a").getField("y")
    bx, by = p.getField("b").getField("x"), p.getField("b").getField("y")
    cx, cy = q.getField("a").getField("x"), q.getField("a").getField("y")
    dx, dy = q.getField("b").getField("x"), q.getField("b").getField("y")
    return (_turn(ax, ay, bx, by, cx, cy) * _turn(ax, ay, bx, by, dx, dy) < 0) & (
        _turn(cx, cy, dx, dy, ax, ay) * _turn(cx, cy, dx, dy, bx, by) < 0
    )


def _any_edge_pair(rings: Column, other: Column, test) -> Column:
    ours = F.flatten(F.transform(rings, edges))
    theirs = F.flatten(F.transform(other, edges))
    return let(
        theirs, lambda qs: F.exists(ours, lambda p: F.exists(qs, lambda q: test(p, q)))
    )


def intersects(rings: Column, other: Column) -> Column:
    """The closed polygons share a point: outlines touch or one holds the other."""

    def first(g):
        return F.get(shell(g), F.lit(0))

    return (
        _any_edge_pair(rings, other, _segments_touch)
        | contains_point(other, first(rings).getField("x"), first(rings).getField("y"))
        | contains_point(rings, first(other).getField("x"), first(other).getField("y"))
    )


def _middle(e: Column, name: str) -> Column:
    return (e.getField("a").getField(name) + e.getField("b").getField(name)) / F.lit(2.0)


def _cut_points(e: Column, corners: Column) -> Column:
    """Where along an edge, from 0 to 1, it touches one of the corners; with both ends, in order."""
    ax, ay = e.getField("a").getField("x"), e.getField("a").getField("y")
    bx, by = e.getField("b").getField("x"), e.getField("b").getField("y")
    along_x = F.abs(bx - ax) >= F.abs(by - ay)

    def on_edge(p):
        x, y = p.getField("x"), p.getField("y")
        between = (
            (x >= F.least(ax, bx)) & (x <= F.greatest(ax, bx)) & (y >= F.least(ay, by)) & (y <= F.greatest(ay, by))
        )
        return between & (_turn(ax, ay, bx, by, x, y) == 0)

    def place(p):
        whole = F.when(along_x, bx - ax).otherwise(by - ay)
        part = F.when(along_x, p.getField("x") - ax).otherwise(p.getField("y") - ay)
        return F.when(whole == 0, F.lit(0.0)).otherwise(part / whole)

    touched = F.transform(F.filter(corners, on_edge), place)
    return F.array_sort(F.array_distinct(F.concat(F.array(F.lit(0.0), F.lit(1.0)), touched)))


def _outline_inside(ring: Column, window: Column) -> Column:
    """The whole outline lies in the closed window.

    No edge crosses the window's, so an edge can leave it only at a corner that
    it touches: edges are cut there, and each piece is tested by its middle.
    """
    corners = F.flatten(window)

    def edge_inside(e):
        ax, ay = e.getField("a").getField("x"), e.getField("a").getField("y")
        bx, by = e.getField("b").getField("x"), e.getField("b").getField("y")

        def pieces_inside(ts):
            steps = F.zip_with(
                F.slice(ts, F.lit(1), F.size(ts) - 1), F.slice(ts, F.lit(2), F.size(ts) - 1), lambda s, t: (s + t) / F.lit(2.0)
            )
            return F.forall(steps, lambda t: contains_point(window, ax + t * (bx - ax), ay + t * (by - ay)))

        return contains_point(window, ax, ay) & let(_cut_points(e, corners), pieces_inside)

    return F.forall(edges(ring), edge_inside) & ~_any_edge_pair(F.array(ring), window, _properly_cross)


def _any_corner_or_middle(ring: Column, test) -> Column:
    return F.exists(
        edges(ring),
        lambda e: test(e.getField("a").getField("x"), e.getField("a").getField("y"))
        | test(_middle(e, "x"), _middle(e, "y")),
    )


def _all_on_outline(ring: Column, other: Column) -> Column:
    """Every corner and edge middle lies on the other ring."""
    outline = F.array(other)
    return ~_any_corner_or_middle(ring, lambda x, y: boundary_distance(outline, x, y) != 0.0)


def _rings_overlap(one: Column, two: Column) -> Column:
    """The insides of two simple rings share an area."""
    first, second = F.array(one), F.array(two)
    return (
        _any_edge_pair(first, second, _properly_cross)
        | _any_corner_or_middle(one, lambda x, y: strictly_inside(second, x, y))
        | _any_corner_or_middle(two, lambda x, y: strictly_inside(first, x, y))
        | _all_on_outline(one, two)
    )


def strictly_inside(rings: Column, x, y) -> Column:
    """Inside and not on the boundary."""
    return interior_contains_point(rings, x, y) & (boundary_distance(rings, x, y) > 0.0)


def within(rings: Column, window: Column) -> Column:
    """The polygon lies in the closed window, and no hole of the window lies in it."""

    def hole_outside(h):
        covers = _any_corner_or_middle(h, lambda x, y: strictly_inside(rings, x, y))
        return ~(covers | _all_on_outline(h, shell(rings)))

    return _outline_inside(shell(rings), window) & F.forall(holes(window), hole_outside)


def _mean_clamped(p: Column, q: Column, low: Column, high: Column) -> Column:
    """Mean of ``u`` limited to [low, high] while u runs evenly from p to q."""
    lo, hi = F.least(p, q), F.greatest(p, q)
    below = F.greatest(F.least(hi, low) - lo, F.lit(0.0))
    above = F.greatest(hi - F.greatest(lo, high), F.lit(0.0))
    a, b = F.least(F.greatest(lo, low), high), F.least(F.greatest(hi, low), high)
    return F.when(hi > lo, (below * low + above * high + (b - a) * (a + b) / F.lit(2.0)) / (hi - lo)).otherwise(a)


def _strip(ax, ay, bx, by, b: Box) -> Column:
    """Integral of y limited to the box, over the edge's part inside the box's x range."""
    xa = F.least(F.greatest(ax, b.minx), b.maxx)
    xb = F.least(F.greatest(bx, b.minx), b.maxx)
    slope = (by - ay) / (bx - ax)
    ends = F.struct((ay + (xa - ax) * slope).alias("p"), (ay + (xb - ax) * slope).alias("q"))
    mean = let(ends, lambda u: _mean_clamped(u.getField("p"), u.getField("q"), b.miny, b.maxy))
    return F.when(xa == xb, F.lit(0.0)).otherwise((xb - xa) * mean)


def clipped_ring_area(ring: Column, b: Box) -> Column:
    """Area a simple ring shares with a box, by Green's theorem over its edges.

    The closed integral of y dx, with x and y limited to the box, counts just
    the part inside the box; no clipped outline is ever built.
    """
    return F.abs(_fold(ring, lambda ax, ay, bx, by: _strip(ax, ay, bx, by, b)))


def clipped_area(rings: Column, b: Box) -> Column:
    """Area of polygon ∩ box, holes taken off; the polygon need not be convex."""
    return let(
        rings,
        lambda g: clipped_ring_area(shell(g), b)
        - _sum_rings(holes(g), lambda r: clipped_ring_area(r, b)),
    )


def regular_offsets(radius: float, quadrant_segments: int = QUADRANT_SEGMENTS) -> list[tuple[float, float]]:
    """Vertices, relative to the centre, of the polygon that stands for a round buffer."""
    n = 4 * quadrant_segments
    steps = [2.0 * math.pi * k / n for k in range(n)]
    outline = [(radius * math.cos(t), radius * math.sin(t)) for t in steps]
    return outline + outline[:1]


def buffer_point(x, y, radius: float) -> Column:
    """The 64-gon inscribed in the circle about a point, as a polygon."""
    x, y = lit_double(x), lit_double(y)
    return F.array(F.array(*(vertex(x + dx, y + dy) for dx, dy in regular_offsets(radius))))


def buffer_point_area(radius: float) -> float:
    n = 4 * QUADRANT_SEGMENTS
    return n / 2 * math.sin(2 * math.pi / n) * radius * radius


class BufferOutline:
    """Closed forms for the polygon that stands for a round buffer.

    The outline is symmetric about both axes, so its overlap with a box is the
    signed sum of four rectangles from the centre to the box's corners. A
    rectangle whose corner lies inside the outline counts whole; otherwise it
    is the quarter outline less the tails beyond the corner's x and its y.
    """

    def __init__(self, radius: float):
        delta = 2 * math.pi / (4 * QUADRANT_SEGMENTS)
        self.radius, self.step = F.lit(float(radius)), F.lit(delta)
        self.wedge = F.lit(radius * radius * math.sin(delta) / 2)
        self.quarter = F.lit(QUADRANT_SEGMENTS * (radius * radius * math.sin(delta) / 2))
        self.inner = F.lit(radius * math.cos(delta / 2))

    def clipped(self, side: Column) -> Column:
        """Distance of a box side from the centre line, at most the radius."""
        return F.when(side.isNotNull(), F.least(F.abs(side), self.radius))

    def piece(self, a: Column) -> Column:
        """Number of the outline's edge above ``a``, counted from the x axis."""
        k = F.floor(F.acos(a / self.radius) / self.step)
        return F.when(a.isNotNull(), F.least(k, F.lit(QUADRANT_SEGMENTS - 1)))

    def height(self, a: Column, k: Column) -> Column:
        """Height of the outline above ``a``."""
        middle = (k + 0.5) * self.step
        return (self.inner - a * F.cos(middle)) / F.sin(middle)

    def tail(self, a: Column, k: Column, h: Column) -> Column:
        """Area of the quarter outline beyond ``a``."""
        start = k * self.step
        last = self.radius * (F.cos(start) * h - F.sin(start) * a)
        return k * self.wedge + (last - a * h) / F.lit(2.0)

    def corner(self, a, h_a, t_a, c, h_c, t_c) -> Column:
        """Overlap with the rectangle from the centre to (a, c)."""
        return F.when(a <= h_c, a * c).otherwise(self.quarter - t_a - t_c)

    def missed(self, x0, y0, x1, y1) -> Column:
        r = self.radius
        return (x0 >= r) | (y0 >= r) | (x1 <= -r) | (y1 <= -r)


def _ccw(ring: Column) -> Column:
    return F.when(signed_ring_area(ring) < 0, F.reverse(ring)).otherwise(ring)


def _direction_change(p, q) -> Column:
    """Angle from edge ``p`` to the next edge ``q``, positive to the left."""
    ux = p.getField("b").getField("x") - p.getField("a").getField("x")
    uy = p.getField("b").getField("y") - p.getField("a").getField("y")
    vx = q.getField("b").getField("x") - q.getField("a").getField("x")
    vy = q.getField("b").getField("y") - q.getField("a").getField("y")
    return F.atan2(ux * vy - uy * vx, ux * vx + uy * vy)


def buffer_convex(rings: Column, d: float) -> Column:
    """Outline at distance ``d`` around a convex polygon without holes.

    Edges move out by ``d``; each corner becomes an arc of straight pieces, 16
    to a quarter circle. Concave shells and polygons with holes raise.
    """
    if d <= 0:
        raise ValueError("only buffers outwards are supported")
    quantum = math.pi / 2 / QUADRANT_SEGMENTS
    dist = F.lit(float(d))

    def corner(e, i):
        p, q = F.get(e, i), F.get(e, F.pmod(i + 1, F.size(e)))
        ux = p.getField("b").getField("x") - p.getField("a").getField("x")
        uy = p.getField("b").getField("y") - p.getField("a").getField("y")
        # the outward normal of a counter-clockwise edge points to its right
        facts = F.struct(
            p.getField("b").alias("at"),
            F.atan2(-ux, uy).alias("start"),
            _direction_change(p, q).alias("turn"),
        )
        return let(facts, arc)

    def arc(c):
        turn = F.when(
            c.getField("turn") < -1e-9,
            F.raise_error(F.lit("buffer_convex: concave polygon")).cast("double"),
        ).otherwise(F.greatest(c.getField("turn"), F.lit(0.0)))
        pieces = F.greatest(F.floor(turn / F.lit(quantum) + 0.5).cast("int"), F.lit(1))
        steps = F.transform(
            F.sequence(F.lit(0), pieces), lambda k: c.getField("start") + turn * k / pieces
        )
        return F.transform(
            steps,
            lambda t: vertex(
                c.getField("at").getField("x") + dist * F.cos(t),
                c.getField("at").getField("y") + dist * F.sin(t),
            ),
        )

    def has_length(e):
        a, b = e.getField("a"), e.getField("b")
        return (a.getField("x") != b.getField("x")) | (a.getField("y") != b.getField("y"))

    def outline(ring):
        return let(
            F.filter(edges(let(ring, _ccw)), has_length),
            lambda e: F.flatten(
                F.transform(F.sequence(F.lit(0), F.size(e) - 1), lambda i: corner(e, i))
            ),
        )

    return let(
        rings,
        lambda g: F.when(
            F.size(g) > 1,
            F.raise_error(F.lit("buffer_convex: polygon with holes")).cast(RINGS_TYPE),
        ).otherwise(F.array(close_ring(outline(shell(g))))),
    )
