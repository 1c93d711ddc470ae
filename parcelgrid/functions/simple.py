"""Whether rings are simple: no two edges meet but neighbours in their vertex.

Short rings of a batch are compared edge by edge, all of them at once. The edges
of a long ring are listed by the cells of a grid, and only those that share a
cell are compared, so for outlines of short edges the work grows with their
number. Long edges side by side share many cells and cost more, never a verdict.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelgrid.functions.edges import EDGES_PER_CELL, MOST_CELLS, PAIRS_AT_ONCE, Edges, Grid, spread

#: Edges up to which a ring is compared without a grid.
SHORT = 64


def turn(ax, ay, bx, by, cx, cy):
    return (bx - ax) * (cy - ay) - (by - ay) * (cx - ax)


def touch(e: Edges, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether closed edges share a point, pair by pair."""
    ax, ay, bx, by = e.ax[i], e.ay[i], e.bx[i], e.by[i]
    cx, cy, dx, dy = e.ax[j], e.ay[j], e.bx[j], e.by[j]
    meet = (np.minimum(ax, bx) <= np.maximum(cx, dx)) & (np.minimum(cx, dx) <= np.maximum(ax, bx))
    meet &= (np.minimum(ay, by) <= np.maximum(cy, dy)) & (np.minimum(cy, dy) <= np.maximum(ay, by))
    near = np.flatnonzero(meet)
    ax, ay, bx, by, cx, cy, dx, dy = (v[near] for v in (ax, ay, bx, by, cx, cy, dx, dy))
    both = turn(ax, ay, bx, by, cx, cy) * turn(ax, ay, bx, by, dx, dy) <= 0
    meet[near] = both & (turn(cx, cy, dx, dy, ax, ay) * turn(cx, cy, dx, dy, bx, by) <= 0)
    return meet


def distinct_edges(rings: pa.Array) -> tuple[Edges, np.ndarray, np.ndarray]:
    """Edges of every ring without repeated vertices, the number of edges of each ring, and its polygon."""
    per_row = pc.fill_null(pc.list_value_length(rings), 0).to_numpy(zero_copy_only=False)
    every = rings.flatten()
    per_ring = pc.fill_null(pc.list_value_length(every), 0).to_numpy(zero_copy_only=False)
    corners = every.flatten()
    x, y = (pc.struct_field(corners, c).to_numpy(zero_copy_only=False).astype(float) for c in "xy")
    ring = np.repeat(np.arange(len(per_ring)), per_ring)
    kept = np.r_[True, (ring[1:] != ring[:-1]) | (x[1:] != x[:-1]) | (y[1:] != y[:-1])][: len(ring)]
    x, y, ring = x[kept], y[kept], ring[kept]
    start = np.flatnonzero(ring[1:] == ring[:-1])
    of = ring[start]
    edges = Edges(x[start], y[start], x[start + 1], y[start + 1], of, np.ones(len(start)), len(per_ring))
    return edges, np.bincount(of, minlength=len(per_ring)), np.repeat(np.arange(len(rings)), per_row)


def folding(e: Edges, sizes: np.ndarray) -> np.ndarray:
    """Per ring, whether some edge runs back over the one before."""
    first = np.cumsum(sizes) - sizes
    here = np.arange(len(e.ax))
    after = np.where(here == (first + sizes - 1)[e.row], first[e.row], here + 1)
    cx, cy = e.bx[after], e.by[after]
    back = (e.bx - e.ax) * (cx - e.bx) + (e.by - e.ay) * (cy - e.by) < 0
    back &= turn(e.ax, e.ay, e.bx, e.by, cx, cy) == 0
    return np.bincount(e.row, back, len(sizes)) > 0


def crossing_short(e: Edges, sizes: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """Per ring, whether edges that are no neighbours touch; for the chosen rings, by all their pairs."""
    first = np.cumsum(sizes) - sizes
    bad = np.zeros(len(sizes), bool)
    own = np.flatnonzero(chosen[e.row])
    number = own - first[e.row[own]]
    # the first edge and the last are neighbours too
    last = sizes[e.row[own]] - 1 - (number == 0)
    pairs = np.cumsum(np.maximum(last - number - 1, 0))
    cuts = np.searchsorted(pairs, np.arange(0, pairs[-1] if len(pairs) else 0, PAIRS_AT_ONCE), "right")
    for start, end in zip(cuts, [*cuts[1:], len(own)]):
        which, j = spread(number[start:end] + 2, last[start:end])
        i = own[start:end][which]
        hit = touch(e, i, first[e.row[i]] + j)
        bad[e.row[i[hit]]] = True
    return bad


def crosses_long(e: Edges) -> bool:
    """The same of a single ring, by the cells its edges touch."""
    m = len(e.ax)
    low_x, low_y = min(e.ax.min(), e.bx.min()), min(e.ay.min(), e.by.min())
    n = min(MOST_CELLS, max(1, math.ceil(math.sqrt(m / EDGES_PER_CELL))))
    width, height = max(e.ax.max(), e.bx.max()) - low_x, max(e.ay.max(), e.by.max()) - low_y
    edge, column, row = Grid(low_x, low_y, width / n or 1.0, height / n or 1.0, n, n).touched(e)
    cell = column * n + row
    order = np.argsort(cell, kind="stable")
    edge, cell = edge[order], cell[order]
    end = np.searchsorted(cell, cell, "right")
    here = np.arange(len(edge))
    pairs = np.cumsum(end - here - 1)
    cuts = np.searchsorted(pairs, np.arange(0, pairs[-1], PAIRS_AT_ONCE), "right")
    for start, stop in zip(cuts, [*cuts[1:], len(edge)]):
        which, other = spread(here[start:stop] + 1, end[start:stop] - 1)
        i, j = edge[start:stop][which], edge[other]
        apart = np.abs(i - j)
        i, j = (v[(apart > 1) & (apart < m - 1)] for v in (i, j))
        if touch(e, i, j).any():
            return True
    return False


def simple_polygons(rings: pa.Array) -> np.ndarray:
    """Whether all rings of each polygon are simple; rings with missing or infinite coordinates count as simple."""
    e, sizes, polygon = distinct_edges(rings)
    finite = np.bincount(e.row, ~np.isfinite(e.ax + e.ay + e.bx + e.by), len(sizes)) == 0
    with np.errstate(invalid="ignore", over="ignore"):
        bad = folding(e, sizes) | crossing_short(e, sizes, finite & (sizes <= SHORT))
    first = np.cumsum(sizes) - sizes
    for ring in np.flatnonzero(finite & (sizes > SHORT) & ~bad):
        bad[ring] = crosses_long(e.of(np.arange(first[ring], first[ring] + sizes[ring])))
    return np.bincount(polygon, bad & finite, len(rings)) == 0


@F.arrow_udf(T.BooleanType())
def rings_are_simple(rings: pa.Array) -> pa.Array:
    return pa.array(simple_polygons(rings))
