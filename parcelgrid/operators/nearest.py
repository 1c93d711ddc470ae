"""Exact nearest box for every query point.

The plan prunes by groups of query points, not by single points:

1. Boxes are put on a pyramid of grids, four cells to a side per step. A box
   lives at its *home* step: the finest one whose cells are no smaller than
   the box. Each occupied cell knows the extent of the boxes below it.
2. Query points at one spot are one point. Spots are grouped by finest cell,
   with their own extent.
3. Each group gets a bound from the smallest occupied cell above it, then goes
   down the pyramid step by step, dropping cells that start beyond the bound.
4. Boxes of the cells left are compared with the group; a box stays unless
   another one is nearer, or as near with a lower id, for every point of the
   group. That leaves a handful.
5. Spots meet the boxes of their group by an equi-join; groups with very many
   spots are salted. The lowest id wins ties. Points meet their spot last.

All bounds use the same subtraction, product and square root as the distance
itself, each of which rounds monotonically, so pruning never loses the answer.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from parcelgrid.functions.box import (
    BOX_FIELDS,
    Box,
    box,
    centroid_x,
    centroid_y,
    distance_to_point,
    gap,
    is_known,
    reach,
    total_bounds,
)
from parcelgrid.functions.scalar import clip
from parcelgrid.operators.skew import broadcast_if_small, salted_join
from parcelgrid.operators.spots import SPOT, at_spots, located, spots_of
from parcelgrid.session import materialise

#: Cells per axis grow by this power of two per pyramid step.
BITS_PER_STEP = 2
MAX_STEPS = 12
#: Boxes aimed at per finest cell, and how many are put up with.
TARGET_PER_CELL = 8
TOLERATED_PER_CELL = 64
#: Largest side, in bytes, that is broadcast.
BROADCAST_BYTES = 32 << 20

GROUP_BOX = [f"g_{name}" for name in BOX_FIELDS]


@dataclass(frozen=True)
class Grid:
    """Placement of the pyramid's grids and the number of boxes on them."""

    x0: float
    y0: float
    side: float
    steps: int
    n_boxes: int
    #: No carried row is wider than this, as text.
    row_bytes: int = 0

    def index(self, value: Column, origin: float) -> Column:
        finest = self.side / (1 << BITS_PER_STEP * self.steps)
        return F.floor((value - F.lit(origin)) / F.lit(finest))

    def inside(self, index: Column) -> Column:
        return clip(index, F.lit(0), F.lit((1 << BITS_PER_STEP * self.steps) - 1))


@dataclass(frozen=True)
class BoxPyramid:
    """Boxes placed on a pyramid of grids: build once, query many times.

    ``items``: one row per distinct box with its home step and home cell.
    ``cells``: occupied cells per step with the extent of the boxes in them;
    ``own`` rows cover just the boxes living at that step.
    Both are written to the shared folder, so a lost executor costs a re-read.
    """

    grid: Grid
    items: DataFrame
    cells: DataFrame


def _above(index: Column, steps_up) -> Column:
    """The index of the cell that holds ``index``, some steps up."""
    if isinstance(steps_up, int):
        return F.shiftright(index, BITS_PER_STEP * steps_up)
    return F.floor(index / F.pow(F.lit(2.0), steps_up * BITS_PER_STEP)).cast("bigint")


def _farthest(a: Box, b: Box) -> Column:
    """Largest distance between any two points of two boxes."""
    dx = F.greatest(b.maxx - a.minx, a.maxx - b.minx)
    dy = F.greatest(b.maxy - a.miny, a.maxy - b.miny)
    return F.sqrt(dx * dx + dy * dy)


def distinct_boxes(boxes: DataFrame, id_col: str, carry: list[str], same: list[str]) -> DataFrame:
    """One row per distinct box and ``same`` columns, that of the lowest id: copies can never win a tie."""
    fields = [F.col(id_col).alias("poly_id"), *(F.col(c) for c in carry)]
    return (
        boxes.where(is_known(box()))
        .groupBy(*BOX_FIELDS, *same)
        .agg(F.min(F.struct(*fields)).alias("item"))
        .drop(*same)
    )


def _placed(items: DataFrame, grid: Grid) -> DataFrame:
    """Add the finest-grid cell of the centre and the home step."""
    b = box()
    size = F.greatest(b.maxx - b.minx, b.maxy - b.miny)
    fits = F.floor(F.log2(F.lit(grid.side) / size) / F.lit(float(BITS_PER_STEP)))
    return items.withColumns(
        {
            "cx": grid.inside(grid.index(centroid_x(b), grid.x0)),
            "cy": grid.inside(grid.index(centroid_y(b), grid.y0)),
            "home": F.when(size > 0, clip(fits, 0, grid.steps))
            .otherwise(F.lit(grid.steps))
            .cast("int"),
        }
    )


def _steps_for(items: DataFrame, grid: Grid) -> int:
    """Steps until no finest cell is overfull; crowded spots ask for more of them."""
    per_step = 4**BITS_PER_STEP
    even = math.ceil(math.log(max(grid.n_boxes / TARGET_PER_CELL, 1), per_step))
    if not 0 < even < MAX_STEPS:
        return min(even, MAX_STEPS)
    up = F.lit(MAX_STEPS) - F.col("step")
    fullest = (
        _placed(items, grid)
        .where(F.col("home") >= even)
        .select("cx", "cy", F.explode(F.sequence(F.lit(even), F.col("home"))).alias("step"))
        .groupBy("step", _above(F.col("cx"), up), _above(F.col("cy"), up))
        .count()
        .groupBy("step")
        .agg(F.max("count").alias("fullest"))
        .collect()  # at most one row per step
    )
    overfull = [r["step"] for r in fullest if r["fullest"] > TOLERATED_PER_CELL]
    return min(MAX_STEPS, max([even, *(step + 1 for step in overfull)]))


def build_pyramid(
    boxes: DataFrame, box_id: str = "field_id", carry: list[str] | None = None, same: list[str] | None = None
) -> BoxPyramid:
    """Place the boxes; two aggregates decide the grid, nothing else is collected.

    Equal boxes are copies of each other if they also agree in the ``same`` columns.
    """
    items = materialise(distinct_boxes(boxes, box_id, carry or [], same or []), "boxes")
    b = box()
    centre = Box(centroid_x(b), centroid_y(b), centroid_x(b), centroid_y(b))
    width = F.max(F.octet_length(F.to_json("item"))).alias("width")
    stats = items.agg(F.count(F.lit(1)).alias("n"), width, *total_bounds(centre)).first()
    if stats["n"] == 0:
        grid = Grid(0.0, 0.0, 1.0, 0, 0)
    else:
        extent = max(stats["maxx"] - stats["minx"], stats["maxy"] - stats["miny"])
        side = extent * (1 + 1e-9) if extent > 0 else 1.0
        grid = Grid(stats["minx"], stats["miny"], side, MAX_STEPS, stats["n"], stats["width"])
        grid = replace(grid, steps=_steps_for(items, grid))
    placed = _placed(items, grid)
    up = F.lit(grid.steps) - F.col("step")
    cells = (
        placed.withColumn("step", F.explode(F.sequence(F.lit(0), F.col("home"))))
        .withColumn("own", F.explode(F.expr("if(step = home, array(true, false), array(false))")))
        .groupBy("step", "own", _above(F.col("cx"), up).alias("nx"), _above(F.col("cy"), up).alias("ny"))
        .agg(*total_bounds(box(), "n_"))
    )
    homes = placed.select(
        F.col("home").alias("step"),
        _above(F.col("cx"), F.lit(grid.steps) - F.col("home")).alias("nx"),
        _above(F.col("cy"), F.lit(grid.steps) - F.col("home")).alias("ny"),
        "item",
        *BOX_FIELDS,
    )
    return BoxPyramid(grid, homes, materialise(cells, "cells"))


def _bounded_groups(groups: DataFrame, pyramid: BoxPyramid) -> DataFrame:
    """Add ``ub``: no point of the group is farther than this from its nearest box."""
    grid = pyramid.grid
    cells = broadcast_if_small(
        pyramid.cells.where("not own").drop("own"), grid.n_boxes * (grid.steps + 1)
    )
    # a group outside the grid takes the edge cell: any occupied cell gives a bound
    up = F.lit(grid.steps) - F.col("step")
    keyed = groups.withColumn(
        "step", F.explode(F.sequence(F.lit(0), F.lit(grid.steps)))
    ).withColumns(
        {"nx": _above(grid.inside(F.col("gx")), up), "ny": _above(grid.inside(F.col("gy")), up)}
    )
    return (
        keyed.join(cells, ["step", "nx", "ny"])
        .groupBy("gx", "gy", *GROUP_BOX)
        .agg(F.min(_farthest(box("g_"), box("n_"))).alias("ub"))
    )


def _descend(frontier: DataFrame, pyramid: BoxPyramid, step: int) -> DataFrame:
    """Replace each open cell of ``step`` by its children and its own boxes' extent."""
    grid = pyramid.grid
    finer = (F.col("step") == step + 1) & ~F.col("own")
    here = (F.col("step") == step) & F.col("own")
    kids = pyramid.cells.where(finer | here).select(
        F.expr(f"shiftright(nx, if(own, 0, {BITS_PER_STEP}))").alias("ox"),
        F.expr(f"shiftright(ny, if(own, 0, {BITS_PER_STEP}))").alias("oy"),
        F.col("step").alias("k_step"),
        (finer & F.lit(step + 1 < grid.steps)).alias("k_open"),
        F.col("nx").alias("k_nx"),
        F.col("ny").alias("k_ny"),
        *(f"n_{f}" for f in BOX_FIELDS),
    )
    kids = broadcast_if_small(kids, min(grid.n_boxes, 4 ** (BITS_PER_STEP * (step + 1))) * 2)
    # closed rows have no key to match and pass through the left join unchanged
    met = frontier.join(kids, ["ox", "oy"], "left")
    is_open = F.col("ox").isNotNull()
    low = F.when(is_open, gap(box("g_"), box("n_"))).otherwise(F.col("lo"))
    high = F.when(is_open, _farthest(box("g_"), box("n_"))).otherwise(F.col("ub"))
    moved = met.select(
        "gx",
        "gy",
        *GROUP_BOX,
        F.least(F.col("ub"), high).alias("ub"),
        low.alias("lo"),
        F.when(is_open, F.col("k_step")).otherwise(F.col("step")).alias("step"),
        F.when(is_open, F.col("k_nx")).otherwise(F.col("nx")).alias("nx"),
        F.when(is_open, F.col("k_ny")).otherwise(F.col("ny")).alias("ny"),
        F.when(F.col("k_open"), F.col("k_nx")).alias("ox"),
        F.when(F.col("k_open"), F.col("k_ny")).alias("oy"),
        F.col("ub").alias("ub_before"),
    ).where("lo <= ub_before")
    tight = F.min("ub").over(Window.partitionBy("gx", "gy"))
    return moved.drop("ub_before").withColumn("ub", tight).where("lo <= ub")


def query_groups(points: DataFrame) -> DataFrame:
    """One row per occupied finest cell: the extent and number of its points."""
    return (
        points.where("gx is not null and gy is not null")
        .groupBy("gx", "gy")
        .agg(
            F.min("x").alias("g_minx"),
            F.min("y").alias("g_miny"),
            F.max("x").alias("g_maxx"),
            F.max("y").alias("g_maxy"),
            F.count(F.lit(1)).alias("n"),
        )
    )


def group_candidates(groups: DataFrame, pyramid: BoxPyramid, far: Column | None = None) -> DataFrame:
    """For each group, every box that is nearest to at least one place in it.

    ``far`` is no less than the distance from any place of the group to what is
    in the box; without it the box itself is meant.
    """
    grid = pyramid.grid
    # the top cell of every group, computed so that the first step is an equi-join too
    top_x, top_y = (_above(grid.inside(F.col(c)), grid.steps) for c in ("gx", "gy"))
    frontier = _bounded_groups(groups.drop("n"), pyramid).selectExpr(
        "*", "0 as step", "0D as lo"
    ).withColumns({"nx": top_x, "ny": top_y})
    frontier = frontier.withColumns(
        {c: F.col(n) if grid.steps else F.lit(None).cast("bigint") for c, n in (("ox", "nx"), ("oy", "ny"))}
    )
    for step in range(grid.steps):
        frontier = _descend(frontier, pyramid, step)
    # what is carried may be wide: the bound is on bytes too
    narrow = grid.n_boxes * (grid.row_bytes + 64) <= BROADCAST_BYTES
    homes = broadcast_if_small(pyramid.items, grid.n_boxes) if narrow else pyramid.items
    near, far = gap(box("g_"), box()), reach(box("g_"), box()) if far is None else far
    best = F.min("high").over(Window.partitionBy("gx", "gy"))
    return (
        frontier.select("gx", "gy", *GROUP_BOX, "ub", "step", "nx", "ny")
        .join(homes, ["step", "nx", "ny"])
        .where(near <= F.col("ub"))
        .select(
            "gx",
            "gy",
            "item",
            *BOX_FIELDS,
            F.struct(near.alias("d"), F.col("item.poly_id")).alias("low"),
            F.struct(far.alias("d"), F.col("item.poly_id")).alias("high"),
        )
        .withColumn("best", best)
        .where("low <= best")
        .select("gx", "gy", "item", *BOX_FIELDS)
    )


def points_and_candidates(
    points: DataFrame, pyramid: BoxPyramid, far: Column | None = None, spread_by: str | list[str] = "query_id"
) -> DataFrame:
    """The points with the candidates of their group: ``item`` and box, null where there is none."""
    grid = pyramid.grid
    points = points.withColumns(
        {"gx": grid.index(F.col("x"), grid.x0), "gy": grid.index(F.col("y"), grid.y0)}
    )
    # used twice below; written once, so the points are not read and grouped again
    groups = materialise(query_groups(points), "groups")
    # a handful per group; written, as the join counts them before it reads them
    candidates = materialise(group_candidates(groups, pyramid, far), "candidates")
    return salted_join(points, candidates, ["gx", "gy"], spread_by, "left", groups.select("gx", "gy", "n"))


def nearest_at(spots: DataFrame, pyramid: BoxPyramid) -> DataFrame:
    """``x, y`` of the spots and ``best``: distance ``d`` and ``item`` of the nearest box, null without any."""
    pairs = points_and_candidates(spots.select(*SPOT), pyramid, spread_by=SPOT)
    found = F.struct(distance_to_point(box(), F.col("x"), F.col("y")).alias("d"), F.col("item"))
    return pairs.groupBy(*SPOT).agg(F.min(F.when(F.col("item").isNotNull(), found)).alias("best"))


def of_best(carry: dict[str, str]) -> list[Column]:
    """Columns from :func:`nearest_at`: id, distance and what is carried."""
    return [
        F.col("best.item.poly_id").alias("nearest_poly_id"),
        F.coalesce(F.col("best.d"), F.lit(float("inf"))).alias("distance_m"),
        *(F.col(f"best.item.{c}").alias(name) for c, name in carry.items()),
    ]


def nearest_box(
    queries: DataFrame,
    boxes: DataFrame | BoxPyramid,
    query_id: str = "query_id",
    box_id: str = "field_id",
    x: str = "x",
    y: str = "y",
    carry: dict[str, str] | None = None,
) -> DataFrame:
    """``query_id, nearest_poly_id, distance_m`` and carried box columns.

    Every query keeps its row: without any box, or without a finite position, the
    id is NULL and the distance infinite. Queries at one spot are looked up as one.
    ``carry`` maps box columns to output names. Pass the result of
    :func:`build_pyramid` in place of the boxes to use it for many query sets.
    """
    carry = carry or {}
    pyramid = boxes if isinstance(boxes, BoxPyramid) else build_pyramid(boxes, box_id, list(carry))
    points = located(queries, query_id, x, y)
    spots = spots_of(points)
    found = at_spots(points, spots, nearest_at(spots, pyramid))
    return found.select(F.col("query_id").alias(query_id), *of_best(carry))
