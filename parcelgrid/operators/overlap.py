"""Joins of points with boxes within a fixed reach, over grid cells.

Cells are powers of two in coordinate units, anchored at 0, so no extent is
needed. A box is listed in every cell its reach touches, on the level whose
cells are at least as large as the box; that is at most nine cells however
large the box. A point looks up its own cell once per level in use. Any
(point, box) pair therefore meets in exactly one cell: no duplicates arise and
none have to be removed.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, replace

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelgrid.functions import ring as R
from parcelgrid.functions.box import (
    BOX_FIELDS,
    Box,
    around_point,
    box,
    contains_point,
    distance_to_point,
    expand,
    intersects,
    is_known,
)
from parcelgrid.functions.edges import rows_inside
from parcelgrid.functions.windows import SpotCounts
from parcelgrid.operators.skew import BROADCAST_ROWS, dealt_out, keyed_join, salted_join
from parcelgrid.operators.spots import SPOT, at_spots, located, spots_of
from parcelgrid.session import materialise

#: Levels are kept two powers of two apart: few lookups per point.
LEVEL_STRIDE = 2
LOWEST_LEVEL = -20
HIGHEST_LEVEL = 1000

CELL = ["level", "cx", "cy"]

#: Largest list that is broadcast.
BROADCAST_BYTES = 32 << 20

#: Cells a box can touch on its own level: its reach is at most two cells wide.
MOST_CELLS = 9


#: Copies of one box that share a row where they are joined as one.
COPIES_PER_ROW = 1000

#: Points times polygons, and rows, that an Arrow kernel takes at once; what it gives back is no larger.
PAIRS_PER_GROUP = 20_000_000
ROWS_PER_GROUP = 250_000
#: The same where a polygon stands for its copies, which come out as a list.
PAIRS_WITH_COPIES = 50_000_000

#: Spots aimed at per cell where they are counted.
SPOTS_PER_CELL = 10_000


#: How the ends of an edge are named where it is one struct.
_ENDS = (("a", "x", "ax"), ("a", "y", "ay"), ("b", "x", "bx"), ("b", "y", "by"))


def _level(b: Box, reach: float) -> Column:
    """The level whose cells are no smaller than the box and the reach."""
    size = F.greatest(b.maxx - b.minx, b.maxy - b.miny, F.lit(2.0 * reach))
    exact = F.when(size > 0, F.ceil(F.log2(size) / F.lit(float(LEVEL_STRIDE)))).otherwise(
        F.lit(LOWEST_LEVEL // LEVEL_STRIDE)
    )
    bounded = F.least(
        F.greatest(exact * LEVEL_STRIDE, F.lit(LOWEST_LEVEL)), F.lit(HIGHEST_LEVEL)
    )
    return bounded.cast("int")


def _cell(value: Column, level: Column) -> Column:
    return F.floor(value / F.pow(F.lit(2.0), level)).cast("bigint")


def levels_in_use(boxes: DataFrame, reach: float) -> tuple[list[int], int, int | None]:
    """Distinct levels (a few dozen at most), the number of boxes, and the bytes of the widest row.

    Arrays, binaries and the like have no bound, so their width is None.
    """
    texts = [f.name for f in boxes.schema.fields if isinstance(f.dataType, T.StringType)]
    fixed = [f for f in boxes.schema.fields if isinstance(f.dataType, (T.NumericType, T.BooleanType, T.DatetimeType))]
    width = sum((F.coalesce(F.max(F.octet_length(c)), F.lit(0)) for c in texts), F.lit(16 * len(boxes.columns)))
    rows = boxes.groupBy(_level(box(), reach).alias("level")).agg(F.count(F.lit(1)).alias("n"), width.alias("width"))
    found = rows.collect()
    bounded = len(texts) + len(fixed) == len(boxes.columns)
    widest = max((r["width"] for r in found), default=0) if bounded else None
    return sorted(r["level"] for r in found), sum(r["n"] for r in found), widest


@dataclass(frozen=True)
class ListedBoxes:
    """Boxes listed under the cells they touch, with what a join has to know of them."""

    rows: DataFrame
    columns: list[str]
    levels: list[int]
    n_boxes: int
    row_bytes: int | None

    @property
    def small(self) -> bool:
        """Whether the list may be broadcast, by rows and by bytes."""
        rows = self.n_boxes * MOST_CELLS
        return self.row_bytes is not None and rows <= BROADCAST_ROWS and rows * self.row_bytes <= BROADCAST_BYTES

    def copies_by_cell(self) -> DataFrame | None:
        """What each cell's rows come to with the copies they hold; None if a row is one box."""
        if "__copies" in self.columns:
            return self.rows.groupBy(*CELL).agg(F.sum(F.size("__copies")).alias("n"))


def list_boxes(boxes: DataFrame, reach: float, keep: bool = False) -> ListedBoxes:
    """One row per box and touched cell; boxes with a missing or infinite side are left out.

    ``keep`` writes the list to the shared folder, for use by many joins.
    """
    known = boxes.where(is_known(box()))
    levels, n_boxes, row_bytes = levels_in_use(known, reach)
    around, level = expand(box(), reach), F.col("level")
    rows = (
        known.withColumn("level", _level(box(), reach))
        .withColumn("cx", F.explode(F.sequence(_cell(around.minx, level), _cell(around.maxx, level))))
        .withColumn("cy", F.explode(F.sequence(_cell(around.miny, level), _cell(around.maxy, level))))
    )
    return ListedBoxes(materialise(rows, "listed") if keep else rows, boxes.columns, levels, n_boxes, row_bytes)


def placed_points(points: DataFrame, listed: ListedBoxes, x: str = "x", y: str = "y") -> DataFrame:
    """Each point under its own cell of every level in use."""
    wanted = F.array(*(F.lit(v) for v in listed.levels or [LOWEST_LEVEL]))
    return points.withColumn("level", F.explode(wanted)).withColumns(
        {"cx": _cell(F.col(x), F.col("level")), "cy": _cell(F.col(y), F.col("level"))}
    )


def by_place(
    points: DataFrame, listed: ListedBoxes, x: str = "x", y: str = "y", point_id: str = "query_id", pairs: int | None = None
) -> tuple[DataFrame, DataFrame, list[str]]:
    """Points and listed boxes with the keys of groups of cells, for a kernel that takes both sides of a group.

    A pair is in one group, and there in one cell. Cells share groups, as a call for
    each would cost more than its work; crowded ones are dealt out until none has more than ``pairs`` pairs.
    """
    pairs = pairs or PAIRS_PER_GROUP
    placed = placed_points(points, listed, x, y)
    counts = lambda df: df.groupBy(*CELL).agg(F.count(F.lit(1)).alias("n"))
    copies = listed.copies_by_cell()
    others = (counts(listed.rows) if copies is None else copies).withColumnRenamed("n", "n_right")
    # cells of both sides only; written, as it is used three times
    met = materialise(counts(placed).join(others, CELL), "cells-met")
    product = F.sum(F.col("n").cast("double") * F.col("n_right"))
    n_pairs = met.agg(product).first()[0] or 0
    n_rows = points.count() * max(len(listed.levels), 1) + listed.n_boxes * MOST_CELLS
    tasks = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    groups = max(4 * tasks, math.ceil(n_pairs / pairs), math.ceil(n_rows / ROWS_PER_GROUP))
    left, right, keys = dealt_out(
        placed, listed.rows, CELL, point_id, met.select(*CELL, "n"), pairs, met.select(*CELL, F.col("n_right").alias("n"))
    )
    place = F.pmod(F.xxhash64(*CELL), F.lit(groups))
    return left.withColumn("place", place), right.withColumn("place", place), ["place", *keys[len(CELL) :]]


def cell_pairs(
    points: DataFrame,
    boxes: DataFrame | ListedBoxes,
    matches: Column,
    reach: float = 0.0,
    point_id: str | list[str] = "query_id",
    x: str = "x",
    y: str = "y",
    how: str = "inner",
) -> DataFrame:
    """Points with the boxes of their cell that satisfy ``matches``.

    ``matches`` must imply that the box is within ``reach`` of the point. With
    ``how="left_semi"`` only the points come out, once per level on which they
    have such a box, or more often. Points and boxes must not share column names.

    A counted small box table is broadcast; beyond that the join shuffles on
    the cell, with crowded cells dealt out over several tasks by the pairs they
    may put out. Points are dealt out by id first: their file's size says nothing
    of their pairs, and adaptive execution may broadcast as well.
    """
    listed = boxes if isinstance(boxes, ListedBoxes) else list_boxes(boxes, reach)
    tasks = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    points = points.repartition(tasks, *([point_id] if isinstance(point_id, str) else point_id))
    placed = placed_points(points, listed, x, y)
    if listed.small:
        return keyed_join(placed, F.broadcast(listed.rows), CELL, how, matches).drop(*CELL)
    return salted_join(placed, listed.rows, CELL, point_id, how, None, matches, listed.copies_by_cell()).drop(*CELL)


def merged_copies(boxes: DataFrame, reach: float, same: tuple[str, ...] = ()) -> ListedBoxes:
    """Distinct boxes with the other columns of their copies in ``__copies``, listed; copies agree in ``same`` as well.

    A box is listed and tested once however many copies it has; beyond
    ``COPIES_PER_ROW`` they are dealt over several rows.
    """
    key = [*BOX_FIELDS, *same]
    others = [c for c in boxes.columns if c not in key]
    hashed = [c for c in others if "map<" not in boxes.schema[c].dataType.simpleString()]
    known = boxes.where(is_known(box()))
    most = known.groupBy(*key).count().agg(F.max("count")).first()[0] or 0
    piece = F.pmod(F.xxhash64(F.lit(0), *hashed), F.lit(max(1, math.ceil(most / COPIES_PER_ROW))))
    copy = F.struct(*(others or [F.lit(0).alias("copy")]))
    grouped = known.groupBy(*key, piece.alias("piece")).agg(F.collect_list(copy).alias("__copies")).drop("piece")
    merged = materialise(grouped, "copies")
    _, n_boxes, widest = levels_in_use(known, reach)
    listed = list_boxes(merged, reach)
    # the bytes the boxes have as single rows
    row_bytes = None if widest is None else math.ceil(widest * n_boxes / max(listed.n_boxes, 1))
    return replace(listed, row_bytes=row_bytes)


def join_points_boxes(
    points: DataFrame,
    boxes: DataFrame,
    matches: Column,
    reach: float = 0.0,
    point_id: str = "query_id",
    x: str = "x",
    y: str = "y",
    how: str = "inner",
    by_box: bool = False,
) -> DataFrame:
    """Points with the boxes that satisfy ``matches``.

    ``how`` is ``inner`` (pairs), ``left`` (pairs, unmatched points kept once),
    ``semi`` (points with a match) or ``anti`` (points without one). ``by_box``
    says that ``matches`` reads nothing but the boxes' sides and the points'
    position; then copies of a box are tested as one.

    Pairs are put out where they are found and never shuffled. Whether a point has
    any is asked apart, which ends at its first.
    """
    if how not in ("inner", "left", "semi", "anti"):
        raise ValueError(f"unknown join type {how}")

    def having(kind: str) -> DataFrame:
        asked = points.select(*dict.fromkeys([point_id, x, y])) if by_box else points
        sides = boxes.select(*BOX_FIELDS).distinct() if by_box else boxes
        hits = cell_pairs(asked, sides, matches, reach, point_id, x, y, "left_semi")
        return points.join(hits.select(point_id).distinct(), point_id, kind).select(*points.columns)

    if how in ("semi", "anti"):
        return having(f"left_{how}")
    if by_box:
        hits = cell_pairs(points, merged_copies(boxes, reach), matches, reach, point_id, x, y)
        copy = F.col("__copy")
        of_box = [F.col(c) if c in BOX_FIELDS else copy[c].alias(c) for c in boxes.columns]
        pairs = hits.withColumn("__copy", F.explode("__copies")).select(*points.columns, *of_box)
    else:
        pairs = cell_pairs(points, boxes, matches, reach, point_id, x, y).select(*points.columns, *boxes.columns)
    return pairs if how == "inner" else pairs.unionByName(having("left_anti"), allowMissingColumns=True)


def points_in_boxes(points: DataFrame, boxes: DataFrame, **options) -> DataFrame:
    """Points with the boxes that contain them, boundary included."""
    x, y = options.get("x", "x"), options.get("y", "y")
    return join_points_boxes(points, boxes, contains_point(box(), F.col(x), F.col(y)), by_box=True, **options)


def points_in_polygons(
    points: DataFrame,
    polygons: DataFrame,
    rings: str = "rings",
    point_id: str = "query_id",
    x: str = "x",
    y: str = "y",
    how: str = "inner",
    outlines: bool = True,
) -> DataFrame:
    """Points with the polygons that contain them; box first, exact test after.

    ``how`` as in :func:`join_points_boxes`. Copies of an outline are tested as one, and pairs
    are found by an Arrow kernel. ``outlines=False`` leaves the outlines out of the pairs.
    """
    extent = polygons.withColumn("extent", R.bounds_struct(F.col(rings))).select("*", "extent.*").drop("extent")
    if how not in ("inner", "left"):
        exact = contains_point(box(), F.col(x), F.col(y)) & R.contains_point(F.col(rings), F.col(x), F.col(y))
        return join_points_boxes(points, extent, exact, point_id=point_id, x=x, y=y, how=how)
    merged = merged_copies(extent, 0.0, (rings,))
    each = lambda ring: F.transform(
        R.edges(ring), lambda e: F.struct(*(e[end][c].alias(name) for end, c, name in _ENDS))
    )
    kept = [F.col(rings).alias("__rings")] if outlines else []
    listed = replace(
        merged, rows=merged.rows.select(*CELL, *BOX_FIELDS, F.flatten(F.transform(rings, each)).alias("edges"), "__copies", *kept)
    )
    own = points.select(
        F.struct(*points.columns).alias("point"), F.xxhash64(point_id).alias("spread"), *(F.col(c).cast("double").alias(n) for c, n in ((x, "x"), (y, "y")))
    ).where("x IS NOT NULL AND y IS NOT NULL AND NOT isnan(x) AND NOT isnan(y)")
    left, right, keys = by_place(own, listed, point_id="spread", pairs=PAIRS_WITH_COPIES)
    schema = T.StructType([own.schema["point"], *(f for f in right.schema if f.name.startswith("__"))])
    hits = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(rows_inside, schema)
    copied = hits.withColumn("__copy", F.explode("__copies"))
    of_polygon = [F.col("__rings").alias(rings) if c == rings else F.col("__copy")[c].alias(c) for c in polygons.columns if outlines or c != rings]
    pairs = copied.select(*(F.col("point")[c].alias(c) for c in points.columns), *of_polygon)
    if how == "inner":
        return pairs
    alone = points_in_polygons(points, polygons, rings, point_id, x, y, "anti")
    return pairs.unionByName(alone, allowMissingColumns=True)


def points_near_boxes(points: DataFrame, boxes: DataFrame, radius: float, **options) -> DataFrame:
    """Points with the boxes at most ``radius`` away, and the distance."""
    x, y = options.get("x", "x"), options.get("y", "y")
    d = distance_to_point(box(), F.col(x), F.col(y))
    pairs = join_points_boxes(points, boxes, d <= F.lit(float(radius)), reach=radius, by_box=True, **options)
    return pairs.withColumn("distance_m", d)


def _spots_in_squares(radius: float):
    """Counts for the points of one cell, from the spots listed under it."""

    def count(points: pa.Table, spots: pa.Table) -> pa.Table:
        column = lambda table, name: table.column(name).to_numpy(zero_copy_only=False)
        held = SpotCounts(*(column(spots, c) for c in ("sx", "sy", "copies")))
        x, y = column(points, "x"), column(points, "y")
        found = held.inside(x - radius, y - radius, x + radius, y + radius)
        return pa.table({"point": points.column("point"), "n": pa.array(found, pa.int64())})

    return count


def candidate_counts(
    points: DataFrame,
    spots: DataFrame,
    radius: float,
    point_id: str = "query_id",
    x: str = "x",
    y: str = "y",
) -> DataFrame:
    """How many boxes have their centre strictly inside the square about each point.

    Spots are counted, not paired: a cell's spots are put in order once, and
    each of its points takes a logarithmic number of steps however many spots
    its square holds. Cells are large enough to hold some thousands of rows; a
    crowded one is dealt over tasks, and the counts of its pieces are added up.
    """
    b = box()
    as_spots = spots.where(is_known(b)).select(((b.minx + b.maxx) / 2.0).alias("sx"), ((b.miny + b.maxy) / 2.0).alias("sy"))
    # copies of one spot count together
    counted = materialise(as_spots.groupBy("sx", "sy").agg(F.count(F.lit(1)).alias("copies")), "spots")
    extent = counted.agg(
        F.count(F.lit(1)).alias("n"), F.greatest(F.max("sx") - F.min("sx"), F.max("sy") - F.min("sy")).alias("side")
    ).first()
    even = (extent["side"] or 0.0) * math.sqrt(SPOTS_PER_CELL / max(extent["n"], 1))
    size = max(2.0 * radius, even, 2.0**LOWEST_LEVEL)
    at = lambda value: F.floor(value / F.lit(size)).cast("bigint")
    wide = radius * (1 + 1e-6)  # a cell too many does no harm
    around = lambda v: F.explode(F.sequence(at(F.col(v) - wide), at(F.col(v) + wide)))
    listed = counted.withColumn("cx", around("sx")).withColumn("cy", around("sy"))
    own = points.select(F.col(point_id).alias("point"), *(F.col(c).cast("double").alias(n) for c, n in ((x, "x"), (y, "y"))))
    # points without a position find nothing anywhere
    anywhere = F.pmod(F.xxhash64("point"), F.lit(1000))
    placed = own.withColumns({"cx": F.coalesce(at(F.col("x")), anywhere), "cy": F.coalesce(at(F.col("y")), anywhere)})
    left, right, keys = dealt_out(placed, listed, ["cx", "cy"], "point")
    schema = T.StructType([own.schema["point"], T.StructField("n", T.LongType())])
    pieces = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(_spots_in_squares(radius), schema)
    return pieces.groupBy(F.col("point").alias(point_id)).agg(F.sum("n").alias("n_candidates"))


def with_buffer_overlap(pairs: DataFrame, x: str, y: str, radius: float, name: str) -> DataFrame:
    """Add the area each pair's round buffer and box share.

    One projection per step of the closed form: every intermediate is computed
    once per row, and each piece of generated code stays small enough to be
    compiled to machine code.
    """
    outline = R.BufferOutline(radius)
    sides = {"x0": ("minx", x), "x1": ("maxx", x), "y0": ("miny", y), "y1": ("maxy", y)}
    staged = pairs.withColumns({f"s_{k}": F.col(side) - F.col(c) for k, (side, c) in sides.items()})
    staged = staged.withColumns({f"a_{k}": outline.clipped(F.col(f"s_{k}")) for k in sides})
    staged = staged.withColumns({f"k_{k}": outline.piece(F.col(f"a_{k}")) for k in sides})
    staged = staged.withColumns(
        {f"h_{k}": outline.height(F.col(f"a_{k}"), F.col(f"k_{k}")) for k in sides}
    )
    staged = staged.withColumns(
        {f"t_{k}": outline.tail(*(F.col(f"{p}_{k}") for p in "akh")) for k in sides}
    )

    def corner(u, v):
        size = outline.corner(*(F.col(f"{p}_{k}") for k in (u, v) for p in "aht"))
        return F.signum(f"s_{u}") * F.signum(f"s_{v}") * size

    shared = corner("x1", "y1") - corner("x0", "y1") - corner("x1", "y0") + corner("x0", "y0")
    missed = outline.missed(*(F.col(f"s_{k}") for k in ("x0", "y0", "x1", "y1")))
    # rounding may leave a trace below 0 where only a tip is touched
    area = F.when(missed, F.lit(0.0)).when(F.col("s_x0").isNotNull(), F.greatest(shared, F.lit(0.0)))
    return staged.withColumn(name, area).select(*pairs.columns, name)


def list_copies(boxes: DataFrame, radius: float, keep: bool = False) -> ListedBoxes:
    """Distinct boxes with their number of copies, listed for :func:`covered_area`."""
    copies = boxes.groupBy(*BOX_FIELDS).agg(F.count(F.lit(1)).alias("copies"))
    return list_boxes(copies, radius, keep)


def covered_at(spots: DataFrame, boxes: DataFrame | ListedBoxes, radius: float, name: str) -> DataFrame:
    """``x, y`` of the spots with a box in reach, and the summed areas their round buffers share with boxes."""
    copies = boxes if isinstance(boxes, ListedBoxes) else list_copies(boxes, radius)
    in_reach = intersects(box(), around_point(F.col("x"), F.col("y"), radius))
    pairs = cell_pairs(spots.select(*SPOT), copies, in_reach, radius, SPOT)
    shared = with_buffer_overlap(pairs, "x", "y", radius, "shared_m2")
    return shared.groupBy(*SPOT).agg(F.sum(F.col("shared_m2") * F.col("copies")).alias(name))


def covered_area(
    points: DataFrame,
    boxes: DataFrame | ListedBoxes,
    radius: float,
    point_id: str = "query_id",
    x: str = "x",
    y: str = "y",
    name: str = "nearby_covered_area_m2",
) -> DataFrame:
    """Per point, the summed areas its round buffer shares with each box.

    Overlapping boxes count once each, as the sum of areas it is. The buffer
    is the 64-sided polygon inscribed in the circle. Points without a box in
    reach get 0. Copies of one box are joined once and weighted by their
    number, and points at one spot are joined once as well. Pass
    :func:`list_copies` in place of the boxes to list them once.
    """
    own = located(points, point_id, x, y)
    spots = spots_of(own)
    found = at_spots(own, spots, covered_at(spots, boxes, radius, name))
    return found.select(F.col("query_id").alias(point_id), F.coalesce(name, F.lit(0.0)).alias(name))


def within_window(boxes: DataFrame, window: tuple[float, float, float, float]) -> DataFrame:
    """Boxes lying in a constant window, as plain comparisons Parquet can skip by."""
    minx, miny, maxx, maxy = window
    if not all(math.isfinite(v) for v in window):
        raise ValueError("the window must be finite")
    return boxes.where(
        (F.col("minx") >= minx) & (F.col("miny") >= miny) & (F.col("maxx") <= maxx) & (F.col("maxy") <= maxy)
    )
