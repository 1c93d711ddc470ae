"""Spatial tiles: assignment, occupancy, per-tile metrics and functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from parcelgrid.functions.box import (
    Box,
    area,
    box,
    centroid_x,
    centroid_y,
    compactness,
    length,
    total_bounds,
)
from parcelgrid.session import materialise
from parcelgrid.functions.scalar import (
    clip,
    hectares,
    planar_distance,
    round_half_even,
    truncate_to_int,
)


#: Tile numbers are 32-bit.
MOST_TILES = 2**31 - 1


def tile_index(cx: Column, cy: Column, extent: Box, n_cols: int, n_rows: int) -> Column:
    """Row-major tile number of a position; the extent's far edges belong to the last tiles."""

    def along(value, low, high, n):
        cell = (high - low) / F.lit(float(n))
        index = F.when(cell > 0, truncate_to_int((value - low) / cell)).otherwise(F.lit(0))
        return clip(index, 0, n - 1)

    row = along(cy, extent.miny, extent.maxy, n_rows)
    col = along(cx, extent.minx, extent.maxx, n_cols)
    return (row * F.lit(n_cols) + col).cast("int")


def assign_tiles(fields: DataFrame, n_cols: int, n_rows: int, name: str = "tile_id") -> DataFrame:
    """Add the tile holding each box's centre, on a grid over the total bounds.

    The extent is a one-row aggregate read as scalars inside the plan.
    """
    if n_cols < 1 or n_rows < 1 or n_cols * n_rows > MOST_TILES:
        raise ValueError("at least one tile, and no more than a tile number can hold")
    b = box()
    extent = fields.agg(F.struct(*total_bounds(b)).alias("extent")).scalar()
    bounds = Box(*(extent.getField(f) for f in Box._fields))
    return fields.withColumn(
        name, tile_index(centroid_x(b), centroid_y(b), bounds, n_cols, n_rows)
    )


def tile_sizes(tiled: DataFrame, tile: str = "tile_id") -> DataFrame:
    return tiled.groupBy(tile).agg(F.count(F.lit(1)).alias("n_in_tile"))


def tile_occupancy(tiled: DataFrame, tile: str = "tile_id") -> DataFrame:
    """Smallest, largest and mean number of features over the occupied tiles."""
    return tile_sizes(tiled, tile).agg(
        F.count(F.lit(1)).alias("n_tiles"),
        F.min("n_in_tile").alias("min_features"),
        F.max("n_in_tile").alias("max_features"),
        F.avg("n_in_tile").alias("mean_features"),
    )


def tile_features(tiled: DataFrame, tile: str = "tile_id") -> DataFrame:
    """Geometry metrics of every feature, some relative to its tile.

    A tile may hold most of the data, so nothing is windowed over tiles: the
    per-tile means are folded before the shuffle, come out as one row per tile
    and are joined back; Spark broadcasts them while they are small.
    """
    b = box()
    cx, cy = centroid_x(b), centroid_y(b)
    per_tile = tiled.groupBy(tile).agg(
        F.avg(cx).alias("tile_cx"), F.avg(cy).alias("tile_cy"), F.count(F.lit(1)).alias("n_in_partition")
    )
    joined = tiled.join(per_tile, tile)
    return joined.select(
        "field_id",
        "crop_type",
        "area_ha",
        area(b).alias("computed_area_m2"),
        hectares(area(b)).alias("computed_area_ha"),
        length(b).alias("perimeter_m"),
        round_half_even(compactness(area(b), length(b)), 6).alias("compactness"),
        cx.alias("centroid_x"),
        cy.alias("centroid_y"),
        round_half_even(planar_distance(cx, cy, F.col("tile_cx"), F.col("tile_cy")), 2).alias(
            "dist_to_tile_center_m"
        ),
        F.col(tile).alias("partition_id"),
        "n_in_partition",
    )


def with_tile_means(tiled: DataFrame, tile: str = "tile_id") -> DataFrame:
    """Add ``tile_cx``, ``tile_cy`` and ``n_in_partition`` of each row's tile."""
    b = box()
    per_tile = tiled.groupBy(tile).agg(
        F.avg(centroid_x(b)).alias("tile_cx"),
        F.avg(centroid_y(b)).alias("tile_cy"),
        F.count(F.lit(1)).alias("n_in_partition"),
    )
    return tiled.join(per_tile, tile)


def apply_per_tile(
    tiled: DataFrame,
    function: Callable,
    schema: str,
    tile: str = "tile_id",
    rows_per_call: int | None = None,
) -> DataFrame:
    """Run a pandas function over each whole tile, whatever its size.

    The function gets a frame of one tile with the tile's own ``tile_cx``,
    ``tile_cy`` and ``n_in_partition`` as columns. A whole tile must fit one
    task; a function that looks at single rows only may say so by
    ``rows_per_call``, and then gets pieces of about so many rows. For
    crowded tiles and functions of a whole tile, see ``fold_per_tile``.
    """
    dealt = with_tile_means(tiled, tile)
    if rows_per_call is None:
        return dealt.groupBy(tile).applyInPandas(function, schema)
    pieces = F.ceil(F.col("n_in_partition") / F.lit(float(rows_per_call)))
    dealt = dealt.withColumn("piece", F.pmod(F.xxhash64(*tiled.columns), pieces))
    return dealt.groupBy(tile, "piece").applyInPandas(
        lambda frame: function(frame.drop(columns="piece")), schema
    )


def fold_per_tile(
    tiled: DataFrame,
    partial: Callable,
    partial_schema: str,
    finish: Callable,
    schema: str,
    tile: str = "tile_id",
    pieces: int = 32,
) -> DataFrame:
    """Two phases for crowded tiles: ``partial`` shrinks pieces of a tile, ``finish`` merges them.

    ``partial`` gets a frame of a hashed piece of one tile and keeps the tile's
    column; ``finish`` gets all partial rows of one tile. The result must not
    depend on how rows are dealt to pieces.
    """
    dealt = tiled.withColumn("piece", F.pmod(F.xxhash64(*tiled.columns), F.lit(pieces)))
    shrunk = dealt.groupBy(tile, "piece").applyInPandas(
        lambda frame: partial(frame.drop(columns="piece")), partial_schema
    )
    return shrunk.groupBy(tile).applyInPandas(finish, schema)


def apply_per_chunk(
    df: DataFrame, function: Callable, schema: str, size: int, order: list[str], chunk: str = "chunk"
) -> DataFrame:
    """Run a pandas function over consecutive chunks of ``size`` rows in the order of ``order``.

    The order must be total; it, and not the partitioning, decides which rows
    form a chunk. The rows are range-sorted and counted per partition, so no
    task sees more than its range, and a call sees one chunk.
    """
    ranged = materialise(
        df.repartitionByRange(*order).withColumn("__part", F.spark_partition_id()), "ranged"
    )
    # one row per partition
    counts = ranged.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    starts = counts.select("__part", (F.sum("__n").over(Window.orderBy("__part")) - F.col("__n")).alias("__start"))
    place = F.row_number().over(Window.partitionBy("__part").orderBy(*order)) - 1
    numbered = ranged.withColumn("__place", place).join(F.broadcast(starts), "__part")
    chunked = numbered.withColumn(chunk, F.floor((F.col("__start") + F.col("__place")) / F.lit(size)).cast("bigint"))
    return chunked.drop("__part", "__place", "__start").groupBy(chunk).applyInPandas(function, schema)


def sample_per_tile(tiled: DataFrame, n: int, key: str, seed: int = 42, tile: str = "tile_id") -> DataFrame:
    """Up to ``n`` features of each tile, the same for the same seed.

    Ranks by the MD5 of seed and key; Spark keeps only the first ``n`` of a
    tile in each task before the shuffle.
    """
    drawn = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")).cast("binary"))
    order = Window.partitionBy(tile).orderBy(drawn, F.col(key))
    return tiled.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n).drop("rank")


def tile_ids(tiled: DataFrame, tile: str = "tile_id") -> DataFrame:
    """The occupied tiles in order."""
    return tiled.select(tile).distinct().orderBy(tile)


def by_tile(tiled: DataFrame, tile: str = "tile_id", salts: int = 1) -> DataFrame:
    """Bring the rows of a tile together; ``salts`` spreads each tile over that many tasks."""
    if salts == 1:
        return tiled.repartition(tile)
    return tiled.repartition(F.col(tile), F.pmod(F.xxhash64(*tiled.columns), F.lit(salts)))
