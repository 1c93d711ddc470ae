"""Seeded synthetic tables of any size, generated in parallel."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelgrid.functions.scalar import padded_id, pick

_SPAN = 2**40


def uniform(seed: int, stream: int, low: float, high: float, number: str = "id") -> Column:
    """A value in [low, high) fixed by (seed, stream, row), whatever the partitioning."""
    raw = F.pmod(F.xxhash64(F.lit(seed), F.lit(stream), F.col(number)), F.lit(_SPAN))
    return F.lit(low) + raw / F.lit(float(_SPAN)) * F.lit(high - low)


def boxes(
    spark: SparkSession,
    n: int,
    extent: float = 100_000.0,
    widths: tuple[float, float] = (50.0, 400.0),
    heights: tuple[float, float] = (50.0, 300.0),
    crops: tuple[str, ...] = ("corn", "wheat", "soy", "cotton"),
    seed: int = 42,
) -> DataFrame:
    """Field rectangles in metres."""
    x, y = uniform(seed, 1, 0.0, extent), uniform(seed, 2, 0.0, extent)
    w, h = uniform(seed, 3, *widths), uniform(seed, 4, *heights)
    crop = pick(list(crops), F.xxhash64(F.lit(seed), F.lit(5), F.col("id")))
    return spark.range(n).select(
        F.col("id").alias("field_id"),
        padded_id("F", F.col("id")).alias("label"),
        crop.alias("crop_type"),
        F.bround(uniform(seed, 6, 1.0, 200.0), 2).alias("area_ha"),
        F.bround(uniform(seed, 7, 1.0, 20.0), 3).alias("yield_tha"),
        x.alias("minx"),
        y.alias("miny"),
        (x + w).alias("maxx"),
        (y + h).alias("maxy"),
    )


def points(spark: SparkSession, n: int, extent: float = 100_000.0, seed: int = 42) -> DataFrame:
    """Query points in metres."""
    return spark.range(n).select(
        F.col("id").alias("query_id"),
        uniform(seed, 11, 0.0, extent).alias("x"),
        uniform(seed, 12, 0.0, extent).alias("y"),
    )
