"""Points taken by their spot: what hangs on the position alone is worked out once per spot."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelgrid.operators import skew
from parcelgrid.session import materialise

SPOT = ["x", "y"]


def located(queries: DataFrame, query_id: str, x: str, y: str) -> DataFrame:
    """``query_id, x, y``, with positions that are not finite as null."""
    return queries.select(
        F.col(query_id).alias("query_id"),
        *(F.when(F.abs(c) < F.lit(float("inf")), F.col(c)).alias(n) for c, n in ((x, "x"), (y, "y"))),
    )


def spots_of(points: DataFrame) -> DataFrame:
    """The distinct positions of :func:`located` points, with their number of points ``n``; written."""
    whole = points.where("x IS NOT NULL AND y IS NOT NULL")
    return materialise(whole.groupBy(*SPOT).agg(F.count(F.lit(1)).alias("n")), "spots")


def at_spots(points: DataFrame, spots: DataFrame, found: DataFrame) -> DataFrame:
    """``query_id`` of every point with the columns of ``found`` (one row per spot, or none), null where there is none.

    A spot with very many points is dealt over tasks, and so are the points without a position.
    """
    keys = ["kx", "ky"]
    as_keys = dict(zip(SPOT, keys))
    whole = F.col("x").isNotNull() & F.col("y").isNotNull()
    lost = F.xxhash64("query_id")
    own = points.select(
        "query_id",
        whole.alias("whole"),
        *(F.when(whole, F.col(c)).otherwise(lost.cast("double")).alias(k) for c, k in as_keys.items()),
    )
    crowded = spots.where(F.col("n") > F.lit(skew.ROWS_PER_TASK)).withColumnsRenamed(as_keys)
    one = crowded.withColumn("n", F.lit(1))
    met = skew.salted_join(
        own, found.withColumnsRenamed(as_keys), keys, "query_id", "left", crowded, F.col("whole"), one
    )
    return met.drop("whole", *keys)
