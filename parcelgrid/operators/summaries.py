"""Aggregates, top-n reports and chunk numbering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from parcelgrid.functions.box import box, total_bounds


def filter_counts(df: DataFrame, keep: Column) -> DataFrame:
    """Rows before and after a filter, in one pass."""
    return df.agg(F.count(F.lit(1)).alias("n_processed"), F.count_if(keep).alias("n_filtered"))


def extent(df: DataFrame) -> DataFrame:
    return df.agg(*total_bounds(box()))


def extent_by(df: DataFrame, *keys: str) -> DataFrame:
    """Extent per partition value, for pruning."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *total_bounds(box()))


def group_mean(df: DataFrame, key: str, value: str, name: str) -> DataFrame:
    return df.groupBy(key).agg(F.avg(value).alias(name))


def value_counts(df: DataFrame, key: str) -> DataFrame:
    """Most frequent first, ties by value."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), key)


def first_rows(df: DataFrame, n: int, *order: str) -> DataFrame:
    return df.orderBy(*order).limit(n)


def chunk_of(number: Column, size: int = 250) -> Column:
    """Chunk of a dense row number."""
    return F.floor(number / F.lit(size)).cast("bigint")


def numbered(df: DataFrame, name: str = "row_number") -> DataFrame:
    """Dense row numbers from 0 in scan order, without a global sort.

    Counts rows per partition (one row each, broadcast), then adds the running
    start to each row's place in its partition. ``df`` must read the same rows
    in the same order each time, as a file scan does; write out the result of
    a shuffle first.
    """
    marked = df.withColumn("__at", F.monotonically_increasing_id())
    part, place = F.shiftright("__at", 33), F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    counts = marked.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__n"))
    # one row per scan partition: small enough for one task
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        "__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start")
    )
    return (
        marked.withColumns({"__part": part, "__place": place})
        .join(F.broadcast(starts), "__part")
        .withColumn(name, F.col("__start") + F.col("__place"))
        .drop("__at", "__part", "__place", "__start")
    )


def chunk_statistics(df: DataFrame, chunk: Column, keep: Column) -> DataFrame:
    """Features and survivors per chunk."""
    return df.groupBy(chunk.alias("chunk")).agg(
        F.count(F.lit(1)).alias("n_features"), F.count_if(keep).alias("n_kept")
    )


def partition_statistics(df: DataFrame, keep: Column) -> DataFrame:
    """The same per scan partition, Spark's own chunks."""
    return chunk_statistics(df, F.spark_partition_id(), keep)
