"""Partitioned Parquet layouts, schema evolution and storage audits."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelgrid.functions.scalar import mebibytes


def layout_cell(minx: Column, miny: Column, size: float) -> list[Column]:
    """Sort key that puts neighbours into the same row groups."""
    return [F.floor(minx / size), F.floor(miny / size)]


def write_lake(
    df: DataFrame,
    path: str,
    partition_by: list[str],
    cell_size: float,
    mode: str = "error",
    compression: str = "snappy",
) -> None:
    """Hive folders per partition value, rows clustered by cell inside each.

    Ranges over (partition columns, cell, position) share a crowded value among
    several tasks and give each file a tight ``bbox``, which readers skip by.
    """
    cell = layout_cell(F.col("bbox.minx"), F.col("bbox.miny"), cell_size)
    order = [*partition_by, *cell, F.col("bbox.minx"), F.col("bbox.miny")]
    (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .write.mode(mode)
        .option("compression", compression)
        .partitionBy(*partition_by)
        .parquet(path)
    )


def read_window(df: DataFrame, window: tuple[float, float, float, float]) -> DataFrame:
    """Rows whose ``bbox`` meets the window; the four comparisons reach the scan."""
    minx, miny, maxx, maxy = window
    return df.where(
        (F.col("bbox.minx") <= maxx)
        & (F.col("bbox.maxx") >= minx)
        & (F.col("bbox.miny") <= maxy)
        & (F.col("bbox.maxy") >= miny)
    )


def read_evolved(spark: SparkSession, *paths: str) -> DataFrame:
    """Files of different ages as one table; columns added later are NULL before."""
    return spark.read.option("mergeSchema", True).parquet(*paths)


def combined(*frames: DataFrame) -> DataFrame:
    """One table over several sources; missing columns become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def short_names(df: DataFrame, width: int = 10) -> DataFrame:
    """Column names cut to a fixed width; names that collide raise."""
    names = [c[:width] for c in df.columns]
    if len(set(names)) < len(names):
        twice = sorted({n for n in names if names.count(n) > 1})
        raise ValueError(f"names collide when cut to {width}: {twice}")
    return df.toDF(*names)


def write_once(df: DataFrame, path: str) -> DataFrame:
    """Write unless the path is there already, then read it."""
    df.write.mode("ignore").parquet(path)
    return df.sparkSession.read.parquet(path)


def size_audit(spark: SparkSession, paths: dict[str, str], baseline: str) -> DataFrame:
    """Files, size and ratio to a baseline for each named dataset.

    Lists files only; their contents are not read.
    """
    listed = reduce(
        DataFrame.unionByName,
        (
            spark.read.format("binaryFile")
            .option("recursiveFileLookup", True)
            .load(path)
            .select(F.lit(name).alias("format"), "length")
            for name, path in paths.items()
        ),
    )
    sizes = listed.groupBy("format").agg(F.count(F.lit(1)).alias("n_files"), F.sum("length").alias("n_bytes"))
    base = sizes.where(F.col("format") == baseline).select("n_bytes").scalar()
    return sizes.withColumn("size_mb", mebibytes(F.col("n_bytes"))).withColumn(
        "ratio_to_baseline", F.col("n_bytes") / base
    )
