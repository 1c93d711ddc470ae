"""Incremental GeoJSON ingest: filter, project, append, in bounded memory."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from parcelgrid.plans.etl import MIN_AREA_HA, keep_large_fields
from parcelgrid.sources.geojson import decoded, feature_schema, features_of, sniff, text_options


def stream_geojson(
    spark: SparkSession,
    path: str,
    properties: T.StructType | str,
    srid: int = 4326,
    files_per_batch: int = 1,
    layout: str | None = None,
    prefix: str | None = None,
):
    """Features of every file that arrives below ``path``.

    The layout is that of a file already there, unless it is given. A later
    file of another layout fails its batch, which is then not checkpointed.
    """
    if layout is None:
        layout, prefix = sniff(spark, path)
    schema = feature_schema(properties)
    texts = (
        spark.readStream.format("text")
        .options(**text_options(layout, prefix))
        .option("maxFilesPerTrigger", files_per_batch)
        .load(path)
    )
    return decoded(features_of(texts, schema, layout), srid, "polygon")


def ingest_geojson(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str,
    properties: T.StructType | str,
    target_srid: int,
    min_area_ha: float = MIN_AREA_HA,
    files_per_batch: int = 1,
    layout: str | None = None,
    prefix: str | None = None,
) -> StreamingQuery:
    """Append the large fields with their projected area; stops when caught up."""
    features = stream_geojson(spark, source, properties, files_per_batch=files_per_batch, layout=layout, prefix=prefix)
    return (
        keep_large_fields(features, target_srid, min_area_ha)
        .writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .option("path", target)
        .trigger(availableNow=True)
        .start()
    )
