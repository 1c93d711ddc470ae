"""Zone lookup of a stream of sensor readings against a standing set of fields."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from parcelgrid.operators.nearest import build_pyramid
from parcelgrid.operators.overlap import list_copies
from parcelgrid.plans.zone_lookup import RADIUS_M, zone_lookup
from parcelgrid.session import intermediates


def stream_zone_lookup(
    readings: DataFrame,
    fields: DataFrame,
    target: str,
    checkpoint: str,
    radius: float = RADIUS_M,
) -> StreamingQuery:
    """Look up each micro-batch and write it under ``batch=<number>``.

    The fields are made ready once and used by every batch. A batch that
    is run again after a failure overwrites its own folder, so results appear
    exactly once.
    """
    pyramid = build_pyramid(fields, carry=["crop_type"])
    listed = list_copies(fields, radius, keep=True)

    def look_up(batch: DataFrame, number: int) -> None:
        batch.persist()
        try:
            with intermediates(batch.sparkSession):
                found = zone_lookup(batch, fields, radius, pyramid, listed)
                found.write.mode("overwrite").parquet(f"{target}/batch={number}")
        finally:
            batch.unpersist()

    return (
        readings.writeStream.foreachBatch(look_up)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
