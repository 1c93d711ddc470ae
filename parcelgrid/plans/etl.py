"""ETL pipelines: chunked GeoJSON ingest and the lake load."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelgrid.functions import crs
from parcelgrid.functions import ring as R
from parcelgrid.functions.box import box_of, centroid_x, centroid_y
from parcelgrid.operators.overlap import points_in_boxes
from parcelgrid.session import materialise
from parcelgrid.sources.lake import write_lake

#: Fixed value: smallest field kept, in hectares.
MIN_AREA_HA = 0.5


def with_projected_area(features: DataFrame, target: int, geom: str = "geom", name: str = "area_m2") -> DataFrame:
    """Add the planar area of the reprojected polygon."""
    return features.withColumn(name, R.area(crs.rings_to_utm(F.col(f"{geom}.rings"), target)))


def keep_large_fields(features: DataFrame, target: int, min_area_ha: float = MIN_AREA_HA) -> DataFrame:
    """Filter by stated area first, so only survivors are reprojected."""
    return with_projected_area(features.where(F.col("area_ha") > min_area_ha), target)


def split_valid(features: DataFrame, geom: str = "geom") -> tuple[DataFrame, DataFrame]:
    """(valid, rejected) by geometry; rows without a geometry are rejected.

    The verdict is written once: testing costs more than reading it back, and
    both parts, and whatever reads them twice, share it.
    """
    rings = F.col(f"{geom}.rings")
    staged = materialise(
        features.withColumns(
            {"is_valid": F.coalesce(R.is_valid(rings), F.lit(False)), "bbox": R.bounds_struct(rings)}
        ),
        "validated",
    )
    return staged.where("is_valid").drop("is_valid"), staged.where("not is_valid").drop("is_valid", "bbox")


def enrich_with_zone(fields: DataFrame, zones: DataFrame, field_id: str = "field_id") -> DataFrame:
    """Add the lowest zone whose box holds the field's centre, NULL if there is none.

    ``zones`` has ``zone_id`` and box columns.
    """
    b = box_of("bbox")
    centres = fields.select(field_id, centroid_x(b).alias("x"), centroid_y(b).alias("y"))
    hits = points_in_boxes(centres, zones.select("zone_id", *b._fields), point_id=field_id)
    lowest = hits.groupBy(field_id).agg(F.min("zone_id").alias("zone_id"))
    return fields.join(lowest, field_id, "left")


def lake_load(
    sources: list[DataFrame],
    target: int,
    zones: DataFrame,
    path: str,
    partition_by: list[str],
    cell_size: float,
    rejected_path: str | None = None,
    metrics: dict[str, Column] | None = None,
) -> None:
    """Harmonise coordinates, set invalid geometry apart, enrich, write.

    Each source has ``field_id``, attributes and ``geom``; SRIDs may differ
    from row to row.
    """
    combined = sources[0]
    for other in sources[1:]:
        combined = combined.unionByName(other, allowMissingColumns=True)
    moved = crs.harmonise_rings(combined, target)
    valid, rejected = split_valid(moved)
    enriched = enrich_with_zone(valid, zones).withColumn("area_m2", R.area(F.col("geom.rings")))
    write_lake(enriched.withColumns(metrics or {}), path, partition_by, cell_size)
    if rejected_path:
        rejected.write.parquet(rejected_path)
