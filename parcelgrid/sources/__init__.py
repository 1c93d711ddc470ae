"""Readers and writers: GeoJSON, GeoParquet, partitioned layouts, generators."""
