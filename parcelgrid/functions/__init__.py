"""Column builders: geometry, reprojection and scalar helpers."""
