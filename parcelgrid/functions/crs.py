"""Reprojection between WGS84 lon/lat and UTM as Column arithmetic.

The transverse Mercator series of Krüger, to sixth order in the third
flattening; accurate to well below a millimetre inside a UTM zone. All
coefficients are literals, so the expression stays in generated code.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelgrid.functions.ring import let, vertex
from parcelgrid.functions.scalar import lit_double

WGS84 = 4326

# WGS84 ellipsoid and UTM grid constants.
SEMI_MAJOR_AXIS = 6378137.0
INVERSE_FLATTENING = 298.257223563
UTM_SCALE = 0.9996
FALSE_EASTING = 500000.0
FALSE_NORTHING_SOUTH = 10000000.0

_F = 1.0 / INVERSE_FLATTENING
_N = _F / (2.0 - _F)
_E = math.sqrt(_F * (2.0 - _F))

#: Radius of the rectifying circle.
RECTIFYING_RADIUS = (
    SEMI_MAJOR_AXIS / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64 + _N**6 / 256)
)

#: Published series coefficients in powers of the third flattening.
KRUGER_ALPHA = (
    _N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16 + 41 * _N**4 / 180 - 127 * _N**5 / 288 + 7891 * _N**6 / 37800,
    13 * _N**2 / 48 - 3 * _N**3 / 5 + 557 * _N**4 / 1440 + 281 * _N**5 / 630 - 1983433 * _N**6 / 1935360,
    61 * _N**3 / 240 - 103 * _N**4 / 140 + 15061 * _N**5 / 26880 + 167603 * _N**6 / 181440,
    49561 * _N**4 / 161280 - 179 * _N**5 / 168 + 6601661 * _N**6 / 7257600,
    34729 * _N**5 / 80640 - 3418889 * _N**6 / 1995840,
    212378941 * _N**6 / 319334400,
)


def utm_zone(srid: int) -> tuple[int, bool]:
    """(zone, southern) of a WGS84 / UTM code; anything else raises."""
    zone, south = srid % 100, srid // 100 == 327
    if srid // 100 not in (326, 327) or not 1 <= zone <= 60:
        raise ValueError(f"unsupported target SRID {srid}: only 326zz and 327zz")
    return zone, south


def central_meridian(srid: int) -> float:
    return utm_zone(srid)[0] * 6.0 - 183.0


def _conformal(lon: Column, lat: Column, srid: int) -> tuple[Column, Column]:
    """Spherical transverse coordinates (xi, eta) of a geographic position."""
    sin_lat = F.sin(F.radians(lat))
    tau = F.sinh(F.atanh(sin_lat) - F.lit(_E) * F.atanh(F.lit(_E) * sin_lat))
    dlon = F.radians(lon - F.lit(central_meridian(srid)))
    xi = F.atan2(tau, F.cos(dlon))
    eta = F.asinh(F.sin(dlon) / F.sqrt(tau * tau + F.cos(dlon) * F.cos(dlon)))
    return xi, eta


def _easting(xi: Column, eta: Column) -> Column:
    series = eta
    for j, alpha in enumerate(KRUGER_ALPHA, start=1):
        series = series + F.lit(alpha) * F.cos(xi * (2.0 * j)) * F.sinh(eta * (2.0 * j))
    return F.lit(FALSE_EASTING) + F.lit(UTM_SCALE * RECTIFYING_RADIUS) * series


def _northing(xi: Column, eta: Column, south: bool) -> Column:
    series = xi
    for j, alpha in enumerate(KRUGER_ALPHA, start=1):
        series = series + F.lit(alpha) * F.sin(xi * (2.0 * j)) * F.cosh(eta * (2.0 * j))
    return F.lit(FALSE_NORTHING_SOUTH if south else 0.0) + F.lit(UTM_SCALE * RECTIFYING_RADIUS) * series


def _ordered(first, second, axis_order: str) -> tuple[Column, Column]:
    if axis_order not in ("xy", "yx"):
        raise ValueError("axis_order is 'xy' (lon, lat) or 'yx' (lat, lon)")
    first, second = lit_double(first), lit_double(second)
    return (first, second) if axis_order == "xy" else (second, first)


def _in_range(lon: Column, lat: Column) -> Column:
    return (F.abs(lat) < 90.0) & (F.abs(lon) <= 360.0)


def to_utm(first, second, srid: int, axis_order: str = "xy") -> tuple[Column, Column]:
    """(easting, northing) of a lon/lat pair; NULL where the latitude is out of range."""
    lon, lat = _ordered(first, second, axis_order)
    valid = _in_range(lon, lat)
    xi, eta = _conformal(lon, lat, srid)
    south = utm_zone(srid)[1]
    return F.when(valid, _easting(xi, eta)), F.when(valid, _northing(xi, eta, south))


def with_utm(
    df: DataFrame,
    lon: str,
    lat: str,
    srid: int,
    easting: str = "easting",
    northing: str = "northing",
    axis_order: str = "xy",
) -> DataFrame:
    """Add easting and northing columns.

    Two projections: the conformal pair is computed once per row and shared by
    both series, which Catalyst keeps apart because neither side is cheap.
    """
    first, second = _ordered(F.col(lon), F.col(lat), axis_order)
    valid = _in_range(first, second)
    xi, eta = _conformal(first, second, srid)
    south = utm_zone(srid)[1]
    staged = df.withColumns({"__xi": F.when(valid, xi), "__eta": F.when(valid, eta)})
    return staged.withColumns(
        {
            easting: _easting(F.col("__xi"), F.col("__eta")),
            northing: _northing(F.col("__xi"), F.col("__eta"), south),
        }
    ).drop("__xi", "__eta")


def rings_to_utm(rings: Column, srid: int) -> Column:
    """Move every vertex of a polygon; edges stay straight."""
    south = utm_zone(srid)[1]

    def move(p):
        lon, lat = p.getField("x"), p.getField("y")
        xi, eta = _conformal(lon, lat, srid)
        projected = let(
            F.struct(xi.alias("xi"), eta.alias("eta")),
            lambda s: vertex(
                _easting(s.getField("xi"), s.getField("eta")),
                _northing(s.getField("xi"), s.getField("eta"), south),
            ),
        )
        return F.when(_in_range(lon, lat), projected).otherwise(
            F.struct(F.lit(None).cast("double").alias("x"), F.lit(None).cast("double").alias("y"))
        )

    return F.transform(rings, lambda ring: F.transform(ring, move))


def transform_rings(rings: Column, source: int, target: int) -> Column:
    """Reproject a polygon column; the same code on both sides is a no-op."""
    if source == target:
        return rings
    if source != WGS84:
        raise ValueError(f"unsupported source SRID {source}: only {WGS84}")
    return rings_to_utm(rings, target)


def harmonise_points(df: DataFrame, target: int, x: str = "x", y: str = "y", srid: str = "srid") -> DataFrame:
    """Bring points of mixed SRIDs (the target itself or 4326) to one SRID.

    Rows of any other SRID raise when they are evaluated: mixing coordinate
    systems silently is the fault this operator exists to prevent.
    """
    east, north = to_utm(F.col(x), F.col(y), target)
    code = F.coalesce(F.col(srid).cast("string"), F.lit("NULL"))
    unknown = F.raise_error(F.concat(F.lit("unsupported SRID "), code)).cast("double")
    nowhere = F.col(x).isNull() | F.col(y).isNull()

    def placed(own, projected):
        known = F.when(F.col(srid) == target, own).when(F.col(srid) == WGS84, projected)
        return F.when(nowhere, F.lit(None).cast("double")).otherwise(F.coalesce(known, F.when(~F.col(srid).isin(target, WGS84) | F.col(srid).isNull(), unknown)))

    moved = {x: placed(F.col(x), east), y: placed(F.col(y), north)}
    return df.withColumns(moved).withColumn(srid, F.lit(target))


def harmonise_rings(df: DataFrame, target: int, geom: str = "geom") -> DataFrame:
    """The same for ``STRUCT<srid, rings>`` polygons; without rings there is nothing to move."""
    rings, srid = F.col(f"{geom}.rings"), F.col(f"{geom}.srid")
    code = F.coalesce(srid.cast("string"), F.lit("NULL"))
    unknown = F.raise_error(F.concat(F.lit("unsupported SRID "), code)).cast(
        df.select(rings).schema[0].dataType
    )
    moved = (
        F.when(rings.isNull(), F.lit(None))
        .when(srid == target, rings)
        .when(srid == WGS84, rings_to_utm(rings, target))
        .otherwise(unknown)
    )
    return df.withColumn(geom, F.struct(F.lit(target).alias("srid"), moved.alias("rings")))


def axis_swap_audit(df: DataFrame, lon: str, lat: str, srid: int, limit_m: float = 100.0) -> DataFrame:
    """Compare both axis orders per row: displacement and whether it matters.

    A swapped pair whose latitude is out of range has no position at all; its
    displacement is NULL and the row is flagged.
    """
    right_x, right_y = to_utm(F.col(lon), F.col(lat), srid, "xy")
    wrong_x, wrong_y = to_utm(F.col(lon), F.col(lat), srid, "yx")
    staged = df.withColumns(
        {"__rx": right_x, "__ry": right_y, "__wx": wrong_x, "__wy": wrong_y}
    )
    dx, dy = F.col("__rx") - F.col("__wx"), F.col("__ry") - F.col("__wy")
    return (
        staged.withColumn("axis_error_m", F.sqrt(dx * dx + dy * dy))
        .withColumn("axis_suspect", F.coalesce(F.col("axis_error_m") > limit_m, F.lit(True)))
        .drop("__rx", "__ry", "__wx", "__wy")
    )


def projjson(srid: int) -> dict | None:
    """PROJJSON for file metadata; None stands for lon/lat, the format's default."""
    if srid == WGS84:
        return None
    zone, south = utm_zone(srid)
    return {
        "$schema": "https://proj.org/schemas/v0.7/projjson.schema.json",
        "type": "ProjectedCRS",
        "name": f"WGS 84 / UTM zone {zone}{'S' if south else 'N'}",
        "base_crs": {
            "type": "GeographicCRS",
            "name": "WGS 84",
            "datum": {
                "type": "GeodeticReferenceFrame",
                "name": "World Geodetic System 1984",
                "ellipsoid": {
                    "name": "WGS 84",
                    "semi_major_axis": SEMI_MAJOR_AXIS,
                    "inverse_flattening": INVERSE_FLATTENING,
                },
            },
            "coordinate_system": {
                "subtype": "ellipsoidal",
                "axis": [
                    {"name": "Geodetic latitude", "abbreviation": "Lat", "direction": "north", "unit": "degree"},
                    {"name": "Geodetic longitude", "abbreviation": "Lon", "direction": "east", "unit": "degree"},
                ],
            },
            "id": {"authority": "EPSG", "code": WGS84},
        },
        "conversion": {
            "name": f"UTM zone {zone}{'S' if south else 'N'}",
            "method": {"name": "Transverse Mercator", "id": {"authority": "EPSG", "code": 9807}},
            "parameters": [
                {"name": "Latitude of natural origin", "value": 0, "unit": "degree"},
                {"name": "Longitude of natural origin", "value": central_meridian(srid), "unit": "degree"},
                {"name": "Scale factor at natural origin", "value": UTM_SCALE, "unit": "unity"},
                {"name": "False easting", "value": FALSE_EASTING, "unit": "metre"},
                {"name": "False northing", "value": FALSE_NORTHING_SOUTH if south else 0.0, "unit": "metre"},
            ],
        },
        "coordinate_system": {
            "subtype": "Cartesian",
            "axis": [
                {"name": "Easting", "abbreviation": "E", "direction": "east", "unit": "metre"},
                {"name": "Northing", "abbreviation": "N", "direction": "north", "unit": "metre"},
            ],
        },
        "id": {"authority": "EPSG", "code": srid},
    }
