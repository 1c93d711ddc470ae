"""Small scalar helpers shared by every operator."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

SQUARE_METRES_PER_HECTARE = 10000.0
METRES_PER_DEGREE = 111320.0


def lit_double(value) -> Column:
    return value if isinstance(value, Column) else F.lit(float(value))


def round_half_even(value: Column, places: int) -> Column:
    """Scale, round to the nearest even integer, scale back (array-library rounding)."""
    scale = float(10**places)
    return F.rint(value * scale) / F.lit(scale)


def clip(value: Column, low, high) -> Column:
    low = low if isinstance(low, Column) else F.lit(low)
    high = high if isinstance(high, Column) else F.lit(high)
    return F.least(F.greatest(value, low), high)


def truncate_to_int(value: Column) -> Column:
    """Cast to INT, dropping the fraction towards zero."""
    return value.cast("int")


def safe_ratio(numerator: Column, denominator: Column, otherwise: float = float("inf")) -> Column:
    """``numerator / denominator`` where the denominator is above 0, else ``otherwise``."""
    return F.when(denominator > 0, numerator / denominator).otherwise(F.lit(otherwise))


def padded_id(prefix: str, number: Column, width: int = 6) -> Column:
    """``F000042``; ids longer than the width are kept whole."""
    return F.format_string(f"{prefix}%0{width}d", number.cast("bigint"))


def pick(values: list[str], number: Column) -> Column:
    """The entry of ``values`` chosen by ``number`` modulo their count."""
    chosen = F.pmod(number, F.lit(len(values)))
    branches = reduce(
        lambda chain, item: chain.when(chosen == item[0], F.lit(item[1])),
        enumerate(values[:-1]),
        F.when(F.lit(False), F.lit(None).cast("string")),
    )
    return branches.otherwise(F.lit(values[-1]))


def mebibytes(n_bytes: Column) -> Column:
    return n_bytes / F.lit(1024.0 * 1024.0)


def hectares(area_m2: Column) -> Column:
    return area_m2 / F.lit(SQUARE_METRES_PER_HECTARE)


def flat_degree_hectares(size_deg: Column, height_ratio: float = 0.7) -> Column:
    """Area of a lon/lat rectangle with a flat metres-per-degree factor (no cos(lat))."""
    return hectares(
        size_deg * size_deg * height_ratio * METRES_PER_DEGREE * METRES_PER_DEGREE
    )


def planar_distance(x1, y1, x2, y2) -> Column:
    dx = lit_double(x1) - lit_double(x2)
    dy = lit_double(y1) - lit_double(y2)
    return F.sqrt(dx * dx + dy * dy)
