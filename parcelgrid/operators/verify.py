"""Reconciling two result sets."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelgrid.functions.scalar import safe_ratio

# Default tolerances of the array library's closeness test.
RELATIVE_TOLERANCE = 1e-5
ABSOLUTE_TOLERANCE = 1e-8


def is_close(a: Column, b: Column, rtol: float = RELATIVE_TOLERANCE, atol: float = ABSOLUTE_TOLERANCE) -> Column:
    """``|a - b| <= atol + rtol·|b|``; two equal infinities or two NULLs are close."""
    near = F.abs(a - b) <= F.lit(atol) + F.lit(rtol) * F.abs(b)
    return F.coalesce(a.eqNullSafe(b) | near, F.lit(False))


def reconcile(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    exact: list[str],
    approximate: list[str],
    rtol: float = RELATIVE_TOLERANCE,
    atol: float = ABSOLUTE_TOLERANCE,
) -> DataFrame:
    """One row of counts, match percentages, largest errors and a verdict.

    Rows are counted per side, before they meet. A key that occurs more than
    once on a side cannot be matched: it is counted in ``n_duplicate_keys``,
    left out of the comparison, and the verdict is a mismatch.
    """
    columns = [*exact, *approximate]

    def keyed(df, side):
        # of a key's rows one is carried on, for comparison if it is the only one
        held = F.min(F.struct(*(F.col(c).alias(f"{side}_{c}") for c in columns))).alias(f"in_{side}")
        return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(f"n_{side}"), held)

    joined = keyed(left, "a").join(keyed(right, "b"), keys, "full_outer")
    both = (F.col("n_a") == 1) & (F.col("n_b") == 1)
    value = lambda side, c: F.col(f"in_{side}.{side}_{c}")
    same = {c: value("a", c).eqNullSafe(value("b", c)) for c in exact}
    same |= {c: is_close(value("a", c), value("b", c), rtol, atol) for c in approximate}
    counted = joined.agg(
        F.coalesce(F.sum("n_a"), F.lit(0)).alias("n_left"),
        F.coalesce(F.sum("n_b"), F.lit(0)).alias("n_right"),
        F.count_if((F.col("n_a") > 1) | (F.col("n_b") > 1)).alias("n_duplicate_keys"),
        F.count_if(both).alias("n_common"),
        *(F.count_if(both & ok).alias(f"n_match_{c}") for c, ok in same.items()),
        *(F.max(F.when(both, F.abs(value("a", c) - value("b", c)))).alias(f"max_error_{c}") for c in approximate),
    )
    complete = (F.col("n_left") == F.col("n_common")) & (F.col("n_right") == F.col("n_common"))
    all_match = reduce(
        lambda x, y: x & y, [F.col(f"n_match_{c}") == F.col("n_common") for c in columns], complete
    )
    percents = [
        (safe_ratio(F.col(f"n_match_{c}"), F.col("n_common"), 1.0) * 100.0).alias(f"match_pct_{c}")
        for c in columns
    ]
    return counted.select("*", *percents, F.when(all_match, "MATCH").otherwise("MISMATCH").alias("verdict"))


def differences(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows found on one side only, duplicates counted."""
    return (
        left.exceptAll(right).withColumn("side", F.lit("left"))
        .unionByName(right.exceptAll(left).withColumn("side", F.lit("right")))
    )


def comparison_report(df: DataFrame, path: str) -> None:
    """Write a one-row report as JSON."""
    df.write.mode("overwrite").json(path)
