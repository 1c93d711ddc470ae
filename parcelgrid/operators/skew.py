"""Equi-joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelgrid.session import materialise

#: Rows of one key, on either side, that a single task may take before the key is split.
ROWS_PER_TASK = 1_000_000

#: Comparisons within one key that a single task may take.
PAIRS_PER_TASK = 1_000_000_000

#: Largest side, in rows, that is broadcast. Callers pass a counted row bound;
#: rows are narrow (tens of bytes), so this stays within a few tens of MB.
BROADCAST_ROWS = 200_000


def broadcast_if_small(df: DataFrame, max_rows: int) -> DataFrame:
    """Hint a broadcast when the counted bound ``max_rows`` allows it."""
    return F.broadcast(df) if max_rows <= BROADCAST_ROWS else df


def hot_keys(
    left_counts: DataFrame, right_counts: DataFrame, keys: list[str], n: str = "n", pairs_per_task: int | None = None
) -> DataFrame:
    """Keys to split, with ``left_salts`` and ``right_salts`` pieces.

    Both tables have one row per key and its row count. A key is split until no
    piece has more than ``ROWS_PER_TASK`` rows of either side, nor more than
    ``pairs_per_task`` pairs of rows, ``PAIRS_PER_TASK`` if it is not given.
    """
    both = left_counts.select(*keys, F.col(n).alias("n_left")).join(
        right_counts.select(*keys, F.col(n).alias("n_right")), keys
    )
    pieces = lambda rows: F.ceil(rows / F.lit(float(ROWS_PER_TASK)))
    split = both.withColumns({"by_left": pieces(F.col("n_left")), "right_salts": pieces(F.col("n_right")).cast("int")})
    pairs = F.col("n_left").cast("double") * F.col("n_right") / (F.col("by_left") * F.col("right_salts"))
    more = F.greatest(F.ceil(pairs / F.lit(float(pairs_per_task or PAIRS_PER_TASK))), F.lit(1))
    # no more pieces than rows
    left_salts = F.least(F.col("by_left") * more, F.col("n_left")).cast("int")
    return split.select(*keys, left_salts.alias("left_salts"), "right_salts").where("left_salts > 1 OR right_salts > 1")


def keyed_join(
    left: DataFrame, right: DataFrame, keys: list[str], how: str, condition: Column | None = None
) -> DataFrame:
    """Equi-join on ``keys`` plus an extra condition; the right keys are dropped."""
    renamed = right.withColumnsRenamed({k: f"__{k}" for k in keys})
    on = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"__{k}") for k in keys])
    if condition is not None:
        on = on & condition
    return left.join(renamed, on, how).drop(*(f"__{k}" for k in keys))


def dealt_out(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    spread_by: str | list[str],
    key_counts: DataFrame | None = None,
    pairs: int | None = None,
    right_counts: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame, list[str]]:
    """Both sides with salts for their hot keys, and the keys by which every pair meets in exactly one piece.

    The hot keys are written once and broadcast only if they are few.
    """
    counts = lambda df: df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    left_counts = key_counts if key_counts is not None else counts(left)
    hot = hot_keys(left_counts, right_counts if right_counts is not None else counts(right), keys, pairs_per_task=pairs)
    hot = materialise(hot, "hot-keys")
    n_hot = hot.limit(BROADCAST_ROWS + 1).count()
    if not n_hot:
        return left, right, keys
    hot = broadcast_if_small(hot, n_hot)
    none = F.lit(1)

    def dealt(df: DataFrame, own: str, other: str, spread: list) -> DataFrame:
        marked = df.join(hot, keys, "left")
        salt = F.pmod(F.xxhash64(*spread), F.coalesce(own, none)).cast("int")
        repeats = F.explode(F.sequence(F.lit(0), F.coalesce(other, none) - 1))
        return marked.withColumns({own.replace("salts", "salt"): salt}).withColumn(
            other.replace("salts", "salt"), repeats
        ).drop(own, other)

    return (
        dealt(left, "left_salts", "right_salts", [spread_by] if isinstance(spread_by, str) else spread_by),
        dealt(right, "right_salts", "left_salts", right.columns),
        [*keys, "left_salt", "right_salt"],
    )


def salted_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    spread_by: str | list[str],
    how: str = "left",
    key_counts: DataFrame | None = None,
    condition: Column | None = None,
    right_counts: DataFrame | None = None,
) -> DataFrame:
    """Join on ``keys``; a hot key is dealt out over several tasks.

    Rows of a hot key get a salt on their own side and are repeated once per
    salt of the other, so every pair meets in exactly one piece. Cold keys are
    one piece. With ``how="left"`` and a key split on the right, a left row may
    come out several times without a match; fold by it. Counts of the keys, or
    of those that may be hot, may be passed for either side.
    """
    left, right, on = dealt_out(left, right, keys, spread_by, key_counts, right_counts=right_counts)
    joined = keyed_join(left, right, on, how, condition)
    return joined.drop("left_salt", "right_salt")
