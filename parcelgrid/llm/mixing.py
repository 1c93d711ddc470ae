"""Mix sources to target weights by hash-threshold histograms.

Every document has a key of 60 hash bits. A source takes each document as many
whole times as its target allows, and once more those with a key below the
source's threshold. The thresholds come from histograms: the words of each
source by the top 12 bits of the key, then the one bucket on the boundary by
the next 12 bits, and so on until the boundary is one key. Nothing is sorted
but the buckets of a source, at most 4096 of them. All of it is DataFrame code.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelgrid.llm.scratch import Kept
from parcelgrid.llm.texts import WORD

KEY_BITS = 60
LEVEL_BITS = 12
#: Thresholds are one short row per source; beyond this many sources they are joined by shuffle.
BROADCAST_SOURCES = 10_000


@dataclass(frozen=True)
class Plan:
    """Weights go to the sources in code point order, null last, repeating."""

    weights: tuple[int, ...] = (1, 2, 3)
    most_repeats: int = 3


def words(text: Column) -> Column:
    """The number of words, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def hash_key(identity: Column) -> Column:
    """60 bits of the MD5 of the id as text; null counts as empty."""
    digits = F.substring(F.md5(F.coalesce(identity.cast("string"), F.lit("")).cast("binary")), 1, KEY_BITS // 4)
    return F.conv(digits, 16, 10).cast("long")


def targets(sizes: DataFrame, plan: Plan) -> DataFrame:
    """``source, source_size, target`` from ``source, source_size``.

    A level is sought at which every source gets level * weight words, but no
    more than ``most_repeats`` times its own. In the order of the level at
    which they are full, the first source that is not full sets the level. The
    windows run over one row per source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weights = F.array(*(F.lit(w) for w in plan.weights))
    turn = ((F.row_number().over(by_name) - 1) % F.lit(len(plan.weights))).cast("int")
    weighed = sizes.withColumn("weight", F.get(weights, turn)).withColumn(
        "cap", F.col("source_size") * F.lit(plan.most_repeats)
    )
    full = F.col("cap").cast("double") / F.col("weight")
    order = Window.orderBy(full, F.col("source").asc_nulls_last())
    before = F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    left = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    ranked = weighed.select(
        "*",
        F.row_number().over(order).alias("place"),
        ((F.sum("source_size").over(Window.partitionBy()) - before).cast("double") / left).alias("level"),
        full.alias("full"),
    )
    open_place = F.min(F.when(F.col("level") <= F.col("full"), F.col("place"))).over(Window.partitionBy())
    first = ranked.withColumn("open", open_place)
    level = F.max(F.when(F.col("place") == F.col("open"), F.col("level"))).over(Window.partitionBy())
    return first.withColumn("common", level).select(
        "source",
        "source_size",
        F.when(F.col("place") < F.col("open"), F.col("cap").cast("double"))
        .otherwise(F.col("common") * F.col("weight"))
        .alias("target"),
    )


def thresholds(rows: DataFrame, plan: Plan) -> DataFrame:
    """One row per source: its size and target, whole ``repeats``, and the boundary.

    ``rows`` has ``source, size, key``. Rows with a key below ``boundary`` are
    taken once more; of rows at the boundary, each has ``share`` words taken.
    """
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    repeats = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    aims = targets(sizes, plan).withColumn("repeats", repeats.cast("long"))
    rest = F.round("target").cast("long") - F.col("repeats") * F.col("source_size")
    aims = Kept(aims.withColumn("rest", F.greatest(rest, F.lit(0).cast("long"))), "targets").df
    open_ones = aims.filter("rest > 0").select("source", "rest", F.lit(0).cast("long").alias("bucket"))
    found = None
    for used in range(LEVEL_BITS, KEY_BITS + 1, LEVEL_BITS):
        marks = open_ones.withColumnRenamed("source", "of")
        inside = rows.join(
            F.broadcast(marks) if small(marks) else marks,
            rows.source.eqNullSafe(marks.of)
            & (F.shiftright("key", KEY_BITS - used + LEVEL_BITS) == marks.bucket),
        )
        histogram = inside.groupBy("source", "rest", F.shiftright("key", KEY_BITS - used).alias("bucket")).agg(
            F.sum("size").alias("held"), F.min("key").alias("low"), F.max("key").alias("high"), F.count("*").alias("n")
        )
        below = F.sum("held").over(Window.partitionBy("source").orderBy("bucket")) - F.col("held")
        crossed = histogram.withColumn("below", below).filter("below < rest AND rest <= below + held")
        step = Kept(crossed.withColumn("rest", F.col("rest") - F.col("below")), "boundary").df
        ended = step.filter("low = high").select(
            F.col("source").alias("of"), F.col("low").alias("boundary"), F.floor(F.col("rest") / F.col("n")).alias("share")
        )
        found = ended if found is None else found.unionByName(ended)
        open_ones = step.filter("low < high").select("source", "rest", "bucket")
        if open_ones.isEmpty():
            break
    return aims.join(found, aims.source.eqNullSafe(found.of), "left").select(
        F.col("source").alias("of"), "source_size", "target", "repeats", "boundary", "share"
    )


def small(per_source: DataFrame) -> bool:
    return per_source.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES


def taken() -> Column:
    """Words taken of a row with ``size, key`` and its source's thresholds."""
    once_more = (
        F.when(F.col("key") < F.col("boundary"), F.col("size"))
        .when(F.col("key") == F.col("boundary"), F.least("size", "share"))
        .otherwise(0)
    )
    return (F.col("repeats") * F.col("size") + once_more).cast("long")


def with_thresholds(rows: DataFrame, limits: DataFrame) -> DataFrame:
    limits = F.broadcast(limits) if small(limits) else limits
    return rows.join(limits, rows.source.eqNullSafe(F.col("of")))


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    plan: Plan = Plan(),
) -> DataFrame:
    """``id, size, source_size, target, taken``, one row per row of ``docs``.

    A null text has size 0, and so nothing of it is taken. A null source is a
    source of its own, the last. Rows of equal id share a key; those at the
    boundary share its words evenly. An empty table gives no rows. Other
    columns are not looked at. Reruns agree, whatever the partitioning.
    """
    rows = Kept(
        docs.select(
            docs[id_col].alias("id"),
            docs[source_col].alias("source"),
            words(docs[text_col]).alias("size"),
            hash_key(docs[id_col]).alias("key"),
        ),
        "sizes",
    ).df
    limits = Kept(thresholds(rows, plan), "thresholds").df
    return with_thresholds(rows, limits).select(
        F.col("id").alias(id_col), "size", "source_size", "target", taken().alias("taken")
    )


def mixed(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    plan: Plan = Plan(),
) -> DataFrame:
    """The mixed corpus: each row of ``docs`` as often as it is taken, with all its columns.

    The last repeat of the row on a source's boundary is cut after the words
    taken; rows of which nothing is taken go. Columns may have any names.
    """
    plain = docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))
    at = {c: f"c{docs.columns.index(c)}" for c in (id_col, text_col, source_col)}
    whole = plain.select(
        "*",
        F.col(at[source_col]).alias("source"),
        words(F.col(at[text_col])).alias("size"),
        hash_key(F.col(at[id_col])).alias("key"),
    )
    rows = Kept(whole.select("source", "size", "key"), "sizes").df
    limits = Kept(thresholds(rows, plan), "thresholds").df
    counted = with_thresholds(whole, limits).withColumn("taken", taken()).filter("taken > 0")
    full = F.floor(F.col("taken") / F.col("size")).cast("int")
    rest = F.col("taken") - full * F.col("size")
    pieces = F.concat(
        F.array_repeat(F.col("size"), full), F.when(rest > 0, F.array(rest)).otherwise(F.array().cast("array<bigint>"))
    )
    copies = counted.withColumn("piece", F.explode(pieces))
    in_words = F.regexp_extract_all(F.col(at[text_col]), F.lit(rf"[\x20\x09-\x0D]*{WORD}"), F.lit(0))
    text = F.when(F.col("piece") == F.col("size"), F.col(at[text_col])).otherwise(
        F.array_join(F.slice(in_words, F.lit(1), F.col("piece").cast("int")), "")
    )
    return copies.withColumn(at[text_col], text).select(
        *(F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns))
    )
