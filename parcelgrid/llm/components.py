"""Distributed union-find: connected components by alternating stars.

Each round points every node's larger neighbours at its smallest one, then the
smaller ones, which halves the depth of every chain of links. It ends when the
links form stars, which a count of each node's ends tells. All steps are grouped
aggregates and equi-joins; the links of a node with very many are aggregated
before they are shuffled and meet its row by broadcast. Nothing but two counts
per round reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelgrid.llm import hot
from parcelgrid.llm.scratch import Kept


def with_least(links: DataFrame, least: DataFrame, count: int) -> DataFrame:
    """``u, v, m``: the ``count`` links with the least ``m`` of their ``u``, from ``u, m, n``."""
    if count <= hot.BROADCAST_ROWS:  # there are no more rows of least than links
        return links.join(F.broadcast(least), "u")
    return hot.joined(links, Kept(least, "least").df, ["u"], F.col("n"), count)


def large_star(links: DataFrame, count: int) -> DataFrame:
    """Point each node's larger neighbours at the smallest among it and its neighbours."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
    least = least.select("u", F.least("u", "m").alias("m"), "n")
    met = with_least(both.filter("v > u"), least, 2 * count)
    return met.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v")


def small_star(links: DataFrame, count: int) -> DataFrame:
    """Point each node and its smaller neighbours at the smallest of them. Needs u > v."""
    least = links.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
    met = with_least(links, least, count)
    moved = met.filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def ends_and_bends(links: DataFrame) -> tuple[int, int]:
    """How many links there are, and how many nodes keep them from being stars: with two upper ends, or one of each kind."""
    upper = links.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    lower = links.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    nodes = upper.unionByName(lower).groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    bent = (F.col("up") > 1) | (F.col("up") + F.col("down") > 1)
    found = nodes.agg(F.sum("up"), F.count_if(bent)).first()
    return found[0] or 0, found[1]


def connected(links: DataFrame, a: str, b: str) -> DataFrame:
    """``node, root`` for every linked node that is not itself the smallest of its component.

    ``a`` and ``b`` are columns of one orderable type. Links may repeat, point
    either way or at themselves; rows with a null end are ignored. No links
    give no rows.
    """
    links = links.filter(f"`{a}` != `{b}`").select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    before, count = None, links.count()
    while True:
        large = large_star(links, count)
        # a star keeps no more links than it gets
        current = Kept(small_star(large, count) if count <= hot.BROADCAST_ROWS else small_star(Kept(large, "large-star").df, count), "links")
        if before is not None:
            before.drop()
        count, bends = ends_and_bends(current.df)
        if not bends:
            return current.df.select(F.col("u").alias("node"), F.col("v").alias("root"))
        links, before = current.df, current
