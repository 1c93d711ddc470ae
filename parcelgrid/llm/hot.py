"""Joins with a table that has each key once, safe for keys that hold a large part of all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of the keyed side, of at most 100 bytes, are broadcast up to so many; beyond, they are joined by shuffle.
BROADCAST_ROWS = 200_000
#: A key with more than one in so many of all rows is hot: there are never more hot keys than this.
HOT_SHARE = 1000


def small(side: DataFrame) -> bool:
    return side.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS


def joined(rows: DataFrame, side: DataFrame, on: list[str], held: Column, total: int, how: str = "inner") -> DataFrame:
    """``rows`` joined, inner or left, with the row of their key in ``side``.

    ``held`` gives, of a row of ``side``, how many of the ``total`` rows have its
    key. Those of hot keys meet it by broadcast and are not shuffled.
    """
    if small(side):
        return rows.join(F.broadcast(side), on, how)
    hot = held > max(1, total // HOT_SHARE)
    crowded = F.broadcast(side.filter(hot))
    others = rows.join(crowded.select(*on), on, "left_anti").join(side.filter(~hot), on, how)
    return rows.join(crowded, on).unionByName(others)
