"""Joins that no key can overload."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import saved

SMALL_ROWS = 150_000  # some 100 bytes each when broadcast
HOT_SHARE = 1000


def small(table: DataFrame, most: int = SMALL_ROWS) -> bool:
    """Whether a saved table of a few numbers a row has at most ``most`` rows, so that it may be broadcast."""
    return table.limit(most + 1).count() <= most


def dealt(rows: DataFrame, key: str, most: int) -> DataFrame:
    """``rows`` dealt by ``key`` into tasks of about ``most`` rows, however many a file or its row groups hold.

    For steps that make many rows of each: tasks then stay as large as they are when the table grows.
    """
    return rows.repartition(1 + rows.count() // most, key)


def spread_join(rows: DataFrame, table: DataFrame, key: str, how: str = "inner", known_small: bool | None = None, counted: str | None = None) -> DataFrame:
    """``rows`` joined with ``table``, in which a key stands once at most; ``how`` is inner, left or left_semi.

    A small table is broadcast; ``known_small`` spares the count.  ``counted`` names a column of the table with
    the number of rows of each key, which then need not be counted.  Otherwise keys that hold over a thousandth of ``rows``, a thousand keys at
    most, meet their rows of the table by broadcast and all others by shuffle, so a key never makes a task of
    its own; rows without a key are not shuffled.  Both inputs should be saved: they are read several times.
    """
    if small(table) if known_small is None else known_small:
        return rows.join(F.broadcast(table), key, how)
    if counted:
        counts = table.select(key, F.col(counted).alias("_n"))
        total = table.agg(F.sum(counted).alias("n")).first()["n"]
    else:
        counts = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_n"))
        total = rows.count()
    hot = F.broadcast(saved(counts.where(F.col("_n") * HOT_SHARE > F.lit(total)).select(key), "hot"))
    held = F.broadcast(table.join(hot, key, "left_semi"))
    parts = [rows.join(hot, key, "left_semi").join(held, key, how), rows.where(F.col(key).isNotNull()).join(hot, key, "left_anti").join(table, key, how)]
    if how == "left":
        parts.append(rows.where(F.col(key).isNull()).join(F.broadcast(table.limit(0)), key, how))
    together = parts[0]
    for part in parts[1:]:
        together = together.unionByName(part)
    return together
