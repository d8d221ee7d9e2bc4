"""Wide and long forms, and unions of tables whose columns differ."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def to_long(wide: DataFrame, ids: list[str], parties: list[str], party: str = "party", votes: str = "votes") -> DataFrame:
    return wide.unpivot(ids, parties, party, votes)


def to_wide(long: DataFrame, keys: list[str], party: str, votes: str, parties: list[str]) -> DataFrame:
    """One column for each listed party; listing them saves a pass over the data, and absent ones are 0."""
    return long.groupBy(*keys).pivot(party, parties).agg(F.sum(votes).cast("bigint")).na.fill(0, parties)


def union_by_name(frames: list[DataFrame]) -> DataFrame:
    """All rows; a column that a frame lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def column_totals(wide: DataFrame, parties: list[str]) -> DataFrame:
    """party, total_votes: sums first, then one small row is turned."""
    sums = wide.agg(*[F.coalesce(F.sum(p), F.lit(0)).cast("bigint").alias(p) for p in parties])
    return sums.unpivot([], parties, "party", "total_votes")
