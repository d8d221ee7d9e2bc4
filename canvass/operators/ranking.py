"""Winners, keep-first and duplicates: ranking with explicit tie-breaks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.normalize import share


def winners(votes: DataFrame, keys: list[str], party: str, count: str, order: Column | None = None) -> DataFrame:
    """keys, valid_votes, winner, winner_votes, runner_up, runner_up_votes, margin, winner_share from long votes.

    Ties go to the party first in ``order`` (its name by default).  An area whose votes are all zero is won
    by its first party with share null; with one party the runner-up is null and the margin its votes.
    """
    own = Window.partitionBy(*keys)
    ordered = own.orderBy(F.col(count).desc(), order if order is not None else F.col(party).asc())
    ranked = votes.withColumns({"_rank": F.row_number().over(ordered), "valid_votes": F.sum(count).over(own).cast("bigint")}).where("_rank <= 2")
    best = ranked.groupBy(*keys, "valid_votes").agg(*[F.max(F.when(F.col("_rank") == rank, F.col(c))).alias(name) for rank, c, name in ((1, party, "winner"), (1, count, "winner_votes"), (2, party, "runner_up"), (2, count, "runner_up_votes"))])
    return best.select(
        *keys, "valid_votes", "winner", F.col("winner_votes").cast("bigint").alias("winner_votes"), "runner_up", F.col("runner_up_votes").cast("bigint").alias("runner_up_votes"),
        (F.col("winner_votes") - F.coalesce("runner_up_votes", F.lit(0))).cast("bigint").alias("margin"), share(F.col("winner_votes"), F.col("valid_votes")).alias("winner_share"),
    )


def keep_first(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row for each key: the first in a full order."""
    return df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_rank = 1").drop("_rank")


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that more than one row has, with n."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def top_k(df: DataFrame, k: int, order: list[Column]) -> DataFrame:
    return df.orderBy(*order).limit(k)
