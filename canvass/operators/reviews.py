"""Reviewed decisions that hold only while what was reviewed stays the same."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .contracts import ContractError, require_empty, require_unique

DECISIONS = ("approved", "deferred", "rejected")


def line_fingerprint(uid: str, target: str) -> Column:
    """sha256 of a group's sorted ``uid|target`` lines, joined by line breaks.

    A group is what a person reviews, so its lines fit in one row; :func:`aggregate.fingerprint` is the form
    for groups of any size.
    """
    lines = F.array_sort(F.collect_list(F.struct(F.col(uid).cast("string").alias("u"), F.col(target).cast("string").alias("t"))))
    return F.sha2(F.array_join(F.transform(lines, lambda x: F.concat(x["u"], F.lit("|"), F.coalesce(x["t"], F.lit("")))), "\n"), 256)


def attached(groups: DataFrame, reviews: DataFrame, keys: list[str]) -> DataFrame:
    """``groups`` (keys, n_rows, total, fingerprint) with decision, drift and applies.

    ``reviews`` has keys, decision and what was reviewed (reviewed_rows, reviewed_total, reviewed_fingerprint).
    A group without a review is pending.  drift: rows, totals, mapping or none; a review applies if it is
    approved and nothing has drifted.
    """
    both = groups.join(reviews, keys, "left")
    drift = (
        F.when(F.col("decision").isNull(), "none")
        .when(F.col("reviewed_rows") != F.col("n_rows"), "rows")
        .when(F.col("reviewed_total") != F.col("total"), "totals")
        .when(F.col("reviewed_fingerprint") != F.col("fingerprint"), "mapping")
        .otherwise("none")
    )
    shown = both.select(*keys, "n_rows", "total", "fingerprint", F.coalesce("decision", F.lit("pending")).alias("decision"), drift.alias("drift"))
    return shown.withColumn("applies", (F.col("decision") == "approved") & (F.col("drift") == "none"))


def require_current(groups: DataFrame, reviews: DataFrame, keys: list[str]) -> DataFrame:
    """:func:`attached`, which fails where a review is repeated, of an unknown kind, without its group, or approved and drifted."""
    require_unique(reviews, keys, "reviews")
    require_empty(reviews.where(~F.coalesce(F.col("decision").isin(*DECISIONS), F.lit(False))), "unsupported decision")
    require_empty(reviews.where("decision = 'approved'").join(groups, keys, "left_anti"), "approved group is absent")
    found = attached(groups, reviews, keys)
    require_empty(found.where("decision = 'approved' and drift <> 'none'"), "approved group has changed")
    return found


__all__ = ["ContractError", "attached", "line_fingerprint", "require_current"]
