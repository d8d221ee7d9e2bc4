"""Grouped totals, subtotals, residuals, fingerprints and coverage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.normalize import share


def distinct_joined(c: Column, sep: str = "|") -> Column:
    """Sorted distinct values of a group in one text; blanks are left out."""
    return F.array_join(F.array_sort(F.collect_set(F.nullif(c.cast("string"), F.lit("")))), sep)


def subtotals(df: DataFrame, outer: list[str], inner: list[str], label: str, all_label: str, aggs: list[Column]) -> DataFrame:
    """Groups of outer + inner, and for each outer group a row whose ``label`` column says ``all_label``.

    One pass with GROUPING SETS; the other inner columns of a subtotal row are ''.
    """
    sets = [[F.col(c) for c in outer + inner], [F.col(c) for c in outer]]
    made = df.groupingSets(sets, *[F.col(c) for c in outer + inner]).agg(F.grouping(label).alias("_all"), *aggs)
    shown = [F.when(F.col("_all") == 1, all_label if c == label else "").otherwise(F.col(c).cast("string")).alias(c) for c in inner]
    names = [c for c in made.columns if c not in {*outer, *inner, "_all"}]
    return made.select(*outer, *shown, *names)


def residuals(df: DataFrame, key: str, assigned: Column, metrics: list[str]) -> DataFrame:
    """What each group's assigned rows leave of its totals, for each metric."""
    aggs = [(F.sum(m) - F.coalesce(F.sum(F.when(assigned, F.col(m))), F.lit(0))).cast("bigint").alias(f"{m}_left") for m in metrics]
    return df.groupBy(key).agg(F.count_if(~assigned).alias("rows_left"), *aggs)


def fingerprint(df: DataFrame, key: str, uid: str, target: str) -> DataFrame:
    """SHA-256 of each group's sorted 'uid|target' lines: it does not depend on row order.

    A digest of sorted lines needs lines together.  They are hashed within 4,096 slices of the uid space, each
    a group of its own, so a hot group is dealt out and what comes together for it is 4,096 digests at most.
    """
    line = F.concat_ws("|", F.col(uid).cast("string"), F.col(target).cast("string"))
    slices = df.select(F.col(key), line.alias("_line"), F.substring(F.sha2(F.col(uid).cast("string"), 256), 1, 3).alias("_slice"))
    part = slices.groupBy(key, "_slice").agg(F.count("*").alias("_n"), F.sha2(F.array_join(F.array_sort(F.collect_list("_line")), "\n"), 256).alias("_sha"))
    lines = F.array_sort(F.collect_list(F.concat_ws("|", "_slice", "_sha")))
    return part.groupBy(key).agg(F.sum("_n").alias("n_rows"), F.sha2(F.array_join(lines, "\n"), 256).alias("sha256"))


def coverage(df: DataFrame, keys: list[str], covered: Column, weight: str) -> DataFrame:
    """Rows and weight of each group, covered and in all, with shares; partial below 95 percent."""
    got = df.groupBy(*keys).agg(F.count("*").alias("n_rows"), F.count_if(covered).alias("n_covered"), F.sum(weight).cast("bigint").alias("weight"), F.coalesce(F.sum(F.when(covered, F.col(weight))), F.lit(0)).cast("bigint").alias("weight_covered"))
    covered_share = share(F.col("weight_covered"), F.col("weight"))
    return got.withColumn("share", covered_share).withColumn("partial", F.coalesce(F.col("share") < 0.95, F.lit(True)))


def persistence(df: DataFrame, entity: str, period: str, periods: list[str]) -> DataFrame:
    """For each entity: in how many of the periods it occurs, which, and a status."""
    held = df.where(F.col(period).isin(periods)).groupBy(entity).agg(F.array_sort(F.collect_set(period)).alias("_p"))
    n = F.size("_p")
    status = F.when(n == len(periods), "always").when(n >= 0.75 * len(periods), "mostly").when(n >= 0.4 * len(periods), "sometimes").otherwise("rarely")
    missing = F.array_join(F.array_except(F.array(*[F.lit(p) for p in sorted(periods)]), F.col("_p")), "|")
    return held.select(entity, n.cast("bigint").alias("n_present"), F.array_join("_p", "|").alias("present"), missing.alias("missing"), status.alias("status"))
