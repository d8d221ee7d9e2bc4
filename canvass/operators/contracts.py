"""Contracts that fail the job, and the reports behind them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class ContractError(ValueError):
    """A contract that does not hold, with a few of the rows that break it."""


def require_empty(bad: DataFrame, message: str, samples: int = 10) -> None:
    rows = bad.limit(samples).collect()
    if rows:
        raise ContractError(f"{message}: {[r.asDict() for r in rows]}")


def require_unique(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    require_empty(df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1"), f"{name}: keys {keys} are not unique")
    return df


def require_present(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    missing = [F.trim(F.coalesce(F.col(k).cast("string"), F.lit(""))) == "" for k in keys]
    bad = missing[0]
    for m in missing[1:]:
        bad = bad | m
    require_empty(df.where(bad), f"{name}: blank in {keys}")
    return df


def joined(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left", validate: str = "many_to_one") -> DataFrame:
    """A join with a cardinality contract: many_to_one or one_to_one.

    The contract is checked now, by a job over the right side's keys (and the left side's for one_to_one); join
    plainly and use :func:`require_unique` later to put that off.
    """
    require_unique(right, keys, "right side")
    if validate == "one_to_one":
        require_unique(left, keys, "left side")
    return left.join(right, keys, how)


def orphans(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child keys that no parent has, with their rows counted."""
    return child.join(parent, child[key] == parent[parent_key], "left_anti").groupBy(key).agg(F.count("*").alias("n_rows"))


def violations(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """rule, n_violations: every rule that should hold on every row, counted in one pass; null breaks a rule."""
    counts = df.agg(*[F.count_if(~F.coalesce(ok, F.lit(False))).alias(name) for name, ok in rules.items()])
    return counts.unpivot([], list(rules), "rule", "n_violations")


def require_rules(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """``df`` if every rule holds on every row."""
    require_empty(violations(df, rules).where("n_violations > 0"), "rules are broken")
    return df


def drifted(left: DataFrame, right: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """key, drift for the rows of ``left`` whose ``columns`` differ from those of the same key in ``right``.

    drift names the columns, joined by a bar; it is 'absent' where ``right`` has no such row.  Two nulls agree.
    """
    other = right.select(F.col(key).alias("_k"), *[F.col(c).alias(f"_r_{c}") for c in columns])
    both = left.join(other, left[key] == other["_k"], "left")
    changed = F.concat_ws("|", *[F.when(~F.col(c).eqNullSafe(F.col(f"_r_{c}")), F.lit(c)) for c in columns])
    return both.select(key, F.when(F.col("_k").isNull(), "absent").otherwise(changed).alias("drift")).where("drift <> ''")


def reconciled(expected: DataFrame, actual: DataFrame, keys: list[str], metrics: list[str]) -> DataFrame:
    """keys, metric, expected, actual, agrees: each metric of both sides, a missing side as null."""
    stack = f"stack({len(metrics)}, {', '.join(f'{chr(39)}{m}{chr(39)}, cast({m} as bigint)' for m in metrics)}) as (metric, n)"
    one, two = (df.select(*keys, F.expr(stack)).withColumnRenamed("n", name) for df, name in ((expected, "expected"), (actual, "actual")))
    return one.join(two, [*keys, "metric"], "full_outer").select(*keys, "metric", "expected", "actual", F.col("expected").eqNullSafe(F.col("actual")).alias("agrees"))


def conservation(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """key, before, after, conserved: counts of each group on both sides; a group that one side lost, null included, counts 0 there."""
    both = before.select(F.col(key).alias("_b"), "before").join(after.select(F.col(key).alias("_a"), "after"), F.col("_b").eqNullSafe(F.col("_a")), "full_outer")
    counts = both.select(F.coalesce("_b", "_a").alias(key), F.coalesce("before", F.lit(0)).alias("before"), F.coalesce("after", F.lit(0)).alias("after"))
    return counts.withColumn("conserved", F.col("before") == F.col("after"))


def set_difference(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """key, side for keys on one side only: both anti joins in one full join."""
    a, b = left.select(F.col(key)).distinct().withColumn("_l", F.lit(1)), right.select(F.col(key)).distinct().withColumn("_r", F.lit(1))
    both = a.join(b, key, "full_outer")
    return both.where("_l is null or _r is null").select(key, F.when(F.col("_r").isNull(), "missing").otherwise("extra").alias("side"))


def agreement_gate(compared: DataFrame, agrees: Column, keys: list[str], least: int, rate: float) -> DataFrame:
    """Comparisons, agreements and whether evidence passes: at least ``least`` comparisons and ``rate`` agreeing."""
    got = compared.groupBy(*keys).agg(F.count("*").alias("comparisons"), F.count_if(agrees).alias("agreements"))
    return got.withColumn("accepted", (F.col("comparisons") >= least) & (F.col("agreements") >= rate * F.col("comparisons")))


def field_sets(features: DataFrame, properties: str) -> DataFrame:
    """fields, n, lacking, more: each set of property names among ``features``, and how it differs from the most frequent one.

    Names come sorted and joined by a bar; sets of equal frequency go by name.  One row where all features agree.
    """
    sets = features.groupBy(F.array_sort(F.map_keys(properties)).alias("_f")).agg(F.count("*").alias("n"))
    usual = sets.orderBy(F.desc("n"), F.array_join("_f", "|")).limit(1).select(F.col("_f").alias("_u"))
    joined = sets.crossJoin(F.broadcast(usual))  # one row
    text = lambda c: F.array_join(c, "|")
    return joined.select(text("_f").alias("fields"), "n", text(F.array_except("_u", "_f")).alias("lacking"), text(F.array_except("_f", "_u")).alias("more"))
