"""The ordered evidence cascade: each fact takes the first source that has a guarded answer for it, with provenance."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


FACTS_IN_TASK = 200_000


@dataclass(frozen=True)
class Evidence:
    """One source: rows (uid, target), the class and confidence of its answers, and a guard on the fact."""

    method: str
    rows: DataFrame
    evidence_class: str
    confidence: str
    synthetic: bool = False
    guard: Column | None = None


def resolve(facts: DataFrame, uid: str, sources: list[Evidence], target: str = "target") -> DataFrame:
    """facts with target, method, evidence_class, confidence and synthetic.

    Sources stand in order of precedence.  A source that repeats a uid with one target counts once; one that gives a uid
    two targets fails the job when it runs, so no fact is ever doubled.  All answers meet in one aggregation,
    one join and one ordered choice: a join for each source would sort all of them in one task at once; a fact without an answer is 'unresolved'.
    """
    kind = sources[0].rows.schema[1].dataType
    tasks = _tasks(facts)
    answers = _one_each(sources, kind, tasks)
    out, chosen = facts.repartition(tasks, uid).join(answers, F.col(uid) == F.col("_u"), "left"), []
    for i, s in enumerate(sources):
        holds = F.col(f"_t{i}").isNotNull() if s.guard is None else F.col(f"_t{i}").isNotNull() & F.coalesce(s.guard, F.lit(False))
        answer = F.struct(F.col(f"_t{i}").alias("target"), F.lit(s.method).alias("method"), F.lit(s.evidence_class).alias("evidence_class"), F.lit(s.confidence).alias("confidence"), F.lit(s.synthetic).alias("synthetic"))
        chosen.append(F.when(holds, answer))
    none = F.struct(F.lit(None).cast(kind).alias("target"), F.lit("unresolved").alias("method"), F.lit("unresolved").alias("evidence_class"), F.lit("none").alias("confidence"), F.lit(False).alias("synthetic"))
    answer = F.coalesce(*chosen, none)
    out = out.withColumn("_answer", answer)
    return out.select(*facts.columns, F.col("_answer.target").alias(target), "_answer.method", "_answer.evidence_class", "_answer.confidence", "_answer.synthetic")


def _together(sources: list[Evidence], kind) -> DataFrame:
    """_u, _i, _t: the rows of all sources with their place in the order."""
    parts = [s.rows.select(F.col(s.rows.columns[0]).alias("_u"), F.lit(i).alias("_i"), F.col(s.rows.columns[1]).cast(kind).alias("_t")) for i, s in enumerate(sources)]
    return reduce(DataFrame.unionAll, parts)


def _tasks(facts: DataFrame) -> int:
    """Tasks of FACTS_IN_TASK facts each; left to itself Spark merges small rows into tasks that grow with the table."""
    return 1 + facts.count() // FACTS_IN_TASK


def _one_each(sources: list[Evidence], kind, tasks: int) -> DataFrame:
    """_u, _t0, _t1, ...: a row a uid, with the target that each source gives it or null."""
    own = lambda i: F.when(F.col("_i") == i, F.col("_t"))
    sides = [f(own(i)).alias(f"{name}{i}") for i in range(len(sources)) for f, name in ((F.min, "_t"), (F.max, "_m"))]
    rows = _together(sources, kind).where("_t is not null").repartition(tasks, "_u").groupBy("_u").agg(*sides)
    several = lambda s: F.raise_error(F.concat(F.lit(f"{s.method} gives two targets for "), F.col("_u").cast("string"))).cast(kind)
    return rows.select("_u", *(F.when(F.col(f"_t{i}").isNull() | (F.col(f"_t{i}") == F.col(f"_m{i}")), F.col(f"_t{i}")).otherwise(several(s)).alias(f"_t{i}") for i, s in enumerate(sources)))


def conflicts(facts: DataFrame, uid: str, sources: list[Evidence]) -> DataFrame:
    """Facts to which several sources give different targets: uid, n_targets, methods (in order of precedence)."""
    rows = _together(sources, sources[0].rows.schema[1].dataType).withColumnRenamed("_u", uid)
    tasks = _tasks(facts)
    rows = rows.repartition(tasks, uid).join(facts.select(uid).repartition(tasks, uid), uid, "left_semi")
    # Sources as flags and targets as rows: both aggregations keep plain numbers, and the second needs no other deal.
    flags = [f"_s{i}" for i in range(len(sources))]
    each = rows.groupBy(uid, "_t").agg(*(F.bool_or(F.col("_i") == i).alias(f) for i, f in enumerate(flags)))
    found = each.groupBy(uid).agg(F.count("_t").alias("n_targets"), *(F.bool_or(f).alias(f) for f in flags)).where("n_targets > 1")
    methods = F.concat_ws("|", *(F.when(F.col(f), F.lit(s.method)) for f, s in zip(flags, sources, strict=True)))
    return found.select(uid, "n_targets", methods.alias("methods"))
