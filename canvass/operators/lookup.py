"""Lookups with fallbacks and guards.

Rule tables are small, facts are not: Spark broadcasts a rule table when its size allows and shuffles
otherwise, so no hint is given here.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..storage import saved
from .contracts import require_empty
from .ranking import keep_first


def unique_index(df: DataFrame, key: str, target: str) -> DataFrame:
    """key -> target where the key has one distinct target; ambiguous and null keys are dropped."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(target).alias(target), F.max(target).alias("_max")).where(F.col(target) == F.col("_max")).drop("_max")


def singleton_index(df: DataFrame, key: str, target: str) -> DataFrame:
    """key -> target for keys that a single row has."""
    return df.groupBy(key).agg(F.count("*").alias("_n"), F.min(target).alias(target)).where("_n = 1").drop("_n")


def first_index(df: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """The row declared first for each key; give a descending order for 'last wins'."""
    return keep_first(df, [key], order)


def first_hit(facts: DataFrame, steps: list[tuple[str, DataFrame, str, str]], target: str) -> DataFrame:
    """facts with ``target`` and ``lookup``: the first of the steps (name, index, fact key, target column) that has the key."""
    found: list[Column] = []
    out = facts
    for i, (_, index, key, column) in enumerate(steps):
        side = index.select(F.col(index.columns[0]).alias(f"_k{i}"), F.col(column).alias(f"_t{i}"))
        out = out.join(side, out[key] == side[f"_k{i}"], "left")
        found.append(F.col(f"_t{i}"))
    lookup = reduce(lambda rest, i: F.when(found[i].isNotNull(), steps[i][0]).otherwise(rest), range(len(steps) - 1, -1, -1), F.lit(None).cast("string"))
    return out.withColumns({target: F.coalesce(*found), "lookup": lookup}).drop(*[f"_{x}{i}" for i in range(len(steps)) for x in "kt"])


def probe(facts: DataFrame, candidates: Column, index: DataFrame, key: str, target: str, uid: str) -> DataFrame:
    """uid, target, place: the first of each fact's candidate keys that the index holds; facts without a hit have null."""
    tried = facts.select(uid, F.posexplode_outer(candidates).alias("place", "_key"))
    hits = tried.join(index.select(F.col(key).alias("_key"), target), "_key")
    best = keep_first(hits, [uid], [F.col("place")]).select(uid, target, "place")
    return facts.select(uid).join(best, uid, "left")


def range_rules(facts: DataFrame, rules: DataFrame, keys: list[str], value: str, low: str, high: str) -> DataFrame:
    """Facts joined to the rules of their keys whose range holds the value."""
    return facts.join(rules, keys).where(F.col(value).between(F.col(low), F.col(high)))


def range_lookup(facts: DataFrame, uid: str, value: str, rules: DataFrame, keys: list[str], low: str, high: str, target: str) -> DataFrame:
    """``facts`` with ``target`` of the one rule of their keys whose range of whole numbers holds the value; null without one.

    A rule stands in the grid whose cells, a power of two wide, are no smaller than its range: in two cells at most.  A fact looks
    into its cell of every grid that has rules (64 at most), so a key with a million rules costs a fact no more than one with
    three, as long as ranges of a key do not overlap.  A fact that two rules hold fails the job, as does a repeated uid.
    """
    wide = F.col("_high") - F.col("_low")
    ranges = rules.select(*keys, F.col(low).cast("long").alias("_low"), F.col(high).cast("long").alias("_high"), F.col(target).alias("_target")).where("_low <= _high")
    ranges = saved(ranges.withColumn("_grid", F.when(wide == 0, 0).otherwise(F.length(F.bin(wide)))), "ranges")
    grids = sorted(r["_grid"] for r in ranges.select("_grid").distinct().collect())
    if not grids:
        return facts.withColumn(target, F.lit(None).cast(rules.schema[target].dataType))
    shift = lambda v, by: F.expr(f"shiftright({v}, {by})")
    placed = ranges.withColumn("_cell", F.explode(F.sequence(shift("_low", "_grid"), shift("_high", "_grid"))))
    asked = facts.select(F.col(uid).alias("_uid"), *keys, F.col(value).cast("long").alias("_value")).withColumn("_grid", F.explode(F.array(*map(F.lit, grids)))).withColumn("_cell", shift("_value", "_grid"))
    hits = saved(asked.join(placed, [*keys, "_grid", "_cell"]).where("_value between _low and _high").select("_uid", "_target"), "hits")
    require_empty(hits.groupBy("_uid").agg(F.count("*").alias("n"), F.min("_target").alias("one"), F.max("_target").alias("other")).where("n > 1"), "more than one rule holds a value")
    return facts.join(hits, facts[uid] == hits["_uid"], "left").select(*facts.columns, F.col("_target").alias(target))


def overlaps(rules: DataFrame, keys: list[str], low: str, high: str) -> DataFrame:
    """Rules that begin before an earlier rule of their keys has ended; ``before`` is how far that one reaches.

    A running maximum finds them without joining the rules to themselves.
    """
    earlier = Window.partitionBy(*keys).orderBy(low, high).rowsBetween(Window.unboundedPreceding, -1)
    return rules.withColumn("before", F.max(high).over(earlier)).where(F.col("before") >= F.col(low))


def resolve_alias(df: DataFrame, column: str, aliases: DataFrame, source: str, canonical: str) -> DataFrame:
    """``column`` by its canonical id; ids without an alias stay."""
    side = aliases.select(F.col(source).alias("_from"), F.col(canonical).alias("_to"))
    return df.join(side, df[column] == side["_from"], "left").withColumn(column, F.coalesce("_to", column)).drop("_from", "_to")


def preferred(df: DataFrame, key: str, target: str, flag: Column) -> DataFrame:
    """key, target, reason: the only flagged candidate, else the only candidate; else null and why."""
    counts = df.groupBy(key).agg(F.count_if(flag).alias("_flagged"), F.count("*").alias("_all"), F.min(F.when(flag, F.col(target))).alias("_one"), F.min(target).alias("_any"))
    chosen = F.when(F.col("_flagged") == 1, F.col("_one")).when((F.col("_flagged") == 0) & (F.col("_all") == 1), F.col("_any"))
    reason = F.when(F.col("_flagged") == 1, "flagged").when((F.col("_flagged") == 0) & (F.col("_all") == 1), "only").otherwise("ambiguous")
    return counts.select(key, chosen.alias(target), reason.alias("reason"))


def indicated_join(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Full outer join with ``side``: both, left_only or right_only."""
    joined = left.withColumn("_l", F.lit(1)).join(right.withColumn("_r", F.lit(1)), keys, "full_outer")
    side = F.when(F.col("_r").isNull(), "left_only").when(F.col("_l").isNull(), "right_only").otherwise("both")
    return joined.withColumn("side", side).drop("_l", "_r")


def crosswalk(facts: DataFrame, rules: DataFrame, code: str, name: str, target: str, order: str) -> DataFrame:
    """facts with ``target`` and ``matched``: by (code, name), where the last rule wins, else by name among the
    rules without a code, where the first wins."""
    coded = first_index(rules.where(F.col(code).isNotNull()).withColumn("_key", F.struct(code, name)), "_key", [F.col(order).desc()])
    named = first_index(rules.where(F.col(code).isNull()), name, [F.col(order).asc()])
    out = facts.join(coded.select(F.col(code).alias("_c"), F.col(name).alias("_n"), F.col(target).alias("_t1")), (facts[code] == F.col("_c")) & (facts[name] == F.col("_n")), "left")
    out = out.join(named.select(F.col(name).alias("_m"), F.col(target).alias("_t2")), facts[name] == F.col("_m"), "left")
    matched = F.when(F.col("_t1").isNotNull(), "code_and_name").when(F.col("_t2").isNotNull(), "name")
    return out.select(*facts.columns, F.coalesce("_t1", "_t2").alias(target), matched.alias("matched"))


def follow_aliases(aliases: DataFrame, source: str, target: str, most_rounds: int = 32) -> DataFrame:
    """source -> the end of its chain of aliases.

    Each round doubles the length of chain that is followed; an end that is still an alias after
    ``most_rounds`` doublings lies on a cycle and fails the job.
    """
    ends = saved(aliases.select(F.col(source).alias("s"), F.col(target).alias("t")), "aliases")
    for _ in range(most_rounds):
        on = ends.select(F.col("s").alias("_s"), F.col("t").alias("_t"))
        step = saved(ends.join(on, ends["t"] == on["_s"], "left").select("s", F.coalesce("_t", "t").alias("t"), F.col("_t").isNotNull().alias("moved")), "aliases")
        moved = step.where("moved").limit(1).count()
        ends = step.select("s", "t")
        if not moved:
            return ends.select(F.col("s").alias(source), F.col("t").alias(target))
    require_empty(ends.join(aliases.select(F.col(source).alias("t")), "t", "left_semi"), "aliases run in a circle")
    return ends.select(F.col("s").alias(source), F.col("t").alias(target))


def host_members(rules: DataFrame, host: str, members: str) -> DataFrame:
    """host, member, place and conflict from pipe-joined member lists: a member of two hosts, or a host that is
    another's member, is in conflict."""
    from ..functions.normalize import pipe_list

    rows = rules.select(host, F.posexplode(pipe_list(F.col(members))).alias("place", "member"))
    times = rows.groupBy("member").agg(F.countDistinct(host).alias("_hosts"))
    hosts = rules.select(F.col(host).cast("string").alias("_host")).distinct()
    joined = rows.join(times, "member").join(hosts, (F.col("member") == F.col("_host")) & (F.col("member") != F.col(host).cast("string")), "left")
    return joined.select(host, "member", "place", ((F.col("_hosts") > 1) | F.col("_host").isNotNull()).alias("conflict"))


def composite_faults(results: DataFrame, locality: str, composites: DataFrame) -> DataFrame:
    """composite, host, fault for what keeps ``composites`` (composite, host, components array) from standing for their hosts.

    invalid: blank, or the host is none of its components; host_twice: its host has another composite; no_host_result: no
    result for the host; hides_result: another component has a result of its own, which the composite would hide.
    """
    known = results.select(F.col(locality).alias("_known")).distinct()
    rows = composites.withColumn("_valid", F.coalesce(F.array_contains("components", F.col("host")) & F.col("composite").isNotNull(), F.lit(False)))
    times = composites.groupBy("host").agg(F.count("*").alias("_times"))
    hosts = rows.join(times, "host", "left").join(known, F.col("host") == F.col("_known"), "left")
    fault = lambda name: F.lit(name).alias("fault")
    found = [
        hosts.where("not _valid").select("composite", "host", fault("invalid")),
        hosts.where("_times > 1").select("composite", "host", fault("host_twice")),
        hosts.where("_known is null").select("composite", "host", fault("no_host_result")),
        rows.select("composite", "host", F.explode("components").alias("_part")).where("_part <> host").join(known, F.col("_part") == F.col("_known"), "left_semi").select("composite", "host", fault("hides_result")).distinct(),
    ]
    return reduce(DataFrame.unionByName, found)


def under_composites(results: DataFrame, locality: str, composites: DataFrame) -> DataFrame:
    """``results`` with a host's locality replaced by its composite; any fault of :func:`composite_faults`, or a locality
    that is blank or stands twice, fails the job."""
    require_empty(results.groupBy(locality).agg(F.count("*").alias("n")).where(f"n > 1 or `{locality}` is null"), "missing or repeated locality")
    require_empty(composite_faults(results, locality, composites), "composites are at fault")
    hosts = composites.select(F.col("host").alias("_host"), F.col("composite").alias("_composite"))
    joined = results.join(hosts, results[locality] == hosts["_host"], "left").withColumn(locality, F.coalesce("_composite", locality))
    return joined.select(*results.columns)
