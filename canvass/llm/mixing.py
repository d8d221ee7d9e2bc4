"""Operator 1: mixing sources to target weights by the cube method.

A source's target over its size is how often each of its documents is wanted: a whole part, taken as it is,
and a fraction, the inclusion probability of one more copy.  The cube method moves those probabilities along
the null space of the balancing constraints (number of documents, number of words) until all but a few are 0
or 1.  The flight runs in blocks of ``block`` units; what each block leaves undecided (two units at most)
meets in new blocks, level by level, until each source has one block left, whose landing draws the outcome of
the two open units: of all draws that keep both inclusion probabilities the one that misses least in words.  No
task ever holds more than a block.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


from ..storage import saved

WEIGHTS = (1.0, 2.0, 3.0)
MOST_COPIES = 3.0
BLOCK = 2048
SPREAD = 256  # large units of a block that are decided one by one
_TINY = 1e-9


def words_in(text: Column) -> Column:
    """Number of [^\\x20\\x09-\\x0D]+ in a text; 0 for null.

    Every word is cut to one mark and the marks are counted, which needs no array of the words.
    """
    marks = F.regexp_replace(F.translate(text, " \t\n\x0b\x0c\r", "      "), "[^ ]+", "w")
    return F.coalesce(F.length(marks) - F.length(F.replace(marks, F.lit("w"), F.lit(""))), F.lit(0)).cast("long")


def source_targets(sized: DataFrame, weights: tuple[float, ...] = WEIGHTS, most_copies: float = MOST_COPIES) -> DataFrame:
    """source, source_size, target: sources in code point order (null last) get the weights in turn.

    The targets add up to the sum of all sizes; one above ``most_copies`` times its source's size stops
    there, and the excess is shared anew by weight among the rest until none is above.  Each round is one
    aggregation of the table of sources.
    """
    spark = sized.sparkSession
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size")).orderBy(F.col("source").asc_nulls_last())
    kind = sized.schema["source"].dataType.simpleString()
    ranked = spark.createDataFrame(totals.rdd.zipWithIndex().map(lambda x: (*x[0], x[1])), f"source {kind}, source_size long, place long")
    share = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    table = saved(ranked.withColumn("weight", share).withColumn("limit", F.col("source_size") * float(most_copies)), "sources")
    whole = float(table.agg(F.coalesce(F.sum("source_size"), F.lit(0)).alias("n")).first()["n"])
    level = 0.0  # words for each unit of weight; a source is full where level * weight reaches its limit
    while True:
        full = F.col("weight") * level >= F.col("limit")
        sums = table.agg(F.sum(F.when(full, F.col("limit"))).alias("held"), F.sum(F.when(~full, F.col("weight"))).alias("open")).first()
        if not sums["open"] or not whole:
            break
        higher = (whole - (sums["held"] or 0.0)) / sums["open"]
        if higher <= level * (1 + 1e-12):
            break
        level = higher
    return table.select("source", "source_size", F.least(F.col("limit"), F.col("weight") * F.lit(level)).alias("target"))


def _rng(*key: object) -> np.random.Generator:
    return np.random.default_rng(int.from_bytes(hashlib.blake2b(repr(key).encode(), digest_size=8).digest(), "big"))


def _spread(pi: np.ndarray, x: np.ndarray, unit: int, rng: np.random.Generator) -> None:
    """Decide ``unit`` while all open units behind it move a little the other way, so that sums of pi * x stay."""
    while 0 < pi[unit] < 1:
        rest = unit + 1 + np.flatnonzero((pi[unit + 1 :] > 0) & (pi[unit + 1 :] < 1))
        if len(rest) < 2:
            return
        room = pi[rest] * (1 - pi[rest])
        own = x[rest]
        u = -room * (own @ (np.linalg.pinv((own.T * room) @ own, rcond=1e-9, hermitian=True) @ x[unit]))
        if np.abs(u @ own + x[unit]).max() > 1e-9 * np.abs(x[unit]).max():
            return  # what is left cannot make up for it in both sums
        moved, d = np.concatenate([[unit], rest]), np.concatenate([[1.0], u])
        with np.errstate(divide="ignore", invalid="ignore"):
            up = np.where(d > 0, (1 - pi[moved]) / d, np.where(d < 0, pi[moved] / -d, np.inf)).min()
            down = np.where(d > 0, pi[moved] / d, np.where(d < 0, (1 - pi[moved]) / -d, np.inf)).min()
        pi[moved] += (up if rng.random() * (up + down) < down else -down) * d
        pi[moved] = np.where(pi[moved] < _TINY, 0.0, np.where(pi[moved] > 1 - _TINY, 1.0, pi[moved]))


def flight(pi: np.ndarray, x: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Move ``pi`` along null-space directions of the constraints ``x`` (units x 2) until under 3 units are open.

    Sums of pi * x stay as they are, and the expectation of each unit's outcome is its probability.  Units come
    largest first.  The first ``SPREAD`` are decided one after another, all units behind each moving a little;
    small units among themselves would hardly move a large one, which then stayed open to the end.  The rest go
    three at a time.
    """
    pi = pi.copy()
    pi[(pi < _TINY) | (pi > 1 - _TINY)] = pi[(pi < _TINY) | (pi > 1 - _TINY)].round()
    for unit in range(min(SPREAD, len(pi))):
        _spread(pi, x, unit, rng)
    window: list[int] = []
    for unit in range(len(pi)):
        if not _TINY < pi[unit] < 1 - _TINY:
            pi[unit] = round(pi[unit])
            continue
        window.append(unit)
        if len(window) < 3:
            continue
        (a0, a1), (b0, b1), (c0, c1) = x[window[0]], x[window[1]], x[window[2]]
        u = (b0 * c1 - b1 * c0, c0 * a1 - c1 * a0, a0 * b1 - a1 * b0)  # at right angles to both columns
        if max(map(abs, u)) < 1e-9 * max(a0 * a0 + a1 * a1, b0 * b0 + b1 * b1, c0 * c0 + c1 * c1):
            # All three are parallel, each some times the same document: what one gains another loses in proportion.
            u = (b0 + b1, -(a0 + a1), 0.0)
        up = min(((1 - pi[k]) / d if d > 0 else pi[k] / -d) for k, d in zip(window, u, strict=True) if d)
        down = min((pi[k] / d if d > 0 else (1 - pi[k]) / -d) for k, d in zip(window, u, strict=True) if d)
        step = up if rng.random() * (up + down) < down else -down
        for k, d in zip(window, u, strict=True):
            pi[k] += step * d
            if pi[k] < _TINY or pi[k] > 1 - _TINY:
                pi[k] = round(pi[k])
        window = [k for k in window if 0 < pi[k] < 1]
    return pi


def landing(pi: np.ndarray, x: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Decide the last open units (two at most) so that each is taken with its probability.

    Two units have four outcomes; keeping both probabilities leaves one number free, how often both are taken.  The
    expected miss in words (second column of x) is linear in it, so the least lies at an end of its range.
    """
    pi = pi.copy()
    left = [int(k) for k in np.flatnonzero((pi > 0) & (pi < 1))]
    if len(left) == 2:
        (p, q), (v, w) = pi[left], x[left, 1]
        miss = lambda one, other: abs((one - p) * v + (other - q) * w)
        slope = miss(1, 1) + miss(0, 0) - miss(1, 0) - miss(0, 1)
        both = max(0.0, p + q - 1) if slope >= 0 else min(p, q)
        pi[left] = ((1, 1), (1, 0), (0, 1), (0, 0))[int(np.searchsorted(np.cumsum([both, p - both, q - both]), rng.random(), "right"))]
    elif left:
        pi[left] = float(rng.random() < pi[left[0]])
    return pi.round()


def _fly(seed: int, level: int, last: bool, block: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        # Large units first: those left open at the end are small, and so is what the landing costs.
        group = group.sort_values(["words", "key"], ascending=[False, True], kind="stable").reset_index(drop=True)
        x = group[["rows", "words"]].to_numpy(float)
        x = x / np.maximum(np.abs(x).max(0), 1e-12)
        key = (seed, level, int(group["source_key"].iloc[0]), int(group["block"].iloc[0]))
        pi = group["pi"].to_numpy(float)
        rng = _rng(*key)
        pi = flight(pi, x, rng)
        # A source that fits in one block has nothing to wait for and lands at once.
        group["pi"] = landing(pi, x, rng) if last or group["units"].iloc[0] <= block else pi
        return group

    return run


def _flown(units: DataFrame, seed: int, level: int, last: bool, block: int) -> DataFrame:
    return units.groupBy("source", "block").applyInPandas(_fly(seed, level, last, block), units.schema)


def decisions(sized: DataFrame, *, weights: tuple[float, ...] = WEIGHTS, most_copies: float = MOST_COPIES, block: int = BLOCK, seed: int = 20240607) -> DataFrame:
    """doc_id, source, size, source_size, target, copies: a row for each distinct (doc_id, source, size).

    ``sized`` has these three columns.  Rows that agree in all three are one unit and are taken equally
    often.  Empty sources have target 0; documents without words have copies but add nothing.  Null ids and
    a null source are values like others; no rows give no rows.  The result depends on the rows and the seed
    alone, not on their order or partitions.
    """
    units = sized.groupBy("doc_id", "source", "size").agg(F.count("*").alias("rows"))
    targets = source_targets(sized, weights, most_copies)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    counts = units.groupBy("source").agg(F.count("*").alias("units"))
    plan = targets.withColumn("rate", rate).join(counts.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    plan = plan.withColumnsRenamed({"source": "_s"})
    key = F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "size")
    units = units.join(plan, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    units = units.withColumns({
        "words": F.col("size") * F.col("rows"),
        "source_key": F.xxhash64(F.col("source").cast("string")),  # for the draws; groups go by the source itself
        "key": key,
        "whole": F.floor("rate").cast("long"),
        "pi": F.col("rate") - F.floor("rate"),
    })
    # Blocks of a source are dealt by a hash of the unit, so a source of any size becomes blocks of about ``block``.
    blocks = F.ceil(F.col("units") / block)
    state = saved(_flown(units.withColumn("block", F.pmod(F.xxhash64("key", F.lit(seed)), blocks)), seed, 0, False, block), "flight")
    decided = [state.where(_settled())]
    level, most = 1, -(-(plan.agg(F.max("units").alias("n")).first()["n"] or 0) // block)
    while True:
        open_units = state.where(~_settled())
        most = -(-2 * most // block) if most > 1 else 1
        last = most == 1
        dealt = open_units.withColumn("block", F.lit(0).cast("long") if last else F.pmod(F.xxhash64("block", F.lit(seed + level)), F.lit(most)))
        state = saved(_flown(dealt, seed, level, last, block), "flight")
        decided.append(state if last else state.where(_settled()))
        if last:
            break
        level += 1
    done = reduce(DataFrame.unionAll, decided)
    return done.select("doc_id", "source", "size", "source_size", "target", "rows", (F.col("whole") + F.col("pi").cast("long")).alias("copies"))


def _settled() -> Column:
    return (F.col("pi") == 0) | (F.col("pi") == 1)


def report(documents: DataFrame) -> DataFrame:
    """The contract's rows; repeated rows of a document each get one."""
    sized = saved(documents.select("doc_id", "source", words_in(F.col("text")).alias("size")), "sizes")
    found = decisions(sized)
    found = found.withColumn("_row", F.explode(F.sequence(F.lit(1).cast("long"), "rows")))
    return found.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "source", "copies")


def mixed(documents: DataFrame) -> DataFrame:
    """The rows of ``documents``, each as often as the mix takes it, with copy (1, 2, ...) as a last column.

    Null texts and ids and a null source are values like others, repeated rows are taken equally often, no rows
    give no rows.  A column that is already called copy keeps its name; ours then begins with an underscore.
    Texts are shuffled once, to meet the decisions.
    """
    names = [f"c{i}" for i in range(len(documents.columns))]
    doc_id, source, text = (names[documents.columns.index(c)] for c in ("doc_id", "source", "text"))
    own = documents.toDF(*names).withColumn("words", words_in(F.col(text)))
    found = decisions(saved(own.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), F.col("words").alias("size")), "sizes"))
    chosen = found.where("copies > 0").select("doc_id", "source", "size", "copies")
    rows = own.join(chosen, F.col(doc_id).eqNullSafe(F.col("doc_id")) & F.col(source).eqNullSafe(F.col("source")) & (F.col("words") == F.col("size")))
    copy = "copy"
    while copy in documents.columns:
        copy = f"_{copy}"
    return rows.select(*names, F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy")).toDF(*documents.columns, copy)
