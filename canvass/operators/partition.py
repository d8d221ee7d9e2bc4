"""Unique exact partition: rows to areas so that every area's residual totals are met exactly."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STATES = 1_000_000


def solve(rows: list[tuple[int, ...]], areas: list[tuple[int, ...]], most_states: int = STATES) -> tuple[str, list[int] | None]:
    """('unique', area of each row), ('none' | 'several' | 'limit', None).

    rows: metric tuples; areas: the row count and the same metrics to be used up.  Rows go in order of size;
    what remains of the areas decides a state, and states that failed are not tried again.
    """
    order = sorted(range(len(rows)), key=lambda i: rows[i], reverse=True)
    if len(rows) != sum(a[0] for a in areas) or any(sum(r[k] for r in rows) != sum(a[k + 1] for a in areas) for k in range(len(areas[0]) - 1 if areas else 0)):
        return "none", None
    failed: set[tuple] = set()
    found: list[list[int]] = []
    left = [list(a) for a in areas]
    choice = [0] * len(rows)
    known = [0] * (len(rows) + 1)  # solutions found when a depth was entered
    states = 0
    stack = [(0, -1)]  # (depth, area tried last); an explicit stack, for rows may be many
    while stack:
        depth, tried = stack.pop()
        if tried >= 0:  # take back what this depth used
            row = rows[order[depth]]
            left[tried][0] += 1
            for k, v in enumerate(row):
                left[tried][k + 1] += v
        if depth == len(rows):
            found.append(choice.copy())
            if len(found) == 2:
                return "several", None
            continue
        state = (depth, *map(tuple, left))
        if tried < 0:
            states += 1
            if states > most_states:
                return "limit", None
            if state in failed:
                continue
            known[depth] = len(found)
        row = rows[order[depth]]
        for area in range(tried + 1, len(areas)):
            own = left[area]
            if own[0] < 1 or any(v > own[k + 1] for k, v in enumerate(row)):
                continue
            own[0] -= 1
            for k, v in enumerate(row):
                own[k + 1] -= v
            choice[order[depth]] = area
            stack.append((depth, area))
            stack.append((depth + 1, -1))
            break
        else:
            if len(found) == known[depth]:  # nothing came of it, whatever was found before
                failed.add(state)
    return ("unique", found[0]) if found else ("none", None)


def exact_partition(rows: DataFrame, areas: DataFrame, group: str, uid: str, area: str, metrics: list[str], most_states: int = STATES) -> DataFrame:
    """group, uid, area, outcome: each group's rows assigned if there is exactly one solution, else area null.

    Groups are localities: small, and independent of each other, so each becomes one row of arrays and a
    batch of them is solved in one call.  A search beyond ``most_states`` ends as 'limit', never as a guess;
    rows without a group, or whose group has no areas, as 'none'.
    """
    number = [F.col(m).cast("long").alias(m) for m in metrics]
    own = rows.groupBy(group).agg(F.array_sort(F.collect_list(F.struct(F.col(uid).cast("long").alias("uid"), *number))).alias("own"))
    goals = areas.groupBy(group).agg(F.array_sort(F.collect_list(F.struct(F.col(area).cast("long").alias("area"), F.col("n").cast("long").alias("n"), *number))).alias("goals"))
    kind = rows.schema[group].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, uids, found, outcomes = [], [], [], []
            for place, (mine, theirs) in enumerate(zip(batch.column("own").to_pylist(), batch.column("goals").to_pylist(), strict=True)):
                theirs = theirs or []
                outcome, chosen = solve([tuple(r[m] for m in metrics) for r in mine], [(r["n"], *(r[m] for m in metrics)) for r in theirs], most_states)
                keys += [place] * len(mine)
                uids += [r["uid"] for r in mine]
                found += [None] * len(mine) if chosen is None else [theirs[k]["area"] for k in chosen]
                outcomes += [outcome] * len(mine)
            yield pa.RecordBatch.from_arrays([batch.column(group).take(pa.array(keys, pa.int64())), pa.array(uids, pa.int64()), pa.array(found, pa.int64()), pa.array(outcomes, pa.string())], names=[group, "uid", "area", "outcome"])

    return own.join(goals, group, "left").mapInArrow(run, f"`{group}` {kind}, uid long, area long, outcome string")
