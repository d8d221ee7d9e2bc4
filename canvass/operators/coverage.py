"""Coverages: polygons that share edges.  Dissolve by cancelling edges, simplify by shared arcs.

A polygon is rows of vertices or an array of (x, y) structs, its interior on the left of every edge (outer rings
counter-clockwise, holes clockwise), the first point not repeated.  Neighbours share their edges exactly.
Nothing gathers a coverage or a ring to work on it: edges are rows, and order along a ring comes from pointer
doubling, in a number of rounds logarithmic in the longest ring.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..storage import discard, saved
from .contracts import ContractError, require_empty
from .skew import spread_join

ENDS = ["x1", "y1", "x2", "y2"]


def sides(polygons: DataFrame, keys: list[str], ring: str) -> DataFrame:
    """keys, place, x, y, x2, y2: every point of the array column ``ring`` and the one after it, around the ring."""
    r = F.col(ring)
    n = F.size(r)
    after = lambda i: F.element_at(r, F.when(i == n - 1, 1).otherwise(i + 2))
    pairs = F.transform(r, lambda p, i: F.struct(p["x"].alias("x"), p["y"].alias("y"), after(i)["x"].alias("x2"), after(i)["y"].alias("y2")))
    return polygons.select(*keys, F.posexplode(pairs).alias("place", "s")).select(*keys, "place", "s.*")


def _long() -> Column:
    return (F.col("x1") != F.col("x2")) | (F.col("y1") != F.col("y2"))


def edges(polygons: DataFrame, keys: list[str], ring: str) -> DataFrame:
    """keys, x1, y1, x2, y2: the directed edges of the array column ``ring``; edges without length are left out."""
    return sides(polygons, keys, ring).select(*keys, F.col("x").alias("x1"), F.col("y").alias("y1"), "x2", "y2").where(_long())


def cross() -> Column:
    """Twice the signed area of the triangle of an edge and the origin."""
    return F.col("x1") * F.col("y2") - F.col("x2") * F.col("y1")


def boundary(parts: DataFrame, group: str) -> DataFrame:
    """group and the directed edges of each group's union: edges that two of its polygons share have cancelled.

    An edge that lies twice in one direction belongs to polygons that overlap; that fails.
    """
    a, b = (F.struct(F.col(x).alias("col1"), F.col(y).alias("col2")) for x, y in (("x1", "y1"), ("x2", "y2")))
    along = a < b
    low, high = F.when(along, a).otherwise(b), F.when(along, b).otherwise(a)
    kept = parts.groupBy(group, low.alias("low"), high.alias("high")).agg(F.sum(F.when(along, 1).otherwise(-1)).alias("turn")).where("turn <> 0")
    start, end = F.when(F.col("turn") > 0, F.col("low")).otherwise(F.col("high")), F.when(F.col("turn") > 0, F.col("high")).otherwise(F.col("low"))
    ways = kept.select(group, start.alias("a"), end.alias("b"), "turn")
    found = saved(ways.select(group, *(F.col("a").getField(f"col{i}").alias(c) for i, c in ((1, "x1"), (2, "y1"))), *(F.col("b").getField(f"col{i}").alias(c) for i, c in ((1, "x2"), (2, "y2"))), "turn"), "boundary")
    require_empty(found.where(F.abs("turn") > 1), "polygons of a coverage overlap")
    return found.drop("turn")


def followed(lines: DataFrame, group: str) -> DataFrame:
    """Saved ``lines`` (group, edge) with id and next: the edge that follows along the same interior.

    Around each vertex edges stand in order of angle; an edge that arrives goes on with the first one that leaves,
    clockwise from where it came, so polygons that meet in a point stay apart.  Ids ascend with (group, edge).
    """
    order = [group, *ENDS]
    numbered = saved(lines.repartitionByRange(*order).sortWithinPartitions(*order).select(*order, F.monotonically_increasing_id().alias("id")), "edges")
    turn = F.atan2(F.col("y2") - F.col("y1"), F.col("x2") - F.col("x1"))
    back = F.atan2(F.col("y1") - F.col("y2"), F.col("x1") - F.col("x2"))
    none = F.lit(None).cast("long")
    leaving = numbered.select(group, F.col("x1").alias("x"), F.col("y1").alias("y"), turn.alias("angle"), F.col("id").alias("out"), none.alias("id"))
    arriving = numbered.select(group, F.col("x2").alias("x"), F.col("y2").alias("y"), back.alias("angle"), none.alias("out"), "id")
    around = Window.partitionBy(group, "x", "y").orderBy(F.col("angle").desc(), "out", "id")
    after = F.first("out", ignorenulls=True).over(around.rowsBetween(1, Window.unboundedFollowing))
    first = F.first("out", ignorenulls=True).over(around.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    nexts = leaving.unionAll(arriving).withColumn("next", F.coalesce(after, first)).where(F.col("id").isNotNull()).select("id", "next")
    return saved(numbered.join(nexts, "id"), "followed")


def cycles(links: DataFrame, id_: str = "id", next_: str = "next", most_rounds: int = 64) -> DataFrame:
    """Saved (id, head, place, length) of links that form cycles: head is the smallest id, place counts from it.

    After k rounds each link knows the smallest id among the 2**k that begin with it, how far off that is, and the
    link 2**k on.  Rounds merge: a table whose file looks small enough to broadcast is many times larger when it is, every
    round anew.  A round in which nobody learns of a smaller one is the last: ceil(log2(longest)) + 1 rounds.
    """
    state = saved(links.select(F.col(id_).alias("id"), F.col("id").alias("head"), F.lit(0).cast("long").alias("off"), F.col(next_).alias("to")), "cycle")
    for k in range(most_rounds):
        on = state.select(F.col("id").alias("to"), F.col("head").alias("_head"), F.col("off").alias("_off"), F.col("to").alias("_to"))
        less = F.col("_head") < F.col("head")
        step = saved(state.join(on.hint("merge"), "to").select("id", F.least("head", "_head").alias("head"), F.when(less, F.col("_off") + (1 << k)).otherwise(F.col("off")).alias("off"), F.col("_to").alias("to"), less.alias("learned")), "cycle")
        discard(state)
        state = step.drop("learned")
        if not step.where("learned").limit(1).count():
            lengths = saved(step.groupBy("head").agg(F.count("*").alias("length")), "lengths")
            place = (F.col("length") - F.col("off")) % F.col("length")
            return saved(spread_join(step, lengths, "head", counted="length").select("id", "head", place.alias("place"), "length"), "cycles")
    raise ContractError("links do not form cycles")


def dissolved(parts: DataFrame, group: str) -> DataFrame:
    """Saved vertices (group, ring, place, length, x, y, x2, y2) of each group's union, from the edges of its polygons.

    ring names a ring by its smallest edge; places count from 0 along it, the interior on the left; an edge leads from
    (x, y) to (x2, y2).  Rings of a positive sum of :func:`cross` are outer ones, those of a negative sum holes.
    """
    lines = followed(boundary(parts, group), group)
    order = cycles(lines)
    found = lines.join(order, "id").select(group, F.col("head").alias("ring"), "place", "length", F.col("x1").alias("x"), F.col("y1").alias("y"), "x2", "y2")
    done = saved(found, "dissolved")
    discard(lines, order)
    return done


def ring_summary(rings: DataFrame, group: str) -> DataFrame:
    """group, ring, n_edges, area (negative for holes), first_x, first_y of each ring of :func:`dissolved`."""
    area = F.sum(F.col("x") * F.col("y2") - F.col("x2") * F.col("y")) / 2
    at_head = lambda c: F.max(F.when(F.col("place") == 0, F.col(c)))
    return rings.groupBy(group, "ring").agg(F.count("*").alias("n_edges"), area.alias("area"), at_head("x").alias("first_x"), at_head("y").alias("first_y"))


def lost_area(parts: DataFrame, rings: DataFrame, group: str) -> DataFrame:
    """group, before, after, lost: area of a group's polygons and of its union; a missing side counts as 0."""
    before = parts.groupBy(group).agg((F.sum(cross()) / 2).alias("before"))
    after = ring_summary(rings, group).groupBy(group).agg(F.sum("area").alias("after"))
    both = before.join(after, group, "full_outer").select(group, F.coalesce("before", F.lit(0.0)).alias("before"), F.coalesce("after", F.lit(0.0)).alias("after"))
    return both.withColumn("lost", F.abs(F.col("before") - F.col("after")))


def ring_arrays(rings: DataFrame, group: str) -> DataFrame:
    """group, ring, points: each ring as an array of (x, y), as a geometry is stored; a ring is one value."""
    points = F.transform(F.array_sort(F.collect_list(F.struct("place", "x", "y"))), lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y")))
    return rings.groupBy(group, "ring").agg(points.alias("points"))


def arcs(parts: DataFrame) -> DataFrame:
    """Saved (arc, place, x, y, x2, y2): the edges of a coverage in arcs, each shared edge once.

    An arc runs between vertices of other than two edges, or around a ring that has none, from its smallest vertex.
    Walking on at vertices of two edges and turning round at all others makes a cycle of each arc and its way back,
    so one doubling places them all; of the two ways the one with the smaller first edge stays.
    """
    back = parts.select(F.col("x2").alias("x1"), F.col("y2").alias("y1"), F.col("x1").alias("x2"), F.col("y1").alias("y2"))
    both = parts.select(*ENDS).unionAll(back).distinct()
    numbered = saved(both.repartitionByRange(*ENDS).sortWithinPartitions(*ENDS).select(*ENDS, F.monotonically_increasing_id().alias("id")), "halves")
    end = F.struct(F.col("x2").alias("x"), F.col("y2").alias("y"))
    ways = numbered.groupBy(F.col("x1").alias("x2"), F.col("y1").alias("y2")).agg(F.count("*").alias("n"), F.min(end).alias("_a"), F.max(end).alias("_b"))
    came = F.struct(F.col("x1").alias("x"), F.col("y1").alias("y"))
    onward = F.when((F.col("n") == 2) & (F.col("_a") == came), F.col("_b")).when(F.col("n") == 2, F.col("_a")).otherwise(came)
    steps = numbered.join(ways, ["x2", "y2"]).select("id", F.col("x2").alias("x1"), F.col("y2").alias("y1"), onward["x"].alias("x2"), onward["y"].alias("y2"), (F.col("n") != 2).alias("turned"))
    links = saved(steps.join(numbered.withColumnRenamed("id", "next"), ENDS).select("id", "next", "turned"), "ways")
    around = cycles(links)
    begins = around.join(links.where("turned").select(F.col("next").alias("id")), "id").groupBy("head").agg(F.min(F.struct("id", "place")).alias("s"), F.max("length").alias("length"))
    begins = saved(begins.select("head", F.col("s.place").alias("_from"), (F.col("length") / 2).cast("long").alias("_n"), "length"), "begins")
    rings = around.where("place = 0").join(begins.select("head"), "head", "left_anti").join(numbered, "id")
    rings = rings.groupBy("x1", "y1").agg(F.min(F.struct("head", "length")).alias("s")).select("s.head", F.lit(0).cast("long").alias("_from"), F.col("s.length").alias("_n"), "s.length")
    kept = saved(begins.unionByName(rings).withColumnRenamed("length", "_length"), "arcs")
    walked = saved(around.join(numbered, "id"), "walked")
    place = (F.col("place") - F.col("_from") + F.col("_length")) % F.col("_length")
    found = spread_join(walked, kept, "head", counted="_length").withColumn("place", place).where("place < _n")
    done = saved(found.select(F.col("head").alias("arc"), "place", F.col("x1").alias("x"), F.col("y1").alias("y"), "x2", "y2"), "arcs")
    discard(numbered, links, around, begins, walked)
    return done


def visvalingam(xs: list[float], ys: list[float], tolerance: float) -> list[bool]:
    """Which points of an open line stay: the point of the smallest triangle with its neighbours goes first, as long as
    that is under ``tolerance``; ties by place; ends stay."""
    n = len(xs)
    before, after = list(range(-1, n - 1)), list(range(1, n + 1))
    area = lambda i: abs((xs[before[i]] - xs[i]) * (ys[after[i]] - ys[i]) - (xs[after[i]] - xs[i]) * (ys[before[i]] - ys[i])) / 2
    kept, size = [True] * n, {i: area(i) for i in range(1, n - 1)}
    heap = [(a, i) for i, a in size.items()]
    heapq.heapify(heap)
    while heap:
        a, i = heapq.heappop(heap)
        if a >= tolerance:
            break
        if not kept[i] or size[i] != a:
            continue
        kept[i] = False
        b, c = before[i], after[i]
        after[b], before[c] = c, b
        for j in (b, c):
            if 0 < j < n - 1:
                size[j] = area(j)
                heapq.heappush(heap, (size[j], j))
    return kept


def _thinned(tolerance: float):
    """Points that stay, ends among them, from rows in order of arc and place; an arc may go on in the next batch."""

    def stay(xs: list[float], ys: list[float]) -> list[tuple[float, float]]:
        return [(x, y) for x, y, kept in zip(xs, ys, visvalingam(xs, ys, tolerance), strict=True) if kept]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        arc, xs, ys, end = None, [], [], ()
        for batch in batches:
            found = []
            for own, x, y, *on in zip(*(batch[c].tolist() for c in ("arc", "x", "y", "x2", "y2")), strict=True):
                if own != arc:
                    if xs:
                        found += stay([*xs, end[0]], [*ys, end[1]])
                    arc, xs, ys = own, [], []
                xs.append(x)
                ys.append(y)
                end = on
            yield pd.DataFrame(found, columns=["x", "y"], dtype="float64")
        if xs:
            yield pd.DataFrame(stay([*xs, end[0]], [*ys, end[1]]), columns=["x", "y"], dtype="float64")

    return run


def simplified(polygons: DataFrame, uid: str, ring: str, tolerance: float) -> DataFrame:
    """Saved (uid, place, x, y): the vertices of each polygon's ring that stay, the same ones on both sides of every edge.

    Each arc is thinned once (triangles under ``tolerance`` go, the smallest first), so neighbours still share all
    their edges: no gap or overlap arises between them.  A ring that would keep fewer than three vertices keeps all of
    its own, and its neighbours keep those too.  Arcs pass a task as a stream of rows; one of them, as long as a border
    between two polygons, is held at a time.
    """
    points = saved(sides(polygons, [uid], ring), "vertices")
    lines = arcs(points.select(F.col("x").alias("x1"), F.col("y").alias("y1"), "x2", "y2").where(_long()))
    along = lines.repartition("arc").sortWithinPartitions("arc", "place").select("arc", "x", "y", "x2", "y2")
    stay = saved(along.mapInPandas(_thinned(tolerance), "x double, y double").distinct(), "stay")
    held = points.join(stay, ["x", "y"], "left_semi")
    few = points.select(uid).distinct().join(held.groupBy(uid).agg(F.count("*").alias("n")), uid, "left").where(F.coalesce("n", F.lit(0)) < 3)
    more = points.join(few.select(uid), uid, "left_semi").select("x", "y")
    stay_all = saved(stay.unionByName(more).distinct(), "stay")
    done = saved(points.join(stay_all, ["x", "y"], "left_semi").select(uid, "place", "x", "y"), "simplified")
    discard(points, lines, stay)
    return done
