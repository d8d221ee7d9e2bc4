"""Geometry on coordinates: bounds, markers, and a grid join in place of a spatial index."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..storage import discard, saved
from .skew import spread_join

BUNDLE = 256  # ids in a row of copies
PAIRS_IN_TASK = 8_000_000
POINT_LIKE = 12  # vertices up to which a polygon is drawn as a marker


def cells(box: Column, size: Column) -> Column:
    """The grid cells (struct x, y) of edge ``size`` that a box touches."""
    at = lambda v: F.floor(v / size).cast("long")
    xs, ys = F.sequence(at(box["min_x"]), at(box["max_x"])), F.sequence(at(box["min_y"]), at(box["max_y"]))
    return F.flatten(F.transform(xs, lambda x: F.transform(ys, lambda y: F.struct(x.alias("x"), y.alias("y")))))


def bundled(rows: DataFrame, uid: str, keys: list[str]) -> DataFrame:
    """Saved (keys, ids, bundle): rows equal in all ``keys`` as one, their ids in arrays of about BUNDLE, so that copies are compared once."""
    named = saved(rows.select(F.struct(*keys).alias("_k"), F.col(uid).alias("_id")), "keyed")
    kinds = saved(named.groupBy("_k").agg(F.count("*").alias("_n")), "kinds")
    if kinds.count() == named.count():
        found = named.select("_k.*", F.array("_id").alias("ids"))
    else:
        dealt = spread_join(named, kinds, "_k", counted="_n").withColumn("_deal", F.pmod(F.xxhash64("_id"), F.ceil(F.col("_n") / BUNDLE)))
        found = dealt.groupBy("_k", "_deal").agg(F.collect_list("_id").alias("ids")).select("_k.*", "ids")
    done = saved(found.withColumn("bundle", F.monotonically_increasing_id()), "bundles")
    discard(named, kinds)
    return done


def meeting(bundles: DataFrame, box: str, size: float) -> DataFrame:
    """a, b, ids_a, ids_b: pairs of bundles whose boxes overlap in more than an edge, once in one order; a bundle of several meets itself.

    Grids of doubling edges: a box stands in the grid whose cells are no smaller than it, in four cells at
    most, and looks up from there through the larger ones, so a huge box costs no more rows than a small one.
    A pair meets in the grid of its larger box and counts in the cell that holds the lower corner of its
    intersection, so it comes once without a distinct.
    """
    named = bundles.select(F.col("bundle").alias("id"), F.col(box).alias("box"), "ids")
    extent = F.greatest(F.col("box.max_x") - F.col("box.min_x"), F.col("box.max_y") - F.col("box.min_y"), F.lit(float(size)))
    named = named.withColumn("level", F.ceil(F.log2(extent / F.lit(float(size)))).cast("int"))
    top = named.agg(F.coalesce(F.max("level"), F.lit(0)).alias("top")).first()["top"]
    edge = F.lit(float(size)) * F.pow(F.lit(2.0), F.col("grid"))
    own = named.withColumn("grid", F.col("level")).withColumn("cell", F.explode(cells(F.col("box"), edge)))
    climbing = named.withColumn("grid", F.explode(F.sequence("level", F.lit(top)))).withColumn("cell", F.explode(cells(F.col("box"), edge)))
    a = own.select("grid", "cell", F.col("id").alias("a"), F.col("box").alias("p"), F.col("ids").alias("ids_a"))
    b = climbing.select("grid", "cell", F.col("id").alias("b"), F.col("box").alias("q"), F.col("level").alias("below"), F.col("ids").alias("ids_b"))
    low_x, low_y = F.greatest("p.min_x", "q.min_x"), F.greatest("p.min_y", "q.min_y")
    pairs = a.join(b, ["grid", "cell"]).where((F.col("below") < F.col("grid")) | (F.col("a") < F.col("b")) | ((F.col("a") == F.col("b")) & (F.size("ids_a") > 1)))
    pairs = pairs.where((low_x < F.least("p.max_x", "q.max_x")) & (low_y < F.least("p.max_y", "q.max_y")))
    pairs = pairs.where((F.col("cell.x") == F.floor(low_x / edge)) & (F.col("cell.y") == F.floor(low_y / edge)))
    return pairs.select("a", "b", "ids_a", "ids_b")


def tasks_for(pairs: DataFrame) -> int:
    """Tasks among which the pairs of ids of saved ``pairs`` of bundles should be dealt, PAIRS_IN_TASK each."""
    total = pairs.agg(F.sum(F.size("ids_a").cast("long") * F.size("ids_b")).alias("n")).first()["n"]
    return 1 + (total or 0) // PAIRS_IN_TASK


def unbundled(pairs: DataFrame, *more: str, sides: tuple[str, ...] = ()) -> DataFrame:
    """a, b, more, sides: the pairs a < b of ids in pairs of bundles; a column of ``sides`` stands on each side, as <name>_a and <name>_b."""
    both = [f"{c}_{s}" for c in sides for s in "ab"]
    rows = pairs.select(F.col("a").alias("_p"), F.col("b").alias("_q"), *more, *both, "ids_b", F.explode("ids_a").alias("_a"))
    rows = rows.select("_p", "_q", *more, *both, "_a", F.explode("ids_b").alias("_b")).where("_p <> _q or _a < _b")
    turned = F.col("_a") > F.col("_b")
    swapped = [F.when(turned, F.col(f"{c}_{t}")).otherwise(F.col(f"{c}_{s}")).alias(f"{c}_{s}") for c in sides for s, t in ("ab", "ba")]
    return rows.select(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b"), *more, *swapped)


def overlapping(boxes: DataFrame, uid: str, box: str, size: float) -> DataFrame:
    """(a, b), a < b: boxes that overlap in more than an edge, by :func:`meeting` of those that differ.

    Equal boxes are compared once and their pairs dealt out in equal tasks; ``size`` is the edge of the smallest cells.
    """
    pairs = saved(meeting(bundled(boxes, uid, [box]), box, size), "pairs")
    return unbundled(pairs.repartition(tasks_for(pairs), "a", "b"))


def display_mode(vertices: Column) -> Column:
    return F.when(vertices <= POINT_LIKE, "marker").otherwise("polygon")
