"""Exact areas of intersections of polygons, from columns.

The inside of a polygon is a signed sum of the strips below its edges, so the area of an intersection is a signed
sum over pairs of edges of the area below both, which has a closed form: holes and concave rings need no case of
their own.  Boxes that overlap are paired on grids; then edges meet only inside slabs of x, as many as the pair has edges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import nested
from ..storage import saved
from . import coverage, geometry

EDGES_IN_SLAB = 4


def _below_both(f0: Column, f1: Column, g0: Column, g1: Column, width: Column) -> Column:
    """Area below two lines from heights f0, g0 to f1, g1 over ``width``."""
    d0, d1 = f0 - g0, f1 - g1
    t = d0 / (d0 - d1)
    at = f0 + t * (f1 - f0)
    plain = (F.least(f0, g0) + F.least(f1, g1)) / 2
    return width * F.when(d0 * d1 < 0, (t * (F.least(f0, g0) + at) + (1 - t) * (at + F.least(f1, g1))) / 2).otherwise(plain)


def edge_table(polygons: DataFrame, uid: str, ring: str) -> DataFrame:
    """uid, low_x, low_x_y, high_x, high_x_y, sign of each edge that is not upright; sign tells on which side the inside lies."""
    lines = coverage.edges(polygons, [uid], ring).where("x1 <> x2")
    to_left = F.col("x2") < F.col("x1")
    pick = lambda a, b: F.when(to_left, F.col(b)).otherwise(F.col(a)).cast("double")
    return lines.select(uid, pick("x1", "x2").alias("xa"), pick("y1", "y2").alias("ya"), pick("x2", "x1").alias("xb"), pick("y2", "y1").alias("yb"), F.when(to_left, 1).otherwise(-1).alias("sign"))


def overlap_areas(polygons: DataFrame, uid: str, ring: str, box: str, size: float, wanted: Column | None = None, own: tuple[str, ...] = ()) -> DataFrame:
    """a, b, area: pairs a < b of polygons whose boxes overlap, with the area that both cover (0 where none).

    ``ring`` holds all edges of a polygon as one array of (x, y), interior on the left; ``box`` its bounds, ``size`` the
    smallest cell of the grids; ``wanted`` may choose among pairs by a and b; columns ``own`` of both polygons come as <name>_a
    and <name>_b.  Polygons equal in ring, box and these are compared once for all.  A polygon of n edges meets one of m in about (n + m) rows as long as its edges are
    short against its width; long edges are cut at the slabs they cross.
    """
    shapes = geometry.bundled(polygons, uid, [ring, box, *own]).withColumnsRenamed({"bundle": "uid", box: "box"})
    pairs = geometry.meeting(shapes.withColumnRenamed("uid", "bundle"), "box", size)
    if wanted is not None:
        numbered = pairs.select("*", F.col("a").alias("_m"), F.col("b").alias("_n"))
        pairs = geometry.unbundled(numbered, "_m", "_n").where(wanted).select(F.col("_m").alias("a"), F.col("_n").alias("b")).distinct()
    named = lambda side: shapes.select(F.col("uid").alias(side), F.col("box").alias(f"box_{side}"), F.size(ring).alias(f"n_{side}"), *(F.col(c).alias(f"{c}_{side}") for c in ("ids", *own)))
    pairs = pairs.select("a", "b").join(named("a"), "a").join(named("b"), "b")
    low, high = F.greatest("box_a.min_x", "box_b.min_x").cast("double"), F.least("box_a.max_x", "box_b.max_x").cast("double")
    floor = F.least("box_a.min_y", "box_b.min_y").cast("double")
    kept = [f"{c}_{s}" for c in ("ids", *own) for s in "ab"]
    slabs = F.greatest(F.lit(1), F.ceil(F.greatest("n_a", "n_b") / EDGES_IN_SLAB)).cast("int")
    pairs = saved(pairs.select("a", "b", low.alias("low"), high.alias("high"), floor.alias("floor"), slabs.alias("slabs"), *kept), "pairs")
    lines = saved(edge_table(shapes, "uid", ring), "sides")

    def cut(side: str) -> DataFrame:
        """Edges of one side of each pair, cut at the pair's slabs: slab, left and right end, heights there, sign."""
        rows = pairs.drop(*kept).join(lines, F.col(side) == F.col("uid")).where((F.col("xa") < F.col("high")) & (F.col("xb") > F.col("low")))
        wide = (F.col("high") - F.col("low")) / F.col("slabs")
        place = lambda x: F.least(F.greatest(F.floor((x - F.col("low")) / wide), F.lit(0)), F.col("slabs") - 1).cast("int")
        rows = rows.withColumn("slab", F.explode(F.sequence(place(F.col("xa")), place(F.col("xb"))))).withColumn("wide", wide)
        left = F.greatest("xa", F.col("low") + F.col("slab") * F.col("wide"))
        right = F.least("xb", F.when(F.col("slab") == F.col("slabs") - 1, F.col("high")).otherwise(F.col("low") + (F.col("slab") + 1) * F.col("wide")))
        return rows.select("a", "b", "slab", left.alias(f"left_{side}"), right.alias(f"right_{side}"), *(F.col(c).alias(f"{c}_{side}") for c in ("xa", "ya", "xb", "yb", "sign"))).where(F.col(f"left_{side}") < F.col(f"right_{side}"))

    met = cut("a").join(cut("b"), ["a", "b", "slab"])
    left, right = F.greatest("left_a", "left_b"), F.least("right_a", "right_b")
    met = met.withColumns({"left": left, "right": right}).where("left < right").join(pairs.select("a", "b", "floor"), ["a", "b"])

    def height(side: str, x: str) -> Column:
        slope = (F.col(f"yb_{side}") - F.col(f"ya_{side}")) / (F.col(f"xb_{side}") - F.col(f"xa_{side}"))
        return F.col(f"ya_{side}") + slope * (F.col(x) - F.col(f"xa_{side}")) - F.col("floor")

    part = _below_both(height("a", "left"), height("a", "right"), height("b", "left"), height("b", "right"), F.col("right") - F.col("left"))
    areas = met.groupBy("a", "b").agg(F.sum(part * F.col("sign_a") * F.col("sign_b")).alias("area"))
    dealt = pairs.select("a", "b", *kept).repartition(geometry.tasks_for(pairs), "a", "b")
    found = geometry.unbundled(dealt.join(areas, ["a", "b"], "left").withColumn("area", F.coalesce("area", F.lit(0.0))), "area", sides=own)
    return found if wanted is None else found.where(wanted)


def overlap_shares(areas: DataFrame, size: str) -> DataFrame:
    """a, b, area, share_a and share_b: what part of either polygon, of areas <size>_a and <size>_b, the other covers; null for one without area."""
    share = lambda s: F.when(F.col(f"{size}_{s}") > 0, F.col("area") / F.col(f"{size}_{s}")).alias(f"share_{s}")
    return areas.select("a", "b", "area", share("a"), share("b"))


def distance(x: Column, y: Column, ring: Column) -> Column:
    """Distance of a point from a polygon given as one array of (x, y): 0 inside, else that of the nearest edge."""
    n = F.size(ring)
    after = lambda i: F.element_at(ring, F.when(i == n - 1, 1).otherwise(i + 2))

    def to_edge(p: Column, i: Column) -> Column:
        dx, dy = after(i)["x"] - p["x"], after(i)["y"] - p["y"]
        long = dx * dx + dy * dy
        t = F.when(long > 0, F.least(F.greatest(((x - p["x"]) * dx + (y - p["y"]) * dy) / long, F.lit(0.0)), F.lit(1.0))).otherwise(0.0)
        return F.hypot(x - p["x"] - t * dx, y - p["y"] - t * dy)

    def crossed(p: Column, i: Column) -> Column:
        q = after(i)
        return F.when(((p["y"] > y) != (q["y"] > y)) & (x < p["x"] + (q["x"] - p["x"]) * (y - p["y"]) / (q["y"] - p["y"])), 1).otherwise(0)

    inside = F.aggregate(F.transform(ring, crossed), F.lit(0), lambda a, c: a + c) % 2 == 1
    return F.when(inside, 0.0).otherwise(F.array_min(F.transform(ring, to_edge)))


def replacements(features: DataFrame, candidates: DataFrame, uid: str, ring: str, size: float, most_distance: float, least_retained: float) -> DataFrame:
    """uid, status, retained: whether a feature takes the more detailed ring that ``candidates`` hold for it.

    ``features`` has uid, ring and a point (x, y); a candidate more than ``most_distance`` from it is too_far.  Else
    the other features' rings are cut away from it; where less than ``least_retained`` of its area is left it is
    blocked.  Features without a candidate are kept.  The features' rings must not overlap one another.
    """
    area = lambda r: F.abs(nested.ring_area(F.col(r)))
    new = candidates.select(F.concat(F.lit("new:"), uid).alias("id"), F.col(uid).alias("own"), F.col(ring).alias("ring"))
    old = features.select(F.concat(F.lit("old:"), uid).alias("id"), F.col(uid).alias("own"), F.col(ring).alias("ring"))
    together = saved(new.unionByName(old).withColumn("box", nested.bounds(F.col("ring"))), "rings")
    mixed = F.col("a").startswith("new:") & F.col("b").startswith("old:") & (F.substring("a", 5, 1000) != F.substring("b", 5, 1000))
    lost = overlap_areas(together, "id", "ring", "box", size, mixed).groupBy(F.col("a").alias("id")).agg(F.sum("area").alias("lost"))
    sized = new.join(lost, "id", "left").select(F.col("own").alias(uid), F.col("ring").alias("_ring"), (1 - F.coalesce("lost", F.lit(0.0)) / area("ring")).alias("retained"))
    found = features.select(uid, "x", "y").join(sized, uid, "left")
    far = distance(F.col("x"), F.col("y"), F.col("_ring")) > most_distance
    status = F.when(F.col("_ring").isNull(), "kept").when(far, "too_far").when(F.col("retained") < least_retained, "blocked").otherwise("replaced")
    return found.select(uid, status.alias("status"), F.when(status.isin("blocked", "replaced"), F.col("retained")).alias("retained"))
