"""Coverages, overlays and projections: cells of a map that customers, suppliers and parts stand for."""

from __future__ import annotations

import math
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import nested, projection
from ..operators import coverage, overlay
from ..operators.skew import dealt
from ._tables import Catalog, table

catalog = Catalog()

CELLS_IN_TASK = 50_000
BENT_CELLS_IN_TASK = 2000  # with 24 edges each
ACROSS = 40  # cells in a row of the map; rows follow one another as the table grows


def _point(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def _corner(i: Column, j: Column) -> Column:
    return _point(i * 100 + (i * 37 + j * 61) % 40, j * 100 + (i * 53 + j * 29) % 40)


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """c_custkey, nation, segment and a four-cornered cell for each customer; neighbours share corners."""
    i, j = F.col("c_custkey") % ACROSS, F.floor(F.col("c_custkey") / ACROSS)
    ring = F.array(_corner(i, j), _corner(i + 1, j), _corner(i + 1, j + 1), _corner(i, j + 1))
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    return dealt(rows, "c_custkey", CELLS_IN_TASK).select("c_custkey", F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment"), ring.alias("ring"))


def _sql_corner(i: str, j: str) -> str:
    return f"{i} * 100 + ({i} * 37 + {j} * 61) % 40, {j} * 100 + ({i} * 53 + {j} * 29) % 40"


def _rings_sql(cells_sql: str, group: str) -> str:
    """Rings of the union of the rows (g, i, j) of ``cells_sql``, walked edge by edge."""
    corners = [_sql_corner(*c) for c in (("i", "j"), ("(i + 1)", "j"), ("(i + 1)", "(j + 1)"), ("i", "(j + 1)"))]
    sides = " UNION ALL ".join(f"SELECT g, {a}, {b} FROM c" for a, b in zip(corners, [*corners[1:], corners[0]], strict=True))
    return f"""WITH RECURSIVE c AS ({cells_sql}), e(g, x1, y1, x2, y2) AS ({sides}),
b AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY g, x1, y1, x2, y2) AS id FROM e WHERE NOT EXISTS (SELECT 1 FROM e r WHERE r.g = e.g AND r.x1 = e.x2 AND r.y1 = e.y2 AND r.x2 = e.x1 AND r.y2 = e.y1)),
t AS (SELECT a.id, o.id AS next, atan2(a.y1 - a.y2, a.x1 - a.x2) - atan2(o.y2 - o.y1, o.x2 - o.x1) AS turn FROM b a JOIN b o ON o.g = a.g AND o.x1 = a.x2 AND o.y1 = a.y2),
n AS MATERIALIZED (SELECT id, arg_min(next, CASE WHEN turn <= 0 THEN turn + 2 * pi() ELSE turn END) AS next FROM t GROUP BY id),
w AS (SELECT id AS head, id AS at, 1 AS n_edges, CAST(x1 * y2 - x2 * y1 AS BIGINT) AS twice FROM b
  UNION ALL SELECT head, n.next, n_edges + 1, twice + CAST(x1 * y2 - x2 * y1 AS BIGINT) FROM w JOIN n ON n.id = w.at JOIN b ON b.id = n.next WHERE n.next > head)
SELECT g AS {group}, CAST(n_edges AS BIGINT) AS n_edges, twice / 2.0::DOUBLE AS area, CAST(x1 AS DOUBLE) AS first_x, CAST(y1 AS DOUBLE) AS first_y FROM w JOIN n ON n.id = w.at AND n.next = head JOIN b ON b.id = head"""


def _summary(parts: DataFrame, group: str) -> DataFrame:
    return coverage.ring_summary(coverage.dissolved(parts, group), group).drop("ring")


@catalog.query(_rings_sql(f"SELECT c_nationkey AS g, c_custkey % {ACROSS} AS i, c_custkey // {ACROSS} AS j FROM customer", "nation"))
def dissolved_rings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cells of each nation dissolved: outer rings and holes, with their edges and signed area."""
    return _summary(coverage.edges(cells(spark, sf_dir), ["nation"], "ring"), "nation")


@catalog.query(_rings_sql(f"SELECT 'land' AS g, c_custkey % {ACROSS} AS i, c_custkey // {ACROSS} AS j FROM customer WHERE c_mktsegment <> 'MACHINERY'", "land"))
def land_backdrop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All cells but the excluded ones as one land."""
    rows = cells(spark, sf_dir).where("segment <> 'MACHINERY'").withColumn("land", F.lit("land"))
    return _summary(coverage.edges(rows, ["land"], "ring"), "land")


_TWICE = f"""c AS (SELECT c_custkey, c_nationkey AS nation, c_custkey % {ACROSS} AS i, c_custkey // {ACROSS} AS j FROM customer),
q AS (SELECT c_custkey, nation, [{', '.join(f"[{_sql_corner(*c)}]" for c in (("i", "j"), ("(i + 1)", "j"), ("(i + 1)", "(j + 1)"), ("i", "(j + 1)")))}] AS p FROM c),
s AS (SELECT c_custkey, nation, list_sum(list_transform(range(1, 5), lambda k: p[k][1] * p[k % 4 + 1][2] - p[k % 4 + 1][1] * p[k][2])) / 2.0::DOUBLE AS area FROM q)"""


@catalog.query(f"WITH {_TWICE} SELECT nation, sum(area) AS before, sum(area) AS after, 0.0::DOUBLE AS lost FROM s GROUP BY nation")
def dissolve_losses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Area of each nation's cells before and after they are dissolved: none is lost."""
    parts = coverage.edges(cells(spark, sf_dir), ["nation"], "ring")
    return coverage.lost_area(parts, coverage.dissolved(parts, "nation"), "nation")


_NEEDED = "SELECT o_custkey AS c_custkey, o_custkey % 60 AS target FROM orders GROUP BY 1"


@catalog.query(f"""WITH {_TWICE}, d AS ({_NEEDED}), t AS (SELECT target, count(*) AS n_needed, count(area) FILTER (nation % 5 <> target % 7) AS n_held, sum(area) FILTER (nation % 5 <> target % 7) AS held FROM d LEFT JOIN s USING (c_custkey) GROUP BY 1)
SELECT target, n_needed, n_held, n_needed = n_held AS complete, CASE WHEN n_needed = n_held THEN held END AS area FROM t""")
def transition_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Targets and the sources they are made of; where all are there, the area of their union."""
    needed = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey")).distinct().withColumn("target", F.col("c_custkey") % 60)
    held = needed.join(cells(spark, sf_dir), "c_custkey").where("nation % 5 <> target % 7")
    counts = needed.groupBy("target").agg(F.count("*").alias("n_needed")).join(held.groupBy("target").agg(F.count("*").alias("n_held")), "target", "left")
    counts = counts.select("target", "n_needed", F.coalesce("n_held", F.lit(0)).alias("n_held")).withColumn("complete", F.col("n_needed") == F.col("n_held"))
    whole = held.join(counts.where("complete").select("target"), "target", "left_semi")
    areas = coverage.ring_summary(coverage.dissolved(coverage.edges(whole, ["target"], "ring"), "target"), "target").groupBy("target").agg(F.sum("area").alias("area"))
    return counts.join(areas, "target", "left").select("target", "n_needed", "n_held", "complete", "area")


# Suppliers' cells have sides of six edges each, so that there is something to thin.
_STEPS, _TOLERANCE = 6, 1500.0


def _bent(i: Column, j: Column, upward: bool, t: Column) -> Column:
    """Point t of a side that leads from corner (i, j) to the right or upward: straight but for a bend at each point between."""
    corner = lambda a, b: (a * 600 + 6 * ((a * 37 + b * 61) % 30), b * 600 + 6 * ((a * 53 + b * 29) % 30))
    (x1, y1), (x2, y2) = corner(i, j), corner(i, j + 1) if upward else corner(i + 1, j)
    bend = F.when(t % _STEPS == 0, 0).otherwise((i * 7 + j * 13 + t * 29 + (5 if upward else 0)) % 41 - 20)
    x, y = F.round(x1 + (x2 - x1) / _STEPS * t), F.round(y1 + (y2 - y1) / _STEPS * t)
    return _point(x + bend if upward else x, y if upward else y + bend)


def bent_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """s_suppkey and a cell of 24 edges for each supplier, ten in a row."""
    i, j = F.col("s_suppkey") % 10, F.floor(F.col("s_suppkey") / 10)
    there, back = F.sequence(F.lit(0), F.lit(_STEPS - 1)), F.sequence(F.lit(_STEPS), F.lit(1))
    sides = ((there, i, j, False), (there, i + 1, j, True), (back, i, j + 1, False), (back, i, j, True))
    ring = F.flatten(F.array(*(F.transform(steps, partial(_bent, a, b, up)) for steps, a, b, up in sides)))
    return dealt(table(spark, sf_dir, "supplier").select("s_suppkey"), "s_suppkey", BENT_CELLS_IN_TASK).select("s_suppkey", ring.alias("ring"))


def _sql_bent(i: str, j: str, upward: bool, t: int) -> str:
    corner = lambda a, b: (f"({a} * 600 + 6 * (({a} * 37 + {b} * 61) % 30))", f"({b} * 600 + 6 * (({a} * 53 + {b} * 29) % 30))")
    (x1, y1), (x2, y2) = corner(i, j), corner(i, f"({j} + 1)") if upward else corner(f"({i} + 1)", j)
    bend = f"(({i} * 7 + {j} * 13 + {t * 29 + (5 if upward else 0)}) % 41 - 20)" if t else "0"
    x, y = f"{x1} + ({x2} - {x1}) // {_STEPS} * {t}", f"{y1} + ({y2} - {y1}) // {_STEPS} * {t}"
    return f"{{'x': CAST({x} + {bend if upward else 0} AS DOUBLE), 'y': CAST({y} + {0 if upward else bend} AS DOUBLE)}}"


def _sql_ring() -> str:
    n = _STEPS
    low, right = [_sql_bent("i", "j", False, t) for t in range(n)], [_sql_bent("(i + 1)", "j", True, t) for t in range(n)]
    high = [_sql_bent("i", "(j + 1)", False, t) if t < n else _sql_bent("(i + 1)", "(j + 1)", False, 0) for t in range(n, 0, -1)]
    left = [_sql_bent("i", "j", True, t) if t < n else _sql_bent("i", "(j + 1)", False, 0) for t in range(n, 0, -1)]
    return ", ".join([*low, *right, *high, *left])


@catalog.query(f"""WITH RECURSIVE p AS (SELECT s_suppkey, unnest(range(1, 25)) AS k, r FROM (SELECT s_suppkey, [{_sql_ring()}] AS r FROM (SELECT s_suppkey, s_suppkey % 10 AS i, s_suppkey // 10 AS j FROM supplier))),
e AS (SELECT s_suppkey, k - 1 AS place, r[k] AS a, r[k % 24 + 1] AS b FROM p),
h AS MATERIALIZED (SELECT a, b FROM e UNION SELECT b, a FROM e),
d AS (SELECT a, count(*) AS n FROM h GROUP BY a),
w AS (SELECT [a, b] AS pts FROM h JOIN d USING (a) WHERE n <> 2 UNION ALL SELECT list_append(pts, h.b) FROM w JOIN d ON d.a = pts[-1] AND d.n = 2 JOIN h ON h.a = pts[-1] AND h.b <> pts[-2]),
l AS (SELECT pts FROM w JOIN d ON d.a = pts[-1] AND d.n <> 2 WHERE (pts[1], pts[2]) <= (pts[-1], pts[-2])),
v AS (SELECT pts AS arc, pts, 0 AS round FROM l UNION ALL SELECT arc, list_concat(pts[1 : m], pts[m + 2 :]), round + 1 FROM (SELECT arc, pts, round, list_position(t, list_min(t)) AS m, list_min(t) AS least
  FROM (SELECT arc, pts, round, list_transform(range(2, len(pts)), lambda i: abs((pts[i - 1].x - pts[i].x) * (pts[i + 1].y - pts[i].y) - (pts[i + 1].x - pts[i].x) * (pts[i - 1].y - pts[i].y)) / 2) AS t FROM v WHERE len(pts) > 2)) WHERE least < {_TOLERANCE}),
s AS (SELECT DISTINCT unnest(arg_max(pts, round)) AS a FROM v GROUP BY arc)
SELECT s_suppkey, CAST(place AS INTEGER) AS place, a.x AS x, a.y AS y FROM e WHERE a IN (SELECT a FROM s)""")
def simplified_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells thinned along their shared borders: neighbours keep the same points."""
    return coverage.simplified(bent_cells(spark, sf_dir), "s_suppkey", "ring", _TOLERANCE)


def quads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """p_partkey and a convex four-cornered ring with its box; many overlap."""
    x, y, k = (F.col("p_partkey") % 97).cast("double"), F.col("p_size").cast("double"), F.col("p_partkey")
    ring = F.array(_point(x, y), _point(x + 1.5, y + (k % 3) * 0.125), _point(x + 1.25, y + 1.25), _point(x + 0.25, y + 1 + (k % 5) * 0.0625))
    return table(spark, sf_dir, "part").select("p_partkey", ring.alias("ring")).withColumn("box", nested.bounds(F.col("ring")))


# Areas here are often whole halves of the unit, which two ways of computing round differently; so the cut lies elsewhere.
_TEN_THOUSANDTHS = "CAST(floor({} * 10000 + 0.3137) AS BIGINT)"


@catalog.query(f"""WITH q AS (SELECT p_partkey AS id, [[x, y], [x + 1.5, y + k % 3 * 0.125], [x + 1.25, y + 1.25], [x + 0.25, y + 1 + k % 5 * 0.0625]] AS p FROM (SELECT p_partkey, p_partkey AS k, CAST(p_partkey % 97 AS DOUBLE) AS x, CAST(p_size AS DOUBLE) AS y FROM part)),
b AS (SELECT id, p, list_min(list_transform(p, lambda c: c[1])) AS x1, list_max(list_transform(p, lambda c: c[1])) AS x2, list_min(list_transform(p, lambda c: c[2])) AS y1, list_max(list_transform(p, lambda c: c[2])) AS y2,
  list_sum(list_transform(range(1, 5), lambda i: p[i][1] * p[i % 4 + 1][2] - p[i % 4 + 1][1] * p[i][2])) / 2 AS area FROM q),
e AS (SELECT id, list_min([a[1], c[1]]) AS xa, list_max([a[1], c[1]]) AS xb, CASE WHEN a[1] < c[1] THEN a[2] ELSE c[2] END AS ya, CASE WHEN a[1] < c[1] THEN c[2] ELSE a[2] END AS yb FROM (SELECT id, p[i] AS a, p[i % 4 + 1] AS c FROM q, range(1, 5) AS r(i)) WHERE a[1] <> c[1]),
l AS (SELECT *, (yb - ya) / (xb - xa) AS m FROM e),
n AS (SELECT a.id AS a, b.id AS b, a.area AS area_a, b.area AS area_b, greatest(a.x1, b.x1) AS low, least(a.x2, b.x2) AS high FROM b a JOIN b ON a.id < b.id AND greatest(a.x1, b.x1) < least(a.x2, b.x2) AND greatest(a.y1, b.y1) < least(a.y2, b.y2)),
c AS (SELECT a, b, low AS x FROM n UNION SELECT a, b, high FROM n UNION SELECT a, b, xa FROM n JOIN l ON l.id IN (a, b) WHERE xa > low AND xa < high UNION SELECT a, b, xb FROM n JOIN l ON l.id IN (a, b) WHERE xb > low AND xb < high
  UNION SELECT n.a, n.b, (g.ya - g.m * g.xa - f.ya + f.m * f.xa) / (f.m - g.m) AS x FROM n JOIN l f ON f.id = n.a JOIN l g ON g.id = n.b WHERE f.m <> g.m AND (g.ya - g.m * g.xa - f.ya + f.m * f.xa) / (f.m - g.m) > low AND (g.ya - g.m * g.xa - f.ya + f.m * f.xa) / (f.m - g.m) < high),
s AS (SELECT a, b, x, lead(x) OVER (PARTITION BY a, b ORDER BY x) AS x2 FROM c),
m AS (SELECT a, b, x2 - x AS wide, (x + x2) / 2 AS mid FROM s WHERE x2 > x),
h AS (SELECT m.a, m.b, mid, wide, l.id = m.a AS own, min(ya + l.m * (mid - xa)) AS low, max(ya + l.m * (mid - xa)) AS high FROM m JOIN l ON l.id IN (m.a, m.b) AND xa <= mid AND xb >= mid GROUP BY ALL),
o AS (SELECT a, b, mid, wide * greatest(0, min(high) - max(low)) AS area FROM h GROUP BY a, b, mid, wide),
t AS (SELECT a, b, sum(area) AS area FROM o GROUP BY a, b)
SELECT n.a, n.b, {_TEN_THOUSANDTHS.format('t.area')} AS area, {_TEN_THOUSANDTHS.format('t.area / area_a')} AS share_a, {_TEN_THOUSANDTHS.format('t.area / area_b')} AS share_b, t.area / area_a > 0.05 OR t.area / area_b > 0.05 AS material FROM n JOIN t USING (a, b) WHERE t.area > 1e-9""")
def overlap_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Polygons that overlap, the area (in ten thousandths) and what part of either it is; material over 5 %."""
    rows = quads(spark, sf_dir).withColumn("size", nested.ring_area(F.col("ring")))
    areas = overlay.overlap_areas(rows, "p_partkey", "ring", "box", 2.0, own=("size",)).where("area > 1e-9")
    shares = overlay.overlap_shares(areas, "size")
    units = lambda c: F.floor(F.col(c) * 10000 + 0.3137).cast("bigint").alias(c)
    return shares.select("a", "b", units("area"), units("share_a"), units("share_b"), ((F.col("share_a") > 0.05) | (F.col("share_b") > 0.05)).alias("material"))


def _places(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select("c_custkey", (F.lit(34.2) + (k * 7919 % 1000) * 0.0016).alias("lon"), (F.lit(29.5) + (k * 104729 % 1000) * 0.0038).alias("lat"))


def _sql_projection() -> str:
    p = projection
    e2w, e2g = (f * (2 - f) for f in (p.WGS_FLATTENING, p.GRID_FLATTENING))
    e, minor = math.sqrt(e2g), p.GRID_AXIS * (1 - p.GRID_FLATTENING)
    back = [" + ".join(f"{float(a)!r}::DOUBLE * ({c} - {s!r}::DOUBLE)" for a, c, s in zip(row, "xyz", p.SHIFT, strict=True)) for row in p.BACK]
    north = " + ".join(["xi", *(f"{a!r}::DOUBLE * sin({2 * j} * xi) * cosh({2 * j} * eta)" for j, a in enumerate(p.ALPHA, 1))])
    east = " + ".join(["eta", *(f"{a!r}::DOUBLE * cos({2 * j} * xi) * sinh({2 * j} * eta)" for j, a in enumerate(p.ALPHA, 1))])
    return f"""WITH p AS (SELECT c_custkey, 34.2::DOUBLE + c_custkey * 7919 % 1000 * 0.0016::DOUBLE AS lon, 29.5::DOUBLE + c_custkey * 104729 % 1000 * 0.0038::DOUBLE AS lat FROM customer),
r AS (SELECT *, radians(lat) AS f, radians(lon) AS l, {p.WGS_AXIS!r}::DOUBLE / sqrt(1 - {e2w!r}::DOUBLE * pow(sin(radians(lat)), 2)) AS r FROM p),
c AS (SELECT c_custkey, lon, lat, r * cos(f) * cos(l) AS x, r * cos(f) * sin(l) AS y, r * {1 - e2w!r}::DOUBLE * sin(f) AS z FROM r),
g AS (SELECT c_custkey, lon, lat, {back[0]} AS x, {back[1]} AS y, {back[2]} AS z FROM c),
t AS (SELECT *, sqrt(x * x + y * y) AS p, atan(z * {p.GRID_AXIS!r}::DOUBLE / (sqrt(x * x + y * y) * {minor!r}::DOUBLE)) AS t FROM g),
a AS (SELECT c_custkey, lon, lat, atan((z + {e2g / (1 - e2g) * minor!r}::DOUBLE * pow(sin(t), 3)) / (p - {e2g * p.GRID_AXIS!r}::DOUBLE * pow(cos(t), 3))) AS f, atan2(y, x) - radians({p.ORIGIN_LON!r}::DOUBLE) AS l FROM t),
k AS (SELECT *, sinh(atanh(sin(f)) - {e!r}::DOUBLE * atanh({e!r}::DOUBLE * sin(f))) AS k FROM a),
s AS (SELECT c_custkey, lon, lat, atan2(k, cos(l)) AS xi, asinh(sin(l) / sqrt(k * k + cos(l) * cos(l))) AS eta FROM k)
SELECT c_custkey, CAST(round(({p.FALSE_EASTING!r}::DOUBLE + {p.RADIUS!r}::DOUBLE * ({east})) * 1000) AS BIGINT) AS x_mm, CAST(round(({p.FALSE_NORTHING!r}::DOUBLE + {p.RADIUS!r}::DOUBLE * ({north} - {p._ORIGIN!r}::DOUBLE)) * 1000) AS BIGINT) AS y_mm,
CAST(round(lon * 1e9) AS BIGINT) AS lon_back, CAST(round(lat * 1e9) AS BIGINT) AS lat_back FROM s"""


@catalog.query(_sql_projection())
def grid_coordinates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places in degrees, in millimetres of the grid, and back in billionths of a degree (a tenth of a millimetre)."""
    there = projection.to_grid(_places(spark, sf_dir), "lon", "lat").drop("lon", "lat")
    back = projection.to_degrees(there, "x", "y")
    whole = lambda c, scale: F.rint(F.col(c) * scale).cast("bigint")
    return back.select("c_custkey", whole("x", 1e3).alias("x_mm"), whole("y", 1e3).alias("y_mm"), whole("lon", 1e9).alias("lon_back"), whole("lat", 1e9).alias("lat_back"))


@catalog.query(f"""SELECT c_custkey, 192 AS corners, CAST(floor({192 / 2 * math.sin(2 * math.pi / 192)!r}::DOUBLE * pow(50 + c_custkey % 7 * 100, 2) + 0.5) AS BIGINT) AS square_metres FROM customer""")
def buffer_rings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A ring of 192 corners around each place, made in metres, kept in degrees; its area in the grid."""
    places = projection.to_grid(_places(spark, sf_dir), "lon", "lat", "x0", "y0").withColumn("radius", 50 + F.col("c_custkey") % 7 * 100)
    corners = projection.buffered(dealt(places, "c_custkey", 5000), "c_custkey", "lon", "lat", "radius", keep=("x0", "y0"))
    # Places are dealt before their corners are made and corners stand in order, so none of them is shuffled; the sort also
    # keeps the two projections in generated functions of their own, which together are too long to be compiled.
    rings = projection.to_grid(corners.sortWithinPartitions("c_custkey", "place"), "lon", "lat")
    near = rings.select("c_custkey", "place", (F.col("x") - F.col("x0")).alias("x"), (F.col("y") - F.col("y0")).alias("y"))
    along = Window.partitionBy("c_custkey").orderBy("place")
    after = lambda c: F.coalesce(F.lead(c).over(along), F.first(c).over(along))
    area = F.sum(F.col("x") * F.col("y2") - F.col("x2") * F.col("y")) / 2
    sums = near.select("c_custkey", "x", "y", after("x").alias("x2"), after("y").alias("y2")).groupBy("c_custkey").agg(F.count("*").cast("int").alias("corners"), area.alias("area"))
    return sums.select("c_custkey", "corners", F.floor(F.col("area") + 0.5).cast("bigint").alias("square_metres"))


def _box(x: Column, y: Column, side: int) -> Column:
    return F.array(_point(x, y), _point(x + side, y), _point(x + side, y + side), _point(x, y + side))


@catalog.query("""WITH f AS (SELECT c_custkey AS k, c_custkey % 40 * 1000 AS x, c_custkey // 40 * 1000 AS y FROM customer),
n AS (SELECT k, x + k % 13 * 500 - 400 AS x1, y + k % 5 * 70 - 100 AS y1 FROM f WHERE k % 3 <> 0),
l AS (SELECT n.k, sum(greatest(0, least(n.x1 + 900, o.x + 700) - greatest(n.x1, o.x)) * greatest(0, least(n.y1 + 900, o.y + 700) - greatest(n.y1, o.y))) AS lost FROM n JOIN f o ON o.k <> n.k AND o.x < n.x1 + 900 AND o.x + 700 > n.x1 AND o.y < n.y1 + 900 AND o.y + 700 > n.y1 GROUP BY 1),
s AS (SELECT f.k, n.x1 IS NOT NULL AS has, sqrt(pow(greatest(n.x1 - f.x, 0, f.x - n.x1 - 900), 2) + pow(greatest(n.y1 - f.y, 0, f.y - n.y1 - 900), 2)) > 5000 AS far, 810000 - coalesce(lost, 0) AS kept FROM f LEFT JOIN n USING (k) LEFT JOIN l USING (k))
SELECT k AS c_custkey, CASE WHEN NOT has THEN 'kept' WHEN far THEN 'too_far' WHEN kept < 405000 THEN 'blocked' ELSE 'replaced' END AS status, CASE WHEN has AND NOT far THEN CAST(kept AS BIGINT) END AS square_metres FROM s""")
def detail_replacement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features take a detailed ring that lies within 5 km and keeps half its area beside the neighbours."""
    k = F.col("c_custkey")
    features = table(spark, sf_dir, "customer").select(k, (k % ACROSS * 1000).cast("double").alias("x"), (F.floor(k / ACROSS) * 1000).cast("double").alias("y"))
    moved = features.where(k % 3 != 0).select(k, _box(F.col("x") + k % 13 * 500 - 400, F.col("y") + k % 5 * 70 - 100, 900).alias("ring"))
    found = overlay.replacements(features.withColumn("ring", _box(F.col("x"), F.col("y"), 700)), moved, "c_custkey", "ring", 1000.0, 5000.0, 0.5)
    return found.select("c_custkey", "status", F.rint(F.col("retained") * 810000).cast("bigint").alias("square_metres"))
