"""Coverages, overlays and projections against plain Python."""

import math
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from canvass import storage
from canvass.functions import nested, projection
from canvass.operators import contracts, coverage, geometry, overlay
from canvass.plans import maps

POLYGONS = "id long, g long, ring array<struct<x:double,y:double>>"


def area(ring):
    return sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring, [*ring[1:], ring[0]], strict=True)) / 2


def square(i, j, side=10.0):
    return [(i * side, j * side), ((i + 1) * side, j * side), ((i + 1) * side, (j + 1) * side), (i * side, (j + 1) * side)]


def rings_of(df):
    found = {}
    for r in coverage.ring_arrays(df, "g").collect():
        found.setdefault(r["g"], []).append([(p["x"], p["y"]) for p in r["points"]])
    return found


def test_a_ring_around_a_hole_and_corners_that_touch(spark):
    around = [(i, j) for i in range(3) for j in range(3) if (i, j) != (1, 1)]
    rows = [(n, 0, square(i, j)) for n, (i, j) in enumerate(around)] + [(20, 1, square(5, 5)), (21, 1, square(6, 6))]
    parts = coverage.edges(spark.createDataFrame(rows, POLYGONS), ["id", "g"], "ring")
    rings = coverage.dissolved(parts, "g")
    got = {g: sorted(map(area, r)) for g, r in rings_of(rings).items()}
    assert got == {0: [-100.0, 900.0], 1: [100.0, 100.0]}  # a hole is clockwise; cells that touch in a point stay two rings
    assert sorted(len(r) for r in rings_of(rings)[0]) == [4, 12]
    assert {(r["g"], r["before"], r["lost"]) for r in coverage.lost_area(parts, rings, "g").collect()} == {(0, 800.0, 0.0), (1, 200.0, 0.0)}


def test_dissolving_random_cells_keeps_every_area(spark):
    rng = random.Random(2)
    rows = [(i * 15 + j, rng.randrange(3), square(i, j)) for i in range(20) for j in range(15)]
    parts = coverage.edges(spark.createDataFrame(rows, POLYGONS), ["id", "g"], "ring")
    rings = coverage.dissolved(parts, "g")
    for g, found in rings_of(rings).items():
        assert sum(map(area, found)) == 100.0 * sum(r[1] == g for r in rows)
        assert all((x, y) == (x2, y2) for x, y, x2, y2 in chained(rings.where(F.col("g") == g)))


def chained(rings):
    """End of each edge beside the start of the next along its ring."""
    own = {}
    for r in rings.collect():
        own.setdefault(r["ring"], {})[r["place"]] = r
    for places in own.values():
        for k, r in places.items():
            after = places[(k + 1) % r["length"]]
            yield r["x2"], r["y2"], after["x"], after["y"]


def test_polygons_that_overlap_are_refused(spark):
    rows = [(1, 0, square(0, 0)), (2, 0, square(0, 0))]
    with pytest.raises(contracts.ContractError, match="overlap"):
        coverage.boundary(coverage.edges(spark.createDataFrame(rows, POLYGONS), ["id", "g"], "ring"), "g")


def test_a_ring_of_ten_thousand_edges_takes_fifteen_rounds(spark):
    n, order = 10_000, list(range(10_000))
    random.Random(3).shuffle(order)
    links = [(order[i], order[(i + 1) % n]) for i in range(n)] + [(n, n + 1), (n + 1, n), (n + 2, n + 2)]
    got = {r["id"]: r for r in coverage.cycles(spark.createDataFrame(links, "id long, next long"), most_rounds=15).collect()}
    start = order.index(0)
    assert all(got[order[(start + k) % n]]["place"] == k and got[order[k]]["head"] == 0 for k in range(n)) and got[5]["length"] == n
    assert (got[n + 1]["head"], got[n + 1]["place"], got[n + 2]["length"]) == (n, 1, 1)


def test_no_polygons(spark):
    empty = spark.createDataFrame([], POLYGONS)
    parts = coverage.edges(empty, ["id", "g"], "ring")
    assert coverage.dissolved(parts, "g").count() == 0 and coverage.simplified(empty, "id", "ring", 1.0).count() == 0


def test_arcs_of_islands_and_of_shared_borders(spark):
    island = [(100.0, 100.0), (110.0, 100.0), (112.0, 108.0), (101.0, 109.0)]
    rows = [(1, 0, square(0, 0)), (2, 0, square(1, 0)), (3, 0, island)]
    got = {}
    for r in coverage.arcs(coverage.edges(spark.createDataFrame(rows, POLYGONS), ["id"], "ring")).collect():
        got.setdefault(r["arc"], []).append((r["place"], (r["x"], r["y"]), (r["x2"], r["y2"])))
    lines = sorted(([a for _, a, _ in sorted(v)] + [sorted(v)[-1][2]] for v in got.values()), key=len)
    assert [(len(line), line[0]) for line in lines] == [(2, (10.0, 0.0)), (4, (10.0, 0.0)), (4, (10.0, 0.0)), (5, (100.0, 100.0))]
    assert lines[-1][0] == lines[-1][-1]


def wavy(rng, n=7):
    """Cells whose sides bend at five points, the same for both neighbours."""
    def line(a, b):
        key = (min(a, b), max(a, b))
        if key not in bends:
            bends[key] = [rng.uniform(-3, 3) for _ in range(5)]
        way = [(key[0][0] * 100 + (key[1][0] - key[0][0]) * 100 * t / 6 + (k if key[0][0] == key[1][0] else 0), key[0][1] * 100 + (key[1][1] - key[0][1]) * 100 * t / 6 + (k if key[0][1] == key[1][1] else 0)) for t, k in zip(range(1, 6), bends[key], strict=True)]
        return [(a[0] * 100.0, a[1] * 100.0), *(way if a < b else way[::-1])]

    bends = {}
    return [(i * n + j, 0, [p for a, b in zip(c, [*c[1:], c[0]], strict=True) for p in line(a, b)]) for i in range(n) for j in range(n) for c in [[(i, j), (i + 1, j), (i + 1, j + 1), (i, j + 1)]]]


def test_neighbours_share_all_edges_after_thinning(spark):
    rows = wavy(random.Random(4))
    df = spark.createDataFrame(rows, POLYGONS)
    kept = {}
    for r in coverage.simplified(df, "id", "ring", 60.0).orderBy("id", "place").collect():
        kept.setdefault(r["id"], []).append((r["x"], r["y"]))
    assert sum(map(len, kept.values())) < 0.8 * sum(len(r[2]) for r in rows) and all(len(r) >= 4 for r in kept.values())
    thin = spark.createDataFrame([(i, 0, ring) for i, ring in kept.items()], POLYGONS)
    union = rings_of(coverage.dissolved(coverage.edges(thin, ["id", "g"], "ring"), "g"))[0]
    assert len(union) == 1 and area(union[0]) == pytest.approx(sum(map(area, kept.values())), rel=1e-12)  # no gap, no overlap


def test_rings_are_not_thinned_away(spark):
    rows = [(1, 0, square(0, 0, 1.0)), (2, 0, square(1, 0, 1.0)), (3, 0, [(9.0, 9.0), (10.0, 9.0), (9.0, 10.0)])]
    got = coverage.simplified(spark.createDataFrame(rows, POLYGONS), "id", "ring", 1e9).groupBy("id").count().collect()
    assert sorted(map(tuple, got)) == [(1, 4), (2, 4), (3, 3)]


def test_visvalingam_against_plain_removal():
    rng = random.Random(6)
    for _ in range(50):
        pts = [(rng.randrange(40) * 1.0, rng.randrange(40) * 1.0) for _ in range(25)]
        left = list(range(25))
        while len(left) > 2:
            areas = [(abs((pts[a][0] - pts[b][0]) * (pts[c][1] - pts[b][1]) - (pts[c][0] - pts[b][0]) * (pts[a][1] - pts[b][1])) / 2, b) for a, b, c in zip(left, left[1:], left[2:], strict=False)]
            if min(areas)[0] >= 30:
                break
            left.remove(min(areas)[1])
        kept = coverage.visvalingam(*zip(*pts, strict=True), 30.0)
        assert [i for i, k in enumerate(kept) if k] == left


def star(rng, x, y, n):
    """A concave ring around a point, counter-clockwise."""
    return [(x + r * math.cos(t), y + r * math.sin(t)) for r, t in ((rng.uniform(1, 6), 2 * math.pi * k / n) for k in range(n))]


def inside(ring, x, y):
    odd = False
    for (x1, y1), (x2, y2) in zip(ring, [*ring[1:], ring[0]], strict=True):
        if (y1 > y) != (y2 > y) and x < x1 + (x2 - x1) * (y - y1) / (y2 - y1):
            odd = not odd
    return odd


def crossed_area(one, other):
    """Area of the intersection, strip by strip between all x of vertices and crossings; exact for straight edges."""
    sides = [list(zip(r, [*r[1:], r[0]], strict=True)) for r in (one, other)]
    xs = {p[0] for r in (one, other) for p in r}
    for (ax, ay), (bx, by) in sides[0]:
        for (cx, cy), (dx, dy) in sides[1]:
            det = (bx - ax) * (dy - cy) - (by - ay) * (dx - cx)
            if det:
                t = ((cx - ax) * (dy - cy) - (cy - ay) * (dx - cx)) / det
                u = ((cx - ax) * (by - ay) - (cy - ay) * (bx - ax)) / det
                if 0 <= t <= 1 and 0 <= u <= 1:
                    xs.add(ax + t * (bx - ax))
    total, xs = 0.0, sorted(xs)
    for low, high in zip(xs, xs[1:], strict=False):
        mid = (low + high) / 2
        spans = []
        for own in sides:
            ys = sorted(a[1] + (b[1] - a[1]) * (mid - a[0]) / (b[0] - a[0]) for a, b in own if (a[0] > mid) != (b[0] > mid))
            spans.append(list(zip(ys[::2], ys[1::2], strict=True)))
        total += (high - low) * sum(max(0.0, min(a[1], b[1]) - max(a[0], b[0])) for a in spans[0] for b in spans[1])
    return total


def test_overlap_areas_of_concave_rings(spark):
    rng = random.Random(7)
    rows = [(i, 0, star(rng, rng.uniform(0, 40), rng.uniform(0, 40), rng.randrange(3, 40))) for i in range(60)]
    rows.append((60, 0, star(rng, 20, 20, 900)))  # many edges
    rows.append((61, 0, [(-50.0, -50.0), (90.0, -50.0), (90.0, 90.0), (-50.0, 90.0)]))  # around all
    df = spark.createDataFrame(rows, POLYGONS).withColumn("box", nested.bounds(F.col("ring")))
    got = {(r["a"], r["b"]): r["area"] for r in overlay.overlap_areas(df, "id", "ring", "box", 4.0).collect()}
    for i, (a, _, p) in enumerate(rows):
        for b, _, q in rows[i + 1 :]:
            assert got.get((a, b), 0.0) == pytest.approx(crossed_area(p, q), abs=1e-7), (a, b)
    assert all(got[(i, 61)] == pytest.approx(area(rows[i][2]), rel=1e-9) for i in range(60))


def test_touching_neighbours_share_no_area(spark):
    df = spark.createDataFrame([(1, 0, square(0, 0)), (2, 0, square(1, 0)), (3, 0, square(1, 1))], POLYGONS).withColumn("box", nested.bounds(F.col("ring")))
    assert all(r["area"] == 0 for r in overlay.overlap_areas(df, "id", "ring", "box", 4.0).collect())


def test_distance_from_a_polygon(spark):
    rng = random.Random(8)
    ring = star(rng, 0, 0, 12)
    points = [(rng.uniform(-9, 9), rng.uniform(-9, 9)) for _ in range(200)]

    def plain(x, y):
        if inside(ring, x, y):
            return 0.0
        best = math.inf
        for (x1, y1), (x2, y2) in zip(ring, [*ring[1:], ring[0]], strict=True):
            t = max(0.0, min(1.0, ((x - x1) * (x2 - x1) + (y - y1) * (y2 - y1)) / ((x2 - x1) ** 2 + (y2 - y1) ** 2)))
            best = min(best, math.hypot(x - x1 - t * (x2 - x1), y - y1 - t * (y2 - y1)))
        return best

    df = spark.createDataFrame([(x, y, ring) for x, y in points], "x double, y double, ring array<struct<x:double,y:double>>")
    for r in df.select("x", "y", overlay.distance(F.col("x"), F.col("y"), F.col("ring")).alias("d")).collect():
        assert r["d"] == pytest.approx(plain(r["x"], r["y"]), abs=1e-9)


def test_projection_returns_within_a_hundredth_of_a_millimetre(spark):
    rng = random.Random(9)
    rows = [(rng.uniform(34.0, 36.2), rng.uniform(29.3, 33.6)) for _ in range(500)] + [(None, 31.0)]
    back = projection.to_degrees(projection.to_grid(spark.createDataFrame(rows, "lon double, lat double"), "lon", "lat"), "x", "y", "lon2", "lat2").collect()
    for r in back[:-1]:
        assert abs(r["lon2"] - r["lon"]) * 111e6 < 0.01 and abs(r["lat2"] - r["lat"]) * 111e6 < 0.01
        assert 0 < r["x"] < 400_000 and 300_000 < r["y"] < 900_000
    assert back[-1]["x"] is None and back[-1]["lat2"] is None


def test_grid_steps_are_as_long_as_on_the_ellipsoid(spark):
    # along the central meridian a degree of latitude near 31.7 is some 110.87 km times the scale
    rows = [(projection.ORIGIN_LON, 31.2), (projection.ORIGIN_LON, 32.2)]
    ys = [r["y"] for r in projection.to_grid(spark.createDataFrame(rows, "lon double, lat double"), "lon", "lat").collect()]
    e2 = projection.WGS_FLATTENING * (2 - projection.WGS_FLATTENING)
    steps = 10_000
    arc = sum(projection.WGS_AXIS * (1 - e2) / (1 - e2 * math.sin(math.radians(31.2 + (k + 0.5) / steps)) ** 2) ** 1.5 for k in range(steps)) * math.radians(1 / steps)
    assert ys[1] - ys[0] == pytest.approx(arc * projection.SCALE, abs=2.0)  # the datums differ by some parts in a million


def test_replacements_against_plain_python(spark):
    rng = random.Random(10)
    features = [(i, square(i % 6, i // 6, 50.0)) for i in range(30)]
    features = [(i, r, r[0][0] + 25, r[0][1] + 25) for i, r in features]
    candidates = [(i, star(rng, x + rng.uniform(-20, 60), y + rng.uniform(-20, 20), 9)) for i, _, x, y in features if i % 4]
    got = {r["id"]: r for r in overlay.replacements(spark.createDataFrame(features, "id long, ring array<struct<x:double,y:double>>, x double, y double"), spark.createDataFrame(candidates, "id long, ring array<struct<x:double,y:double>>"), "id", "ring", 20.0, 30.0, 0.5).collect()}
    new, seen = dict(candidates), set()
    for i, _, x, y in features:
        if i not in new:
            assert got[i]["status"] == "kept"
            continue
        left = 1 - sum(crossed_area(new[i], r) for j, r, _, _ in features if j != i) / area(new[i])
        near = min(math.dist((x, y), (px + t * (qx - px), py + t * (qy - py))) for (px, py), (qx, qy) in zip(new[i], [*new[i][1:], new[i][0]], strict=True) for t in [max(0.0, min(1.0, ((x - px) * (qx - px) + (y - py) * (qy - py)) / ((qx - px) ** 2 + (qy - py) ** 2)))])
        want = "too_far" if near > 30 and not inside(new[i], x, y) else "blocked" if left < 0.5 else "replaced"
        assert got[i]["status"] == want and (want == "too_far" or got[i]["retained"] == pytest.approx(left, abs=1e-9))
        seen.add(want)
    assert seen == {"too_far", "blocked", "replaced"}


def copies(spark):
    """Equal squares in more than two bundles and two polygons of their own."""
    n = 2 * geometry.BUNDLE + 30
    rows = [(k, square(0, 0)) for k in range(n)] + [(n, [(5.0, 5.0), (15.0, 5.0), (15.0, 20.0), (5.0, 20.0)]), (n + 1, square(7, 7))]
    df = spark.createDataFrame(rows, "id long, ring array<struct<x:double,y:double>>").withColumns({"box": nested.bounds(F.col("ring")), "size": nested.ring_area(F.col("ring"))})
    return n, df


def test_copies_of_a_box_are_compared_once_for_all_their_pairs(spark):
    n, df = copies(spark)
    met = geometry.meeting(geometry.bundled(df, "id", ["box"]), "box", 4.0)
    assert met.count() <= 20  # bundles; pairs are about n * n / 2
    pairs = geometry.overlapping(df, "id", "box", 4.0)
    assert pairs.count() == pairs.distinct().count() == n * (n - 1) // 2 + n and pairs.where("a >= b").count() == 0


def test_copies_of_a_polygon_are_compared_once_for_all_their_pairs(spark):
    n, df = copies(spark)
    found = overlay.overlap_shares(overlay.overlap_areas(df, "id", "ring", "box", 4.0, own=("size",)), "size")
    got = {tuple(r) for r in found.groupBy(F.col("b") == n, "area", "share_a", "share_b").count().collect()}
    assert got == {(False, 100.0, 1.0, 1.0, n * (n - 1) // 2), (True, 25.0, 0.25, 25 / 150, n)}
    few = overlay.overlap_areas(df, "id", "ring", "box", 4.0, (F.col("a") == 3) & (F.col("b") < 9))
    assert sorted((r["a"], r["b"]) for r in few.collect()) == [(3, b) for b in range(4, 9)]


def test_corners_of_rings_are_not_shuffled(spark, sf_dir):
    plan = maps.buffer_rings(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan  # places are dealt, before they have corners


def test_cells_are_dealt_into_tasks_whatever_the_row_groups_hold(spark, tmp_path):
    one = spark.range(2 * maps.CELLS_IN_TASK + 9).selectExpr("id AS c_custkey", "cast(id % 25 AS int) AS c_nationkey", "'BUILDING' AS c_mktsegment")
    one.coalesce(1).write.parquet(str(tmp_path / "customer.parquet"))
    sizes = [r["n"] for r in maps.cells(spark, str(tmp_path)).groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert len(sizes) == 3 and max(sizes) <= maps.CELLS_IN_TASK


def test_rounds_along_cycles_broadcast_nothing(spark, monkeypatch):
    plans = []
    monkeypatch.setattr(coverage, "saved", lambda df, name: plans.append((name, df._jdf.queryExecution().executedPlan().toString())) or storage.saved(df, name))
    links = spark.range(100).selectExpr("id", "id - id % 10 + (id + 1) % 10 AS next")
    assert coverage.cycles(links).where("length = 10 and head = id - id % 10 and place = id % 10").count() == 100
    rounds = [plan for name, plan in plans if name == "cycle"]
    assert len(rounds) > 3 and not any("Broadcast" in plan for plan in rounds)


def test_bent_cells_are_dealt_into_tasks_whatever_the_row_groups_hold(spark, tmp_path):
    spark.range(2 * maps.BENT_CELLS_IN_TASK + 9).withColumnRenamed("id", "s_suppkey").coalesce(1).write.parquet(str(tmp_path / "supplier.parquet"))
    sizes = [r["n"] for r in maps.bent_cells(spark, str(tmp_path)).groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert len(sizes) == 3 and sum(sizes) == 2 * maps.BENT_CELLS_IN_TASK + 9 and max(sizes) <= maps.BENT_CELLS_IN_TASK


def test_arcs_are_thinned_as_one_stream_wherever_batches_are_cut(spark, monkeypatch):
    rng = random.Random(11)
    arcs = [[(rng.randrange(40) * 1.0, rng.randrange(40) * 1.0) for _ in range(n)] for n in (2, 9, 30, 2, 17)]
    rows = pd.DataFrame([(k, *p, *q) for k, line in enumerate(arcs) for p, q in zip(line, line[1:], strict=False)], columns=["arc", "x", "y", "x2", "y2"])
    want = [p for line in arcs for p, kept in zip(line, coverage.visvalingam(*zip(*line, strict=True), 30.0), strict=True) if kept]
    for size in (1, 4, 1000):
        batches = [rows[k : k + size] for k in range(0, len(rows), size)] + [rows[:0]]
        assert [tuple(p) for found in coverage._thinned(30.0)(iter(batches)) for p in found.to_numpy()] == want
    plans = []
    monkeypatch.setattr(coverage, "saved", lambda df, name: plans.append((name, df._jdf.queryExecution().executedPlan().toString())) or storage.saved(df, name))
    coverage.simplified(spark.createDataFrame(wavy(rng, 2), POLYGONS), "id", "ring", 60.0)
    assert all("FlatMapGroups" not in plan for _, plan in plans)  # a group for each arc would cost more than its thinning
    assert sum("Generate" in plan for _, plan in plans) == 1  # rings become rows once
