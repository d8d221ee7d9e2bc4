import math
import os
import random
from itertools import product

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from canvass import storage
from canvass.operators import aggregate, cascade, contracts, graph, lookup, partition, ranking, reshape, reviews, skew


def test_winner_ties_zero_votes_and_single_party(spark):
    votes = spark.createDataFrame([(1, "b", 5), (1, "a", 5), (2, "a", 0), (2, "b", 0), (3, "x", 4)], "area int, party string, n long")
    got = {r["area"]: r for r in ranking.winners(votes, ["area"], "party", "n").collect()}
    assert (got[1]["winner"], got[1]["runner_up"], got[1]["margin"], got[1]["winner_share"]) == ("a", "b", 0, 0.5)
    assert (got[2]["winner"], got[2]["winner_votes"], got[2]["winner_share"]) == ("a", 0, None)
    assert (got[3]["runner_up"], got[3]["margin"], got[3]["winner_share"]) == (None, 4, 1.0)


def test_first_hit_order_and_miss(spark):
    facts = spark.createDataFrame([(1, 10), (2, 10), (3, 30)], "u int, k int")
    a, b = spark.createDataFrame([(1, "A")], "u int, t string"), spark.createDataFrame([(10, "B")], "k int, t string")
    got = lookup.first_hit(facts, [("own", a, "u", "t"), ("group", b, "k", "t")], "target").orderBy("u").collect()
    assert [(r["target"], r["lookup"]) for r in got] == [("A", "own"), ("B", "group"), (None, None)]


def test_unique_index_drops_ambiguous_and_null(spark):
    rows = spark.createDataFrame([("x", 1), ("x", 1), ("y", 1), ("y", 2), (None, 3)], "k string, t int")
    assert [tuple(r) for r in lookup.unique_index(rows, "k", "t").collect()] == [("x", 1)]


def test_ranges_that_touch_overlap(spark):
    rules = spark.createDataFrame([("a", 1, 5), ("a", 5, 9), ("b", 1, 4), ("b", 5, 6)], "k string, low int, high int")
    assert [(r["k"], r["low"]) for r in lookup.overlaps(rules, ["k"], "low", "high").collect()] == [("a", 5)]


def test_preferred_reasons(spark):
    rows = spark.createDataFrame([("a", 1, True), ("a", 2, False), ("b", 3, False), ("c", 4, False), ("c", 5, False), ("d", 6, True), ("d", 7, True)], "k string, t int, f boolean")
    got = {r["k"]: (r["t"], r["reason"]) for r in lookup.preferred(rows, "k", "t", F.col("f")).collect()}
    assert got == {"a": (1, "flagged"), "b": (3, "only"), "c": (None, "ambiguous"), "d": (None, "ambiguous")}


def test_cascade_precedence_guard_and_conservation(spark):
    facts = spark.createDataFrame([(i, "ok" if i % 2 else "no") for i in range(6)], "u int, s string")
    first = spark.createDataFrame([(1, 100), (2, 100)], "u int, t int")
    second = spark.createDataFrame([(1, 200), (2, 201), (3, 200), (4, 200)], "u int, t int")
    sources = [cascade.Evidence("one", first, "direct", "high", guard=F.col("s") == "ok"), cascade.Evidence("two", second, "inferred", "moderate")]
    got = {r["u"]: (r["target"], r["method"]) for r in cascade.resolve(facts, "u", sources).collect()}
    assert got == {0: (None, "unresolved"), 1: (100, "one"), 2: (201, "two"), 3: (200, "two"), 4: (200, "two"), 5: (None, "unresolved")}
    assert {r["u"]: r["methods"] for r in cascade.conflicts(facts, "u", sources).collect()} == {1: "one|two", 2: "one|two"}


def test_contracts(spark):
    rows = spark.createDataFrame([(1, "a"), (1, "b"), (2, " ")], "k int, v string")
    with pytest.raises(contracts.ContractError, match="not unique"):
        contracts.require_unique(rows, ["k"], "rows")
    with pytest.raises(contracts.ContractError, match="blank"):
        contracts.require_present(rows, ["v"], "rows")
    got = contracts.violations(rows, {"positive": F.col("k") > 1, "named": F.trim("v") != ""})
    assert {tuple(r) for r in got.collect()} == {("positive", 2), ("named", 1)}


def test_fingerprint_does_not_depend_on_order(spark):
    rows = [(i % 3, i, i * 7) for i in range(50)]
    a, b = (spark.createDataFrame(r, "k int, u int, t int") for r in (rows, rows[::-1]))
    assert sorted(aggregate.fingerprint(a, "k", "u", "t").collect()) == sorted(aggregate.fingerprint(b.repartition(5), "k", "u", "t").collect())


def test_empty_inputs_keep_their_columns(spark):
    empty = spark.createDataFrame([], "area int, party string, n long")
    assert ranking.winners(empty, ["area"], "party", "n").columns[-1] == "winner_share"
    assert ranking.winners(empty, ["area"], "party", "n").count() == 0
    assert reshape.to_wide(empty, ["area"], "party", "n", ["a", "b"]).columns == ["area", "a", "b"]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 12), st.integers(0, 12)), min_size=1, max_size=14))
def test_components_equal_union_find(spark, pairs):
    root = {x: x for p in pairs for x in p if p[0] != p[1]}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        if a != b:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    got = graph.components(spark.createDataFrame(pairs, "a long, b long"))
    assert {r["node"]: r["component"] for r in got.collect()} == {x: find(x) for x in root}


@given(st.lists(st.tuples(st.integers(0, 4), st.integers(0, 3)), min_size=1, max_size=6), st.integers(1, 3), st.data())
@settings(max_examples=150, deadline=None)
def test_partition_equals_brute_force(rows, areas, data):
    split = data.draw(st.lists(st.integers(0, areas - 1), min_size=len(rows), max_size=len(rows)))
    goals = [(sum(s == a for s in split), sum(r[0] for r, s in zip(rows, split) if s == a), sum(r[1] for r, s in zip(rows, split) if s == a)) for a in range(areas)]
    found = [c for c in product(range(areas), repeat=len(rows)) if all(goals[a] == (c.count(a), sum(r[0] for r, s in zip(rows, c) if s == a), sum(r[1] for r, s in zip(rows, c) if s == a)) for a in range(areas))]
    outcome, chosen = partition.solve(rows, goals)
    assert (outcome == "unique") == (len(found) == 1)
    assert (outcome == "several") == (len(found) > 1)
    if chosen is not None:
        assert tuple(chosen) == found[0]


def test_partition_limit_and_no_solution():
    assert partition.solve([(1,), (2,)], [(1, 2), (1, 2)])[0] == "none"
    assert partition.solve([(i,) for i in range(12)], [(6, 33), (6, 33)], most_states=3)[0] == "limit"


def test_exact_partition_query(spark, sf_dir):
    from canvass.plans.evidence import exact_partition

    got = exact_partition(spark, sf_dir).collect()
    orders = {r["o_orderkey"]: r["q"] for r in spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", F.quarter("o_orderdate").alias("q")).collect()}
    assert got and all(r["outcome"] in ("unique", "several") for r in got)
    assert all(r["area"] == orders[r["uid"]] for r in got if r["outcome"] == "unique")


def _paths(n):
    falling, mixed = [0, *range(n, 0, -1)], list(range(n))
    random.Random(n).shuffle(mixed)
    return [list(zip(x, x[1:])) for x in (falling, mixed)]


@pytest.mark.parametrize("n", [50, 800])
def test_components_take_logarithmic_rounds(spark, n):
    for links in _paths(n):
        df = spark.createDataFrame(links, "a long, b long")
        assert len(graph.contractions(df)) <= 2 * math.log2(n)
        assert {r["component"] for r in graph.components(df).collect()} == {0}


def test_components_with_shuffles_and_hubs(spark, monkeypatch):
    for module in (graph, skew):
        monkeypatch.setattr(module, "SMALL_ROWS", 0)
    monkeypatch.setattr(skew.spread_join.__globals__["small"], "__defaults__", (0,))
    links = [(5000, i) for i in range(300)] + [(i, i + 1) for i in range(6000, 6050)] + [(7001, 7002), (7002, 7001), (None, 3), (8, None), (9001, 9001)]
    got = {r["node"]: r["component"] for r in graph.components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = {i: 0 for i in [*range(300), 5000]} | {i: 6000 for i in range(6000, 6051)} | {7001: 7001, 7002: 7001}
    assert got == want


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
def test_spread_join_equals_join(spark, how):
    rows = storage.saved(spark.createDataFrame([(7 if i % 3 else i, i) for i in range(3000)] + [(None, -1)], "k int, i int"), "rows")
    table = storage.saved(spark.createDataFrame([(i, f"v{i}") for i in range(0, 900, 7)], "k int, v string"), "table")
    want = rows.join(table, "k", how)
    got = skew.spread_join(rows, table, "k", how, known_small=False)
    assert got.columns == want.columns and got.exceptAll(want).count() == want.exceptAll(got).count() == 0 and got.count() > 0


def test_shared_folder_is_required_on_a_cluster(monkeypatch):
    class Context:
        master, applicationId = "spark://host:7077", "app"

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda key, default=None: default)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        storage.shared_dir(Session())


def test_discarded_tables_are_gone(spark):
    table = storage.saved(spark.range(3).toDF("i"), "gone")
    folder = table.saved_at.removeprefix("file://")
    assert os.path.isdir(folder)
    storage.discard(table, spark.range(1))
    assert not os.path.exists(folder)


def test_reviews_hold_only_while_nothing_changes(spark):
    groups = spark.createDataFrame([(1, 2, 10, "f"), (2, 2, 10, "f"), (3, 1, 1, "g")], "k int, n_rows long, total long, fingerprint string")
    made = "k int, decision string, reviewed_rows long, reviewed_total long, reviewed_fingerprint string"
    good = spark.createDataFrame([(1, "approved", 2, 10, "f"), (2, "rejected", 9, 9, "x")], made)
    got = {r["k"]: (r["decision"], r["drift"], r["applies"]) for r in reviews.require_current(groups, good, ["k"]).collect()}
    assert got == {1: ("approved", "none", True), 2: ("rejected", "rows", False), 3: ("pending", "none", False)}
    for bad in ([(1, "approved", 2, 10, "other")], [(9, "approved", 1, 1, "f")], [(1, "maybe", 2, 10, "f")], [(1, "approved", 2, 10, "f")] * 2):
        with pytest.raises(contracts.ContractError):
            reviews.require_current(groups, spark.createDataFrame(bad, made), ["k"])


def test_line_fingerprint_is_the_hash_of_sorted_lines(spark):
    import hashlib

    rows = spark.createDataFrame([("b", "2"), ("a", "1"), ("c", None)], "u string, t string")
    assert rows.agg(reviews.line_fingerprint("u", "t")).first()[0] == hashlib.sha256(b"a|1\nb|2\nc|").hexdigest()


def test_rules_and_one_to_one_joins_fail_the_job(spark):
    rows = spark.createDataFrame([(1, 2), (1, 3)], "k int, v int")
    assert contracts.require_rules(rows, {"v": F.col("v") > 1}) is rows
    with pytest.raises(contracts.ContractError, match="rules are broken"):
        contracts.require_rules(rows, {"v": F.col("v") > 2})
    one = spark.createDataFrame([(1, "a")], "k int, w string")
    assert contracts.joined(rows, one, ["k"]).count() == 2
    with pytest.raises(contracts.ContractError, match="not unique"):
        contracts.joined(rows, one, ["k"], validate="one_to_one")


def test_overlapping_boxes_of_very_unlike_sizes(spark):
    from canvass.operators import geometry

    rng = random.Random(4)
    boxes = [(i, (x := rng.uniform(-50, 50)), (y := rng.uniform(-50, 50)), x + w, y + w) for i in range(120) for w in [rng.choice([0.1, 0.5, 3, 40, 5000])]]
    rows = [(i, (a, b, c, d)) for i, a, b, c, d in boxes]
    df = spark.createDataFrame(rows, "id int, box struct<min_x:double,min_y:double,max_x:double,max_y:double>")
    want = {(p[0], q[0]) for p in boxes for q in boxes if p[0] < q[0] and max(p[1], q[1]) < min(p[3], q[3]) and max(p[2], q[2]) < min(p[4], q[4])}
    assert sorted(map(tuple, geometry.overlapping(df, "id", "box", 1.0).collect())) == sorted(want)


def test_cascade_counts_a_repeated_answer_once_and_refuses_two(spark):
    facts = spark.createDataFrame([(1, 10), (2, 20), (3, 30)], "uid long, v int")
    twice = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (2, "b")], "uid long, target string")
    last = spark.createDataFrame([(1, "z"), (3, "z")], "uid long, target string")
    sources = [cascade.Evidence("one", twice, "direct", "high"), cascade.Evidence("two", last, "fallback", "low")]
    assert sorted((r["uid"], r["v"], r["target"], r["method"]) for r in cascade.resolve(facts, "uid", sources).collect()) == [(1, 10, "a", "one"), (2, 20, "b", "one"), (3, 30, "z", "two")]
    several = cascade.Evidence("three", spark.createDataFrame([(1, "a"), (1, "c")], "uid long, target string"), "direct", "high")
    with pytest.raises(Exception, match="three gives two targets for 1"):
        cascade.resolve(facts, "uid", [several]).collect()


def test_a_cascade_joins_its_facts_once_for_all_sources(spark):
    facts = spark.range(20).withColumnRenamed("id", "u")
    sources = [cascade.Evidence(f"m{i}", spark.range(20).where(f"id % {i + 2} = 0").select("id", (F.col("id") * 10 + i).alias("t")), "c", "high", guard=F.col("u") > i) for i in range(8)]
    found = cascade.resolve(facts, "u", sources)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1
    want = {u: next((u * 10 + i for i in range(8) if u % (i + 2) == 0 and u > i), None) for u in range(20)}
    assert {r["u"]: r["target"] for r in found.collect()} == want


def test_conflicts_gather_no_lists(spark):
    facts = spark.range(4).withColumnRenamed("id", "u")
    rows = lambda *r: spark.createDataFrame(list(r), "u long, t long")
    sources = [cascade.Evidence("one", rows((1, 5), (1, 5), (2, 7), (3, 1)), "c", "high"), cascade.Evidence("two", rows((1, 6), (2, 7), (3, None), (9, 1)), "c", "high"), cascade.Evidence("three", rows((3, 2), (9, 2)), "c", "high")]
    found = cascade.conflicts(facts, "u", sources)
    assert "collect_set" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert {tuple(r) for r in found.collect()} == {(1, 2, "one|two"), (3, 2, "one|two|three")}
