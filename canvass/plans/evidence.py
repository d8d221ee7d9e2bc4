"""Evidence: the precedence cascade, its summaries, gates, gap reasons, components and exact partitions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import cascade, contracts, graph, partition
from ..storage import saved
from ._tables import FACTS, Catalog, cents, facts, table

catalog = Catalog()

_SOURCES = """
e1 AS (SELECT l_orderkey AS u, min(l_suppkey) AS t FROM lineitem WHERE l_quantity > 48 GROUP BY 1 HAVING count(*) = 1),
e2 AS (SELECT l_orderkey AS u, min(l_suppkey) AS t FROM lineitem GROUP BY 1 HAVING min(l_suppkey) = max(l_suppkey)),
e3 AS (SELECT o_orderkey AS u, s.t FROM orders JOIN (SELECT user_id, max(event_id) AS t FROM events WHERE event_type = 'purchase' GROUP BY 1) s ON o_custkey = user_id),
e4 AS (SELECT o_orderkey AS u, o_custkey AS t FROM orders WHERE o_totalprice > 300000)"""

_CASCADE = f"""WITH {_SOURCES}
SELECT o_orderkey, o_orderstatus, CASE WHEN e1.t IS NOT NULL THEN e1.t WHEN e2.t IS NOT NULL THEN e2.t WHEN e3.t IS NOT NULL AND o_orderstatus = 'O' THEN e3.t WHEN e4.t IS NOT NULL THEN e4.t END AS target,
CASE WHEN e1.t IS NOT NULL THEN 'reviewed_override' WHEN e2.t IS NOT NULL THEN 'direct_crosswalk' WHEN e3.t IS NOT NULL AND o_orderstatus = 'O' THEN 'stable_link' WHEN e4.t IS NOT NULL THEN 'single_area' ELSE 'unresolved' END AS method,
CASE WHEN e1.t IS NOT NULL THEN 'reviewed' WHEN e2.t IS NOT NULL THEN 'direct' WHEN e3.t IS NOT NULL AND o_orderstatus = 'O' THEN 'inferred' WHEN e4.t IS NOT NULL THEN 'fallback' ELSE 'unresolved' END AS evidence_class,
CASE WHEN e1.t IS NOT NULL OR e2.t IS NOT NULL THEN 'high' WHEN e3.t IS NOT NULL AND o_orderstatus = 'O' THEN 'moderate' WHEN e4.t IS NOT NULL THEN 'moderate' ELSE 'none' END AS confidence,
(e1.t IS NULL AND e2.t IS NULL AND NOT (e3.t IS NOT NULL AND o_orderstatus = 'O') AND e4.t IS NOT NULL) AS synthetic
FROM orders LEFT JOIN e1 ON e1.u = o_orderkey LEFT JOIN e2 ON e2.u = o_orderkey LEFT JOIN e3 ON e3.u = o_orderkey LEFT JOIN e4 ON e4.u = o_orderkey"""


def _sources(spark: SparkSession, sf_dir: str) -> list[cascade.Evidence]:
    lines, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    reviewed = lines.where("l_quantity > 48").groupBy("l_orderkey").agg(F.count("*").alias("_n"), F.min("l_suppkey").alias("t")).where("_n = 1").select("l_orderkey", "t")
    direct = lines.groupBy("l_orderkey").agg(F.min("l_suppkey").alias("t"), F.max("l_suppkey").alias("_m")).where("t = _m").select("l_orderkey", "t")
    users = table(spark, sf_dir, "events").where("event_type = 'purchase'").groupBy("user_id").agg(F.max("event_id").alias("t"))
    stable = orders.join(users, F.col("o_custkey") == F.col("user_id")).select("o_orderkey", "t")
    single = orders.where("o_totalprice > 300000").select("o_orderkey", F.col("o_custkey").alias("t"))
    return [
        cascade.Evidence("reviewed_override", reviewed, "reviewed", "high"),
        cascade.Evidence("direct_crosswalk", direct, "direct", "high"),
        cascade.Evidence("stable_link", stable, "inferred", "moderate", guard=F.col("o_orderstatus") == "O"),
        cascade.Evidence("single_area", single, "fallback", "moderate", synthetic=True),
    ]


def resolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cascade.resolve(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus"), "o_orderkey", _sources(spark, sf_dir))


@catalog.query(_CASCADE)
def evidence_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolved(spark, sf_dir)


@catalog.query(f"WITH c AS ({_CASCADE}) SELECT o_orderstatus, method, evidence_class, count(*) AS n_rows, count(*) FILTER (synthetic) AS n_synthetic, count(DISTINCT target) AS n_targets FROM c GROUP BY 1, 2, 3")
def cascade_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolved(spark, sf_dir).groupBy("o_orderstatus", "method", "evidence_class").agg(F.count("*").alias("n_rows"), F.count_if("synthetic").alias("n_synthetic"), F.countDistinct("target").alias("n_targets"))


@catalog.query(f"""WITH {_SOURCES}, a AS (SELECT u, t, 0 AS p, 'reviewed_override' AS m FROM e1 UNION ALL SELECT u, t, 1, 'direct_crosswalk' FROM e2 UNION ALL SELECT u, t, 2, 'stable_link' FROM e3 UNION ALL SELECT u, t, 3, 'single_area' FROM e4)
SELECT u AS o_orderkey, count(DISTINCT t) AS n_targets, string_agg(m, '|' ORDER BY p) AS methods FROM a WHERE u IN (SELECT o_orderkey FROM orders) GROUP BY 1 HAVING count(DISTINCT t) > 1""")
def evidence_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cascade.conflicts(table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey", _sources(spark, sf_dir))


@catalog.query("""SELECT event_id, CASE WHEN event_type = 'error' THEN 'excluded_kind' WHEN value < 1 THEN 'below_threshold' WHEN user_id NOT IN (SELECT o_custkey FROM orders) THEN 'unknown_entity' WHEN CAST(json_extract_string(props, '$.k') AS BIGINT) > 90 THEN 'outlier' ELSE 'no_direct_evidence' END AS reason FROM events""")
def gap_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("user_id")).distinct().withColumn("known", F.lit(True))
    k = F.get_json_object("props", "$.k").cast("bigint")
    reason = F.when(F.col("event_type") == "error", "excluded_kind").when(F.col("value") < 1, "below_threshold").when(F.col("known").isNull(), "unknown_entity").when(k > 90, "outlier").otherwise("no_direct_evidence")
    return table(spark, sf_dir, "events").join(known, "user_id", "left").select("event_id", reason.alias("reason"))


@catalog.query("""SELECT l_returnflag, count(*) AS comparisons, count(*) FILTER (s_nationkey % 5 = c_nationkey % 5 OR l_quantity > 3) AS agreements,
count(*) >= 100 AND count(*) FILTER (s_nationkey % 5 = c_nationkey % 5 OR l_quantity > 3) >= 0.95 * count(*) AS accepted
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey GROUP BY 1""")
def validation_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = lambda name: table(spark, sf_dir, name)
    rows = t("lineitem").join(t("supplier"), F.col("l_suppkey") == F.col("s_suppkey")).join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey")).join(t("customer"), F.col("o_custkey") == F.col("c_custkey"))
    agrees = (F.col("s_nationkey") % 5 == F.col("c_nationkey") % 5) | (F.col("l_quantity") > 3)
    return contracts.agreement_gate(rows, agrees, ["l_returnflag"], 100, 0.95)


_RUNS = """s AS (SELECT *, CASE WHEN o_orderstatus = lag(o_orderstatus) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) THEN 0 ELSE 1 END AS new FROM orders),
r AS (SELECT *, sum(new) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS run FROM s),
c AS (SELECT o_orderkey AS node, min(o_orderkey) OVER g AS component, count(*) OVER g AS n FROM r WINDOW g AS (PARTITION BY o_custkey, run))"""


def _links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stable links: an order and the customer's order before it, if their status agrees."""
    before = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("b"), "o_orderstatus", F.lag("o_orderkey").over(before).alias("a"), F.lag("o_orderstatus").over(before).alias("_status"))
    return rows.where("o_orderstatus = _status").select("a", "b")


@catalog.query(f"WITH {_RUNS} SELECT node, component FROM c WHERE n > 1")
def components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.components(_links(spark, sf_dir))


@catalog.query(f"""WITH {_RUNS}, k AS (SELECT node, component, CASE WHEN node % 6 = 0 THEN node % 4 END AS known FROM c WHERE n > 1),
v AS (SELECT component, min(known) AS lo, max(known) AS hi FROM k GROUP BY 1)
SELECT node, component, CASE WHEN known IS NOT NULL THEN known WHEN lo = hi THEN lo END AS label, CASE WHEN lo IS NULL THEN 'unknown' WHEN lo <> hi THEN 'conflict' WHEN known IS NOT NULL THEN 'known' ELSE 'adopted' END AS status FROM k JOIN v USING (component)""")
def propagate_consensus(spark: SparkSession, sf_dir: str) -> DataFrame:
    members = graph.components(_links(spark, sf_dir)).withColumn("known", F.when(F.col("node") % 6 == 0, F.col("node") % 4))
    return graph.consensus(members, "node", "component", "known")


@catalog.query("""WITH f AS (SELECT o_custkey, bool_or(o_orderstatus = 'F') AS f1, bool_or(o_orderstatus = 'O') AS f2 FROM orders GROUP BY 1)
SELECT o_custkey, 'A' AS root_A, CASE WHEN f1 THEN 'A' ELSE 'B' END AS root_B, CASE WHEN f2 THEN CASE WHEN f1 THEN 'A' ELSE 'B' END ELSE 'C' END AS root_C FROM f""")
def tree_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    flags = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.bool_or(F.col("o_orderstatus") == "F").alias("f1"), F.bool_or(F.col("o_orderstatus") == "O").alias("f2"))
    return graph.chain_root(flags, ["A", "B", "C"], {"B": ("A", "f1"), "C": ("B", "f2")}).drop("f1", "f2")


@catalog.query()
def exact_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer's orders of a year dealt back to quarters from quarterly totals; tested against brute force."""
    year = F.col("o_custkey") * 10_000 + F.year("o_orderdate")
    rows = table(spark, sf_dir, "orders").select(year.alias("grp"), "o_orderkey", cents("o_totalprice").alias("cents"), (F.col("o_orderkey") % 7).alias("m"), F.quarter("o_orderdate").alias("area"))
    areas = rows.groupBy("grp", "area").agg(F.count("*").alias("n"), F.sum("cents").alias("cents"), F.sum("m").alias("m"))
    return partition.exact_partition(rows, areas, "grp", "o_orderkey", "area", ["cents", "m"])


@catalog.query("""SELECT count(*) AS n_rows, count(DISTINCT o_custkey * 10000 + year(o_orderdate)) AS n_groups, 0 AS wrong_areas, 0 AS wrong_outcomes, count(*) FILTER (n = 1) AS alone FROM (SELECT *, count(*) OVER (PARTITION BY o_custkey, year(o_orderdate)) AS n FROM orders)""")
def partition_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What must hold of every partition: no row is lost, areas of solved groups get their totals, others get no area."""
    year = F.col("o_custkey") * 10_000 + F.year("o_orderdate")
    rows = table(spark, sf_dir, "orders").select(year.alias("grp"), F.col("o_orderkey").alias("uid"), cents("o_totalprice").alias("cents"), F.quarter("o_orderdate").alias("quarter"))
    solved = saved(exact_partition(spark, sf_dir), "partition")
    sums = [F.count("*").alias("n"), F.sum("cents").alias("cents")]
    dealt = solved.where("outcome = 'unique'").join(rows, ["grp", "uid"]).groupBy("grp", "area").agg(*sums)
    wanted = rows.join(solved.where("outcome = 'unique'").select("grp").distinct(), "grp", "left_semi").groupBy("grp", F.col("quarter").alias("area")).agg(*sums)
    wrong = dealt.exceptAll(wanted.select(*dealt.columns)).agg(F.count("*").cast("int").alias("wrong_areas"))
    groups = solved.groupBy("grp").agg(F.count("*").alias("n"), F.count("area").alias("given"), F.min("outcome").alias("low"), F.max("outcome").alias("high"))
    odd = (F.col("low") != F.col("high")) | (F.col("given") != F.when(F.col("low") == "unique", F.col("n")).otherwise(0)) | ((F.col("n") == 1) & (F.col("low") != "unique"))
    totals = groups.agg(F.sum("n").alias("n_rows"), F.count("*").alias("n_groups"), F.count_if(odd).cast("int").alias("wrong_outcomes"), F.count_if(F.col("n") == 1).alias("alone"))
    return totals.join(F.broadcast(wrong)).select("n_rows", "n_groups", "wrong_areas", "wrong_outcomes", "alone")  # a row each


@catalog.query(f"""WITH {FACTS}, k AS (SELECT area, election, count(*) AS n FROM facts GROUP BY ALL)
SELECT area, election, CASE WHEN n >= 250 THEN 'A' WHEN n >= 190 THEN 'B' ELSE 'C' END AS tier, n FROM k""")
def evidence_tier(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = facts(spark, sf_dir).groupBy("area", "election").agg(F.count("*").alias("n"))
    return got.select("area", "election", F.when(F.col("n") >= 250, "A").when(F.col("n") >= 190, "B").otherwise("C").alias("tier"), "n")
