"""Lookups: joins by contract, fallbacks, ranges, probes, aliases, set tests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import contracts, lookup
from ._tables import Catalog, cents, table

catalog = Catalog()


@catalog.query("SELECT c_custkey, c_nationkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 350000)")
def unmapped_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").where("o_totalprice > 350000").select("o_custkey")
    return table(spark, sf_dir, "customer").join(orders, F.col("o_custkey") == F.col("c_custkey"), "left_anti").select("c_custkey", "c_nationkey")


@catalog.query("SELECT l_partkey, count(*) AS n_rows FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 10) GROUP BY 1")
def fk_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").where("p_size > 10").select("p_partkey")
    return contracts.orphans(table(spark, sf_dir, "lineitem"), "l_partkey", parts, "p_partkey")


@catalog.query("SELECT c_custkey, c_mktsegment FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 400000)")
def semi_membership(spark: SparkSession, sf_dir: str) -> DataFrame:
    big = table(spark, sf_dir, "orders").where("o_totalprice > 400000").select("o_custkey")
    return table(spark, sf_dir, "customer").join(big, F.col("o_custkey") == F.col("c_custkey"), "left_semi").select("c_custkey", "c_mktsegment")


@catalog.query("""WITH c AS (SELECT c_nationkey AS k, count(*) AS n_customers FROM customer WHERE c_acctbal > 9000 GROUP BY 1), s AS (SELECT s_nationkey AS k, count(*) AS n_suppliers FROM supplier WHERE s_acctbal > 3000 GROUP BY 1)
SELECT coalesce(c.k, s.k) AS k, n_customers, n_suppliers, CASE WHEN s.k IS NULL THEN 'left_only' WHEN c.k IS NULL THEN 'right_only' ELSE 'both' END AS side FROM c FULL JOIN s ON c.k = s.k""")
def full_outer_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").where("c_acctbal > 9000").groupBy(F.col("c_nationkey").alias("k")).agg(F.count("*").alias("n_customers"))
    s = table(spark, sf_dir, "supplier").where("s_acctbal > 3000").groupBy(F.col("s_nationkey").alias("k")).agg(F.count("*").alias("n_suppliers"))
    return lookup.indicated_join(c, s, ["k"])


@catalog.query("""SELECT o_orderkey, o_custkey, c_mktsegment FROM orders LEFT JOIN customer ON o_custkey = c_custkey""")
def many_to_one_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    return contracts.joined(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), customer, ["o_custkey"])


@catalog.query("""SELECT o_orderkey, l_linenumber, l_partkey, count(*) AS n FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE l_shipdate BETWEEN o_orderdate AND o_orderdate + INTERVAL 30 DAY GROUP BY ALL""")
def range_rule_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderdate").alias("low"), (F.col("o_orderdate") + F.expr("INTERVAL 30 DAY")).alias("high"))
    hits = lookup.range_rules(table(spark, sf_dir, "lineitem"), rules, ["l_orderkey"], "l_shipdate", "low", "high")
    return hits.groupBy(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_partkey").agg(F.count("*").alias("n"))


@catalog.query("""WITH r AS (SELECT p_partkey % 50 AS k, p_partkey AS rule, p_partkey // 50 * 4000 + p_partkey % 5 AS low, p_partkey // 50 * 4000 + p_partkey % 5 + CASE WHEN p_partkey % 4 = 0 THEN p_size * 70 ELSE p_size % 3 * 600 END AS high FROM part)
SELECT o_orderkey, rule FROM orders LEFT JOIN r ON o_custkey % 50 = k AND o_orderkey * 37 % 160000 BETWEEN low AND high""")
def range_lookup_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The one rule of a key whose range holds the value; null where none does, an error where several do."""
    p = F.col("p_partkey")
    low = F.floor(p / 50) * 4000 + p % 5
    rules = table(spark, sf_dir, "part").select((p % 50).alias("k"), p.alias("rule"), low.alias("low"), (low + F.when(p % 4 == 0, F.col("p_size") * 70).otherwise(F.col("p_size") % 3 * 600)).alias("high"))
    facts = table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_custkey") % 50).alias("k"), (F.col("o_orderkey") * 37 % 160000).alias("value"))
    return lookup.range_lookup(facts, "o_orderkey", "value", rules, ["k"], "low", "high", "rule").select("o_orderkey", "rule")


@catalog.query("""WITH r AS (SELECT o_custkey, o_orderkey, epoch(o_orderdate)::BIGINT // 86400 AS low, epoch(o_orderdate)::BIGINT // 86400 + 20 AS high FROM orders),
w AS (SELECT *, max(high) OVER (PARTITION BY o_custkey ORDER BY low, high, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM r)
SELECT o_custkey, count(*) AS n_overlaps FROM w WHERE before >= low GROUP BY 1""")
def range_overlap_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.unix_date(F.to_date("o_orderdate")).cast("bigint")
    rules = table(spark, sf_dir, "orders").select("o_custkey", day.alias("low"), (day + 20).alias("high"))
    return lookup.overlaps(rules, ["o_custkey"], "low", "high").groupBy("o_custkey").agg(F.count("*").alias("n_overlaps"))


@catalog.query("""WITH a AS (SELECT o_custkey, min(o_orderkey) AS t FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 450000 GROUP BY 1), b AS (SELECT c_nationkey, min(c_custkey) AS t FROM customer WHERE c_acctbal > 9900 GROUP BY 1)
SELECT c.c_custkey, coalesce(a.t, b.t) AS target, CASE WHEN a.t IS NOT NULL THEN 'own' WHEN b.t IS NOT NULL THEN 'nation' END AS lookup
FROM customer c LEFT JOIN a ON a.o_custkey = c.c_custkey LEFT JOIN b ON b.c_nationkey = c.c_nationkey""")
def fallback_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = table(spark, sf_dir, "orders").where("o_orderstatus = 'F' and o_totalprice > 450000").groupBy("o_custkey").agg(F.min("o_orderkey").alias("t"))
    nation = table(spark, sf_dir, "customer").where("c_acctbal > 9900").groupBy("c_nationkey").agg(F.min("c_custkey").alias("t"))
    facts = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return lookup.first_hit(facts, [("own", own, "c_custkey", "t"), ("nation", nation, "c_nationkey", "t")], "target").select("c_custkey", "target", "lookup")


@catalog.query("""WITH i AS (SELECT p_partkey, p_brand FROM part WHERE p_size BETWEEN 10 AND 20),
c AS (SELECT s_suppkey, unnest([s_suppkey * 7 % 100, s_suppkey * 3 % 100, s_suppkey % 100]) AS k, unnest([0, 1, 2]) AS place FROM supplier),
h AS (SELECT s_suppkey, p_brand, place, row_number() OVER (PARTITION BY s_suppkey ORDER BY place) AS r FROM c JOIN i ON k = p_partkey)
SELECT s.s_suppkey, h.p_brand, h.place FROM supplier s LEFT JOIN h ON h.s_suppkey = s.s_suppkey AND r = 1""")
def candidate_probe(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = table(spark, sf_dir, "part").where("p_size between 10 and 20").select("p_partkey", "p_brand")
    k = F.col("s_suppkey")
    return lookup.probe(table(spark, sf_dir, "supplier"), F.array(k * 7 % 100, k * 3 % 100, k % 100), index, "p_partkey", "p_brand", "s_suppkey")


@catalog.query("SELECT l_orderkey, min(l_suppkey) AS l_suppkey FROM lineitem GROUP BY 1 HAVING min(l_suppkey) = max(l_suppkey)")
def unique_guarded_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookup.unique_index(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_suppkey")


@catalog.query("SELECT s_nationkey, min(s_suppkey) AS s_suppkey FROM supplier GROUP BY 1 HAVING count(*) = 1")
def singleton_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookup.singleton_index(table(spark, sf_dir, "supplier"), "s_nationkey", "s_suppkey")


@catalog.query("""WITH a AS (SELECT s_suppkey AS f, min(s_suppkey) OVER (PARTITION BY s_nationkey) AS t FROM supplier WHERE s_acctbal > 0)
SELECT coalesce(t, l_suppkey) AS l_suppkey, count(*) AS n FROM lineitem LEFT JOIN a ON l_suppkey = f GROUP BY 1""")
def alias_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    suppliers = table(spark, sf_dir, "supplier").where("s_acctbal > 0")
    first = suppliers.groupBy("s_nationkey").agg(F.min("s_suppkey").alias("canonical"))
    aliases = suppliers.join(first, "s_nationkey").select("s_suppkey", "canonical")
    return lookup.resolve_alias(table(spark, sf_dir, "lineitem").select("l_suppkey"), "l_suppkey", aliases, "s_suppkey", "canonical").groupBy("l_suppkey").agg(F.count("*").alias("n"))


@catalog.query("""SELECT p_brand, CASE WHEN count(*) FILTER (p_size > 45) = 1 THEN min(p_partkey) FILTER (p_size > 45) WHEN count(*) FILTER (p_size > 45) = 0 AND count(*) = 1 THEN min(p_partkey) END AS p_partkey,
CASE WHEN count(*) FILTER (p_size > 45) = 1 THEN 'flagged' WHEN count(*) FILTER (p_size > 45) = 0 AND count(*) = 1 THEN 'only' ELSE 'ambiguous' END AS reason FROM part GROUP BY 1""")
def preferred_candidate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookup.preferred(table(spark, sf_dir, "part"), "p_brand", "p_partkey", F.col("p_size") > 45)


@catalog.query("""SELECT k, CASE WHEN side_l AND NOT side_r THEN 'missing' ELSE 'extra' END AS side FROM (SELECT coalesce(a.k, b.k) AS k, a.k IS NOT NULL AS side_l, b.k IS NOT NULL AS side_r FROM (SELECT DISTINCT o_custkey AS k FROM orders) a FULL JOIN (SELECT DISTINCT user_id AS k FROM events) b ON a.k = b.k) WHERE NOT (side_l AND side_r)""")
def set_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contracts.set_difference(table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k")), table(spark, sf_dir, "events").select(F.col("user_id").alias("k")), "k")


@catalog.query("""WITH o AS (SELECT o_orderkey, unnest([o_custkey % 5, o_custkey % 3, o_custkey % 5]) AS k FROM orders), d AS (SELECT DISTINCT * FROM o)
SELECT r_name, count(*) AS n FROM d JOIN region ON k = r_regionkey GROUP BY 1""")
def exploded_key_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..functions.normalize import pipe_list

    c = F.col("o_custkey")
    keys = pipe_list(F.concat_ws("|", c % 5, c % 3, c % 5))
    rows = table(spark, sf_dir, "orders").select(F.explode(keys).alias("k")).select(F.col("k").cast("int").alias("r_regionkey"))
    return rows.join(table(spark, sf_dir, "region"), "r_regionkey").groupBy("r_name").agg(F.count("*").alias("n"))


@catalog.query("""WITH e AS (SELECT o_custkey % 50 AS rule, count(*) AS matched FROM orders WHERE o_totalprice > 250000 GROUP BY 1), x AS (SELECT c_custkey % 50 AS rule, count(*) AS expected FROM customer GROUP BY 1)
SELECT coalesce(e.rule, x.rule) AS rule, coalesce(expected, 0) AS expected, coalesce(matched, 0) AS matched, coalesce(expected, 0) = coalesce(matched, 0) AS holds FROM e FULL JOIN x ON e.rule = x.rule""")
def range_rule_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = table(spark, sf_dir, "orders").where("o_totalprice > 250000").groupBy((F.col("o_custkey") % 50).alias("rule")).agg(F.count("*").alias("matched"))
    due = table(spark, sf_dir, "customer").groupBy((F.col("c_custkey") % 50).alias("rule")).agg(F.count("*").alias("expected"))
    both = lookup.indicated_join(got, due, ["rule"]).na.fill(0, ["expected", "matched"])
    return both.select("rule", "expected", "matched", (F.col("expected") == F.col("matched")).alias("holds"))


@catalog.query("""WITH t AS (SELECT l_suppkey AS s, l_partkey % 40 AS t FROM lineitem WHERE l_quantity > 45), f AS (SELECT s, count(DISTINCT t) AS n_forward, min(t) AS t FROM t GROUP BY 1), r AS (SELECT t, count(DISTINCT s) AS n_back FROM t GROUP BY 1)
SELECT s, n_forward, f.t, n_back, CASE WHEN n_forward > 1 THEN 'conflict' WHEN n_back > 1 THEN 'merged' ELSE 'one_to_one' END AS status FROM f JOIN r ON f.t = r.t""")
def transition_bridge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many-to-many bridge: unique targets forward, unique sources back."""
    links = table(spark, sf_dir, "lineitem").where("l_quantity > 45").select(F.col("l_suppkey").alias("s"), (F.col("l_partkey") % 40).alias("t"))
    forward = links.groupBy("s").agg(F.countDistinct("t").alias("n_forward"), F.min("t").alias("t"))
    back = links.groupBy("t").agg(F.countDistinct("s").alias("n_back"))
    status = F.when(F.col("n_forward") > 1, "conflict").when(F.col("n_back") > 1, "merged").otherwise("one_to_one")
    return forward.join(back, "t").select("s", "n_forward", "t", "n_back", status.alias("status"))


@catalog.query("""WITH q AS (SELECT o_orderkey, o_custkey, CAST(round(o_totalprice*100) AS BIGINT) AS cents, CASE o_orderstatus WHEN 'F' THEN 1995 WHEN 'O' THEN 2008 ELSE 2011 END AS vintage FROM orders)
SELECT vintage, n_regionkey AS region, count(*) AS n_rows, CAST(sum(cents) AS BIGINT) AS cents FROM q JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2""")
def vintage_expansion(spark: SparkSession, sf_dir: str) -> DataFrame:
    vintages = spark.createDataFrame([("F", 1995), ("O", 2008), ("P", 2011)], "o_orderstatus string, vintage int")
    rows = table(spark, sf_dir, "orders").join(vintages, "o_orderstatus").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return rows.groupBy("vintage", F.col("n_regionkey").alias("region")).agg(F.count("*").alias("n_rows"), F.sum(cents("o_totalprice")).alias("cents"))
