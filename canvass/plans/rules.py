"""Reviewed rules: crosswalks, alias chains, composites, classifiers, derived and missing values."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.nested import bounds, pairs_of, ring_area
from ..operators import lookup
from ._tables import Catalog, cents, table

catalog = Catalog()


@catalog.query("""WITH r AS (SELECT s_suppkey AS o, CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE s_suppkey % 7 END AS code, 'n' || s_nationkey AS name, 'T' || s_suppkey AS target FROM supplier),
f AS (SELECT c_custkey, c_custkey % 7 AS code, 'n' || c_nationkey AS name FROM customer),
a AS (SELECT code, name, arg_max(target, o) AS t FROM r WHERE code IS NOT NULL GROUP BY 1, 2), b AS (SELECT name, arg_min(target, o) AS t FROM r WHERE code IS NULL GROUP BY 1)
SELECT f.*, coalesce(a.t, b.t) AS target, CASE WHEN a.t IS NOT NULL THEN 'code_and_name' WHEN b.t IS NOT NULL THEN 'name' END AS matched FROM f LEFT JOIN a ON a.code = f.code AND a.name = f.name LEFT JOIN b ON b.name = f.name""")
def crosswalk_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey")
    rules = table(spark, sf_dir, "supplier").select(k.alias("o"), F.when(k % 3 != 0, k % 7).alias("code"), F.concat(F.lit("n"), "s_nationkey").alias("name"), F.concat(F.lit("T"), k).alias("target"))
    facts = table(spark, sf_dir, "customer").select("c_custkey", (F.col("c_custkey") % 7).alias("code"), F.concat(F.lit("n"), "c_nationkey").alias("name"))
    return lookup.crosswalk(facts, rules, "code", "name", "target", "o")


@catalog.query("""WITH RECURSIVE a AS (SELECT p_partkey AS s, p_partkey // 3 AS t FROM part WHERE p_size > 10 AND p_partkey <> p_partkey // 3),
w AS (SELECT s, t FROM a UNION ALL SELECT w.s, a.t FROM w JOIN a ON w.t = a.s)
SELECT s, min(t) AS t FROM w GROUP BY 1""")
def alias_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    aliases = table(spark, sf_dir, "part").where("p_size > 10").select(k.alias("s"), F.floor(k / 3).cast("bigint").alias("t")).where("s <> t")
    return lookup.follow_aliases(aliases, "s", "t")


@catalog.query("""WITH r AS (SELECT s_suppkey AS host, CAST((s_suppkey * 3) % 40 AS VARCHAR) AS member, 0 AS place FROM supplier UNION ALL SELECT s_suppkey, CAST((s_suppkey * 7) % 40 AS VARCHAR), 1 FROM supplier WHERE (s_suppkey * 3) % 40 <> (s_suppkey * 7) % 40)
SELECT host, member, place, (SELECT count(DISTINCT host) FROM r x WHERE x.member = r.member) > 1 OR (member <> CAST(host AS VARCHAR) AND member IN (SELECT CAST(s_suppkey AS VARCHAR) FROM supplier)) AS conflict FROM r""")
def host_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey")
    rules = table(spark, sf_dir, "supplier").select(k.alias("host"), F.concat_ws("|", k * 3 % 40, k * 7 % 40).alias("members"))
    return lookup.host_members(rules, "host", "members")


@catalog.query("""SELECT user_id, arg_max(event_type, (CAST(round(value * 100) AS BIGINT), -event_id)) AS best, max(CAST(round(value * 100) AS BIGINT)) AS score FROM events GROUP BY 1""")
def best_candidate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The candidate with the highest score; of equal ones the earliest."""
    score = F.struct(cents("value").alias("score"), (-F.col("event_id")).alias("early"), F.col("event_type").alias("kind"))
    best = table(spark, sf_dir, "events").groupBy("user_id").agg(F.max(score).alias("b"))
    return best.select("user_id", F.col("b.kind").alias("best"), F.col("b.score").alias("score"))


@catalog.query("""WITH w AS (SELECT c_nationkey, min(CASE WHEN c_mktsegment = 'BUILDING' THEN c_custkey END) AS a, min(CASE WHEN c_mktsegment = 'FURNITURE' AND c_acctbal > 5000 THEN c_custkey END) AS b, min(CASE WHEN c_acctbal > 9500 THEN c_custkey END) AS c FROM customer GROUP BY 1)
SELECT c_nationkey, a + b + c AS total, coalesce(a, b, c) AS first_present FROM w""")
def all_or_nothing_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sum that is missing where any of its parts is, unlike an aggregate sum."""
    k, seg, bal = F.col("c_custkey"), F.col("c_mktsegment"), F.col("c_acctbal")
    parts = table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.min(F.when(seg == "BUILDING", k)).alias("a"), F.min(F.when((seg == "FURNITURE") & (bal > 5000), k)).alias("b"), F.min(F.when(bal > 9500, k)).alias("c"))
    return parts.select("c_nationkey", (F.col("a") + F.col("b") + F.col("c")).alias("total"), F.coalesce("a", "b", "c").alias("first_present"))


@catalog.query("""SELECT p_partkey, CASE WHEN p_size > 45 THEN 'water' WHEN p_retailprice > 1050 THEN 'no_population' WHEN p_type IN ('PROMO', 'SMALL') THEN 'special' ELSE 'assignable' END AS status, p_size IN (1, 50) OR p_name LIKE '%ring%' AS envelope FROM part""")
def exclusion_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Masks of which the last that holds wins, as one ordered choice from the last to the first."""
    status = F.when(F.col("p_size") > 45, "water").when(F.col("p_retailprice") > 1050, "no_population").when(F.col("p_type").isin("PROMO", "SMALL"), "special").otherwise("assignable")
    return table(spark, sf_dir, "part").select("p_partkey", status.alias("status"), (F.col("p_size").isin(1, 50) | F.col("p_name").contains("ring")).alias("envelope"))


@catalog.query("""WITH o AS (SELECT o_orderkey, o_custkey % 11 AS actual, o_custkey % 7 AS valid, o_custkey % 2 * 3 AS invalid FROM orders)
SELECT o_orderkey, CASE WHEN invalid = 0 AND actual > 0 AND actual >= valid THEN actual - valid ELSE invalid END AS invalid, coalesce(CASE WHEN o_orderkey % 9 = 0 THEN o_orderkey + 7 END, actual * 10000 + valid) AS code, 'stat2011:' || (actual * 10000 + valid) AS stat_id FROM o""")
def derived_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A missing count from its complement, a combined code unless one is documented, an id from the code."""
    k = F.col("o_custkey")
    rows = table(spark, sf_dir, "orders").select("o_orderkey", (k % 11).alias("actual"), (k % 7).alias("valid"), (k % 2 * 3).alias("bad"))
    derived = F.when((F.col("bad") == 0) & (F.col("actual") > 0) & (F.col("actual") >= F.col("valid")), F.col("actual") - F.col("valid")).otherwise(F.col("bad"))
    code = F.col("actual") * 10000 + F.col("valid")
    documented = F.when(F.col("o_orderkey") % 9 == 0, F.col("o_orderkey") + 7)
    return rows.select("o_orderkey", derived.alias("invalid"), F.coalesce(documented, code).alias("code"), F.concat(F.lit("stat2011:"), code).alias("stat_id"))


@catalog.query("""SELECT k AS name, count(*) AS n_rows FROM (SELECT unnest(json_keys(props)) AS k FROM events) GROUP BY 1""")
def keys_present(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The property names that occur, found from the data."""
    keys = F.explode(F.map_keys(F.from_json("props", "map<string,string>")))
    return table(spark, sf_dir, "events").select(keys.alias("name")).groupBy("name").agg(F.count("*").alias("n_rows"))


@catalog.query("""WITH h AS (SELECT DISTINCT s_nationkey FROM supplier WHERE s_acctbal < 0), d AS (SELECT DISTINCT c_nationkey FROM customer WHERE c_acctbal > 9000)
SELECT n_nationkey, n_nationkey NOT IN (SELECT s_nationkey FROM h) AND n_nationkey IN (SELECT c_nationkey FROM d) AS visible, n_nationkey BETWEEN 5 AND 9 OR n_nationkey IN (12, 20) AS point_like FROM nation""")
def visible_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features that are not hidden and have data; point-like ones by a range of codes."""
    hidden = table(spark, sf_dir, "supplier").where("s_acctbal < 0").select(F.col("s_nationkey").alias("n_nationkey")).distinct().withColumn("_h", F.lit(True))
    data = table(spark, sf_dir, "customer").where("c_acctbal > 9000").select(F.col("c_nationkey").alias("n_nationkey")).distinct().withColumn("_d", F.lit(True))
    rows = table(spark, sf_dir, "nation").join(hidden, "n_nationkey", "left").join(data, "n_nationkey", "left")
    return rows.select("n_nationkey", (F.col("_h").isNull() & F.col("_d").isNotNull()).alias("visible"), (F.col("n_nationkey").between(5, 9) | F.col("n_nationkey").isin(12, 20)).alias("point_like"))


@catalog.query("""WITH p AS (SELECT vec_id, label, list_filter(embedding, lambda x, i: i % 2 = 1) AS xs, list_filter(embedding, lambda x, i: i % 2 = 0) AS ys FROM embeddings)
SELECT label, count(*) AS n_features, min(list_min(xs))::DOUBLE AS min_x, max(list_max(ys))::DOUBLE AS max_y,
round(max(abs(list_sum(list_transform(range(1, len(xs) + 1), lambda i: xs[i]::DOUBLE * ys[i % len(xs) + 1]::DOUBLE - xs[i % len(xs) + 1]::DOUBLE * ys[i]::DOUBLE))) / 2), 4) AS largest FROM p GROUP BY 1""")
def layer_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bounds and largest ring of a layer of features, over all of their points."""
    ring = pairs_of(F.col("embedding"))
    rows = table(spark, sf_dir, "embeddings").select("label", bounds(ring).alias("box"), ring_area(ring).alias("area"))
    return rows.groupBy("label").agg(F.count("*").alias("n_features"), F.min("box.min_x").alias("min_x"), F.max("box.max_y").alias("max_y"), F.round(F.max("area"), 4).alias("largest"))
