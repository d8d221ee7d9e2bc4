"""Audits: row contracts, drift, reviewed decisions, classifiers and builders of assignments."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import aggregate, cascade, contracts, lookup, reviews
from ..operators.skew import spread_join
from ..storage import saved
from ._tables import FACTS, Catalog, cents, facts, table

catalog = Catalog()

# A ballot row for each order: its lines are the voters, returned ones the invalid votes.
_BALLOTS = """ballots AS (SELECT l_orderkey AS uid, count(*) AS actual, count(*) FILTER (l_returnflag <> 'R') AS valid, count(*) FILTER (l_returnflag = 'R' AND l_quantity < 45) AS invalid,
  count(*) FILTER (l_linestatus = 'F' AND l_returnflag <> 'R') AS p_f, count(*) FILTER (l_linestatus = 'O' AND l_quantity < 48 AND l_returnflag <> 'R') AS p_o FROM lineitem GROUP BY 1)"""


def ballots(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag, status, quantity = F.col("l_returnflag"), F.col("l_linestatus"), F.col("l_quantity")
    return table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("uid")).agg(
        F.count("*").alias("actual"), F.count_if(flag != "R").alias("valid"), F.count_if((flag == "R") & (quantity < 45)).alias("invalid"),
        F.count_if((status == "F") & (flag != "R")).alias("p_f"), F.count_if((status == "O") & (quantity < 48) & (flag != "R")).alias("p_o"),
    )


@catalog.query(f"WITH {_BALLOTS} SELECT rule, n_violations FROM (SELECT count(*) FILTER (actual <> valid + invalid) AS totals, count(*) FILTER (valid <> p_f + p_o) AS parties, count(*) FILTER (actual < valid) AS monotone FROM ballots) UNPIVOT (n_violations FOR rule IN (totals, parties, monotone))")
def row_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many rows break actual = valid + invalid, the sum of parties, and order."""
    c = F.col
    rules = {"totals": c("actual") == c("valid") + c("invalid"), "parties": c("valid") == c("p_f") + c("p_o"), "monotone": c("actual") >= c("valid")}
    return contracts.violations(ballots(spark, sf_dir), rules)


@catalog.query(f"""WITH {_BALLOTS}, o AS (SELECT uid + CASE WHEN uid % 110 = 0 THEN 1 ELSE 0 END AS uid, actual + uid % 3 AS eligible, actual FROM ballots WHERE uid % 10 = 0),
j AS (SELECT o.*, b.actual AS was FROM o LEFT JOIN ballots b USING (uid))
SELECT 'known' AS rule, count(*) FILTER (was IS NULL) AS n_violations FROM j UNION ALL SELECT 'monotone', count(*) FILTER (eligible < actual) FROM j UNION ALL SELECT 'unchanged', count(*) FILTER (was IS NULL OR was <> actual) FROM j
UNION ALL SELECT 'unique', count(*) FROM (SELECT uid FROM o GROUP BY 1 HAVING count(*) > 1)""")
def override_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overrides of totals must meet known rows once, keep the row's count and stay in order."""
    rows = ballots(spark, sf_dir)
    uid = F.col("uid")
    over = rows.where(uid % 10 == 0).select((uid + F.when(uid % 110 == 0, 1).otherwise(0)).alias("uid"), (F.col("actual") + uid % 3).alias("eligible"), "actual")
    both = over.join(rows.select("uid", F.col("actual").alias("was")), "uid", "left")
    rules = {"known": F.col("was").isNotNull(), "monotone": F.col("eligible") >= F.col("actual"), "unchanged": F.col("was") == F.col("actual")}
    twice = over.groupBy("uid").count().where("count > 1").agg(F.lit("unique").alias("rule"), F.count("*").alias("n_violations"))
    return contracts.violations(both, rules).unionAll(twice)


@catalog.query("SELECT l_orderkey + 7 AS o_orderkey, count(*) AS n_rows FROM lineitem WHERE l_quantity > 45 AND l_orderkey + 7 NOT IN (SELECT o_orderkey FROM orders WHERE o_orderkey % 5 <> 0) GROUP BY 1")
def overrides_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviewed overrides that no fact row has; :func:`contracts.require_empty` on them fails the job."""
    over = table(spark, sf_dir, "lineitem").where("l_quantity > 45").select((F.col("l_orderkey") + 7).alias("o_orderkey"))
    return contracts.orphans(over, "o_orderkey", table(spark, sf_dir, "orders").where("o_orderkey % 5 <> 0").select("o_orderkey"), "o_orderkey")


@catalog.query("""WITH e AS (SELECT o_orderkey + CASE WHEN o_orderkey % 1000 = 999 THEN 1000000000 ELSE 0 END AS uid, o_orderstatus AS election, CASE WHEN o_orderkey % 50 = 1 THEN -1 ELSE o_custkey END AS code, CASE WHEN o_orderkey % 75 = 1 THEN NULL ELSE CAST(round(o_totalprice * 100) AS BIGINT) END AS voters FROM orders),
d AS (SELECT e.uid, CASE WHEN o_orderkey IS NULL THEN 'absent' ELSE concat_ws('|', CASE WHEN election IS DISTINCT FROM o_orderstatus THEN 'election' END, CASE WHEN code IS DISTINCT FROM o_custkey THEN 'code' END, CASE WHEN voters IS DISTINCT FROM CAST(round(o_totalprice * 100) AS BIGINT) THEN 'voters' END) END AS drift FROM e LEFT JOIN orders ON uid = o_orderkey)
SELECT uid, drift FROM d WHERE drift <> ''""")
def identity_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evidence rows whose identity is no longer that of the fact they were made for."""
    k = F.col("o_orderkey")
    rows = table(spark, sf_dir, "orders").select(k.alias("uid"), F.col("o_orderstatus").alias("election"), F.col("o_custkey").alias("code"), cents("o_totalprice").alias("voters"))
    uid = F.col("uid")
    evidence = rows.select((uid + F.when(uid % 1000 == 999, 1_000_000_000).otherwise(0)).alias("uid"), "election", F.when(uid % 50 == 1, F.lit(-1)).otherwise(F.col("code")).alias("code"), F.when(uid % 75 != 1, F.col("voters")).alias("voters"))
    return contracts.drifted(evidence, rows, "uid", ["election", "code", "voters"])


_DIRECT = "d AS (SELECT l_orderkey AS uid, min(l_suppkey) AS direct FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_suppkey) = 1)"


@catalog.query(f"WITH {_DIRECT} SELECT event_id, user_id AS uid, direct FROM events JOIN d ON user_id = uid WHERE event_type = 'purchase'")
def gap_only_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evidence that would replace a direct assignment instead of filling a gap: it may not."""
    direct = lookup.unique_index(table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("uid"), F.col("l_suppkey").alias("direct")), "uid", "direct")
    return table(spark, sf_dir, "events").where("event_type = 'purchase'").select("event_id", F.col("user_id").alias("uid")).join(direct, "uid").select("event_id", "uid", "direct")


@catalog.query(f"""WITH {FACTS}, e AS (SELECT o_orderstatus AS election, count(*) AS n, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS s FROM orders GROUP BY 1),
a AS (SELECT election, count(*) AS n, CAST(sum(cents) AS BIGINT) AS s FROM facts WHERE area <> 3 GROUP BY 1),
l AS (SELECT election, 'n_rows' AS metric, e.n AS expected, a.n AS actual FROM e FULL JOIN a USING (election) UNION ALL SELECT election, 'cents', e.s, a.s FROM e FULL JOIN a USING (election))
SELECT election, metric, expected, actual, expected IS NOT DISTINCT FROM actual AS agrees FROM l""")
def national_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published totals of each election against those of the geographic rows."""
    sums = [F.count("*").alias("n_rows"), F.sum("cents").alias("cents")]
    expected = table(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("election"), cents("o_totalprice").alias("cents")).groupBy("election").agg(*sums)
    return contracts.reconciled(expected, facts(spark, sf_dir).where("area <> 3").groupBy("election").agg(*sums), ["election"], ["n_rows", "cents"])


@catalog.query(f"WITH {FACTS}, o AS (SELECT o_orderstatus AS election, count(*) AS before FROM orders GROUP BY 1), f AS (SELECT election, count(*) AS after FROM facts GROUP BY 1) SELECT election, coalesce(before, 0) AS before, coalesce(after, 0) AS after, before IS NOT DISTINCT FROM after AS conserved FROM o FULL JOIN f USING (election)")
def row_conservation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows before and after all joins: none is lost or doubled."""
    before = table(spark, sf_dir, "orders").groupBy(F.col("o_orderstatus").alias("election")).agg(F.count("*").alias("before"))
    after = facts(spark, sf_dir).groupBy("election").agg(F.count("*").alias("after"))
    return contracts.conservation(before, after, "election")


@catalog.query("""WITH h AS (SELECT DISTINCT s_nationkey AS id FROM supplier WHERE s_acctbal < -900), r AS (SELECT c_nationkey AS id, count(*) AS n, count(*) FILTER (c_acctbal > 9990) AS envelopes FROM customer GROUP BY 1)
SELECT 'hidden_with_result' AS rule, id, n FROM r JOIN h USING (id) UNION ALL SELECT 'several_envelopes', id, envelopes FROM r WHERE envelopes > 1 UNION ALL SELECT 'repeated_id', l_orderkey * 10 + l_linenumber, count(*) FROM lineitem GROUP BY 2 HAVING count(*) > 1""")
def single_row_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids that stand twice, are hidden but have a result, or have more than one envelope row."""
    hidden = table(spark, sf_dir, "supplier").where("s_acctbal < -900").select(F.col("s_nationkey").alias("id")).distinct()
    results = table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").cast("bigint").alias("id")).agg(F.count("*").alias("n"), F.count_if(F.col("c_acctbal") > 9990).alias("envelopes"))
    twice = table(spark, sf_dir, "lineitem").groupBy((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id")).agg(F.count("*").alias("n")).where("n > 1")
    parts = [results.join(hidden, "id", "left_semi").select(F.lit("hidden_with_result").alias("rule"), "id", "n"), results.where("envelopes > 1").select(F.lit("several_envelopes").alias("rule"), "id", F.col("envelopes").alias("n")), twice.select(F.lit("repeated_id").alias("rule"), "id", "n")]
    return reduce(DataFrame.unionAll, parts)


_CANDIDATES = """c AS (SELECT o_custkey AS locality, CAST(o_orderkey AS VARCHAR) AS uid, CAST(o_custkey % 17 + o_orderkey % 3 AS VARCHAR) AS target, CAST(round(o_totalprice * 100) AS BIGINT) AS voters FROM orders WHERE o_orderstatus = 'F'),
g AS (SELECT locality, count(*) AS n_rows, CAST(sum(voters) AS BIGINT) AS total, sha256(string_agg(uid || '|' || target, chr(10) ORDER BY uid)) AS fingerprint FROM c GROUP BY 1)"""


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    return table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(c.alias("locality"), k.cast("string").alias("uid"), (c % 17 + k % 3).cast("string").alias("target"), cents("o_totalprice").alias("voters"))


@catalog.query(f"""WITH {_CANDIDATES}, r AS (SELECT locality, CASE WHEN locality % 5 = 0 THEN 'rejected' ELSE 'approved' END AS decision, n_rows + CASE WHEN locality % 12 = 0 THEN 1 ELSE 0 END AS rr, total + CASE WHEN locality % 9 = 0 THEN 1 ELSE 0 END AS rt, CASE WHEN locality % 7 = 0 THEN 'x' ELSE fingerprint END AS rf FROM g WHERE locality % 3 < 2),
j AS (SELECT g.*, coalesce(decision, 'pending') AS decision, CASE WHEN decision IS NULL THEN 'none' WHEN rr <> n_rows THEN 'rows' WHEN rt <> total THEN 'totals' WHEN rf <> fingerprint THEN 'mapping' ELSE 'none' END AS drift FROM g LEFT JOIN r USING (locality))
SELECT *, decision = 'approved' AND drift = 'none' AS applies FROM j""")
def reviews_attached(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decisions by locality, which apply only while rows, totals and the mapping's fingerprint are those reviewed."""
    groups = candidates(spark, sf_dir).groupBy("locality").agg(F.count("*").alias("n_rows"), F.sum("voters").alias("total"), reviews.line_fingerprint("uid", "target").alias("fingerprint"))
    k = F.col("locality")
    made = groups.where(k % 3 < 2).select(
        k, F.when(k % 5 == 0, "rejected").otherwise("approved").alias("decision"), (F.col("n_rows") + F.when(k % 12 == 0, 1).otherwise(0)).alias("reviewed_rows"),
        (F.col("total") + F.when(k % 9 == 0, 1).otherwise(0)).alias("reviewed_total"), F.when(k % 7 == 0, "x").otherwise(F.col("fingerprint")).alias("reviewed_fingerprint"),
    )
    return reviews.attached(groups, made, ["locality"])


@catalog.query(f"""WITH {_CANDIDATES} SELECT c.locality, uid, target, CASE WHEN n_rows < 3 THEN 'few_rows' WHEN total % 2 = 1 THEN 'odd_total' WHEN fingerprint < '4' THEN 'fingerprint' ELSE 'loaded' END AS status FROM c JOIN g USING (locality)""")
def validated_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evidence rows with the verdict on their group's count, sum and fingerprint."""
    rows = candidates(spark, sf_dir)
    groups = rows.groupBy("locality").agg(F.count("*").alias("n_rows"), F.sum("voters").alias("total"), reviews.line_fingerprint("uid", "target").alias("fingerprint"))
    status = F.when(F.col("n_rows") < 3, "few_rows").when(F.col("total") % 2 == 1, "odd_total").when(F.col("fingerprint") < "4", "fingerprint").otherwise("loaded")
    return rows.join(groups, "locality").select("locality", "uid", "target", status.alias("status"))


@catalog.query("""WITH m AS (SELECT o_custkey AS member, count(DISTINCT o_orderstatus) AS kinds, bool_or(o_orderstatus = 'P') AS same, bool_or(o_orderstatus = 'F') AS cross_vintage FROM orders GROUP BY 1)
SELECT member, CASE WHEN same AND cross_vintage THEN 'same_and_cross_vintage' WHEN cross_vintage THEN 'cross_vintage_transition' WHEN same THEN 'same_vintage' ELSE 'none' END AS method, kinds FROM m""")
def consensus_methods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The name of a propagated label's method, by the mix of evidence behind it."""
    status = F.col("o_orderstatus")
    mix = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("member")).agg(F.countDistinct(status).alias("kinds"), F.bool_or(status == "P").alias("same"), F.bool_or(status == "F").alias("cross_vintage"))
    method = F.when(F.col("same") & F.col("cross_vintage"), "same_and_cross_vintage").when(F.col("cross_vintage"), "cross_vintage_transition").when(F.col("same"), "same_vintage").otherwise("none")
    return mix.select("member", method.alias("method"), "kinds")


@catalog.query("""WITH k AS (SELECT n_nationkey, 'composite:' || n_regionkey AS cid FROM nation WHERE n_regionkey = 1), nm AS (SELECT s_nationkey, min(s_suppkey) AS code FROM supplier GROUP BY 1 HAVING min(s_suppkey) = max(s_suppkey) OR count(*) < 6),
r AS (SELECT c_custkey, CASE c_custkey % 9 WHEN 0 THEN 'official_envelope' WHEN 1 THEN 'special_non_geographic' WHEN 2 THEN 'custom_point' ELSE 'plain' END AS method, c_custkey % 4 = 0 AS by_component, CASE WHEN c_custkey % 5 = 0 THEN '' WHEN c_custkey % 5 = 1 THEN c_custkey || ',' || (c_custkey + 1) ELSE CAST(c_custkey AS VARCHAR) END AS codes, k.cid, nm.code FROM customer LEFT JOIN k ON k.n_nationkey = c_nationkey LEFT JOIN nm ON s_nationkey = c_nationkey)
SELECT c_custkey, CASE WHEN method = 'official_envelope' THEN 'official_envelope' WHEN method = 'special_non_geographic' THEN method WHEN method = 'custom_point' THEN 'custom_geography_assigned' WHEN cid IS NOT NULL THEN 'composite_locality_assigned' WHEN by_component AND code IS NOT NULL THEN 'source_locality_name_assigned' WHEN codes <> '' AND NOT contains(codes, ',') THEN 'current_locality_assigned' ELSE 'unresolved' END AS status,
CASE WHEN method = 'official_envelope' THEN 'envelope:official' WHEN method = 'special_non_geographic' THEN '' WHEN method = 'custom_point' THEN 'custom:' || c_custkey WHEN cid IS NOT NULL THEN cid WHEN by_component AND code IS NOT NULL THEN 'loc:' || code WHEN codes <> '' AND NOT contains(codes, ',') THEN 'loc:' || codes ELSE '' END AS geography,
NOT (method IN ('official_envelope', 'special_non_geographic')) AND (method = 'custom_point' OR cid IS NOT NULL OR (by_component AND code IS NOT NULL) OR (codes <> '' AND NOT contains(codes, ','))) AS mapped FROM r""")
def locality_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row's geography where localities, not areas, are shown: seven branches and two lookups."""
    k = F.col("c_custkey")
    composite = table(spark, sf_dir, "nation").where("n_regionkey = 1").select(F.col("n_nationkey").alias("c_nationkey"), F.concat(F.lit("composite:"), "n_regionkey").alias("cid"))
    named = table(spark, sf_dir, "supplier").groupBy(F.col("s_nationkey").alias("c_nationkey")).agg(F.min("s_suppkey").alias("code"), F.max("s_suppkey").alias("_m"), F.count("*").alias("_n")).where("code = _m or _n < 6").select("c_nationkey", "code")
    rows = table(spark, sf_dir, "customer").join(composite, "c_nationkey", "left").join(named, "c_nationkey", "left")
    codes = F.when(k % 5 == 0, "").when(k % 5 == 1, F.concat(k, F.lit(","), k + 1)).otherwise(k.cast("string"))
    single = (codes != "") & ~codes.contains(",")
    branches = [
        (k % 9 == 0, "official_envelope", F.lit("envelope:official"), False),
        (k % 9 == 1, "special_non_geographic", F.lit(""), False),
        (k % 9 == 2, "custom_geography_assigned", F.concat(F.lit("custom:"), k), True),
        (F.col("cid").isNotNull(), "composite_locality_assigned", F.col("cid"), True),
        ((k % 4 == 0) & F.col("code").isNotNull(), "source_locality_name_assigned", F.concat(F.lit("loc:"), "code"), True),
        (single, "current_locality_assigned", F.concat(F.lit("loc:"), codes), True),
    ]
    made = F.struct(F.lit("unresolved").alias("status"), F.lit("").alias("geography"), F.lit(False).alias("mapped"))
    for when, status, geography, mapped in reversed(branches):
        made = F.when(when, F.struct(F.lit(status).alias("status"), geography.alias("geography"), F.lit(mapped).alias("mapped"))).otherwise(made)
    return rows.select("c_custkey", made.alias("m")).select("c_custkey", "m.*")


@catalog.query("""WITH p AS (SELECT n_nationkey AS polygon, (SELECT count(*) FROM customer WHERE c_nationkey = n_nationkey) AS n, (SELECT count(*) FROM customer JOIN orders ON o_custkey = c_custkey WHERE c_nationkey = n_nationkey AND o_orderstatus = 'P') AS direct, (SELECT count(*) FROM supplier WHERE s_nationkey = n_nationkey) AS other FROM nation)
SELECT polygon, CASE WHEN n = 0 AND other = 0 THEN 'no_rows' WHEN polygon % 11 = 0 THEN 'excluded' WHEN direct >= n AND direct > 0 THEN 'complete_direct' WHEN direct > 0 AND other = 0 THEN 'partial_direct' WHEN direct > 0 THEN 'mixed' WHEN other > 0 THEN 'inferred_only' ELSE 'pending' END AS status,
CASE WHEN n = 0 THEN 'unknown' WHEN n >= 6 * other THEN 'population_evident' WHEN n > other THEN 'population_weak' ELSE 'no_population' END AS population FROM p""")
def polygon_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is known about each polygon, and what its population says: two ordered choices over three counts."""
    customer = table(spark, sf_dir, "customer")
    n = customer.groupBy(F.col("c_nationkey").alias("polygon")).agg(F.count("*").alias("n"))
    orders = table(spark, sf_dir, "orders").where("o_orderstatus = 'P'")
    direct = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).groupBy(F.col("c_nationkey").alias("polygon")).agg(F.count("*").alias("direct"))
    other = table(spark, sf_dir, "supplier").groupBy(F.col("s_nationkey").alias("polygon")).agg(F.count("*").alias("other"))
    rows = reduce(lambda a, b: a.join(b, "polygon", "left"), [n, direct, other], table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("polygon"))).na.fill(0)
    n, direct, other = F.col("n"), F.col("direct"), F.col("other")
    status = F.when((n == 0) & (other == 0), "no_rows").when(F.col("polygon") % 11 == 0, "excluded").when((direct >= n) & (direct > 0), "complete_direct").when((direct > 0) & (other == 0), "partial_direct").when(direct > 0, "mixed").when(other > 0, "inferred_only").otherwise("pending")
    population = F.when(n == 0, "unknown").when(n >= 6 * other, "population_evident").when(n > other, "population_weak").otherwise("no_population")
    return rows.select("polygon", status.alias("status"), population.alias("population"))


@catalog.query("""WITH s AS (SELECT l_orderkey, count(*) AS n, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS q FROM lineitem GROUP BY 1), w AS (SELECT *, count(*) OVER (PARTITION BY n, q) AS alike FROM s)
SELECT l_orderkey, n, q, alike, CASE WHEN alike = 1 THEN 'unique_signature' WHEN n = 1 THEN 'single_row' WHEN alike <= 5 THEN 'ambiguous_few' ELSE 'ambiguous_many' END AS grain FROM w""")
def comparison_grain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows by their signature of totals, and how finely it can be compared."""
    rows = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("n"), F.sum(F.col("l_quantity").cast("bigint")).alias("q"))
    rows = spread_join(saved(rows.withColumn("signature", F.struct("n", "q")), "signatures"), rows.groupBy(F.struct("n", "q").alias("signature")).agg(F.count("*").alias("alike")), "signature", counted="alike").drop("signature")
    grain = F.when(F.col("alike") == 1, "unique_signature").when(F.col("n") == 1, "single_row").when(F.col("alike") <= 5, "ambiguous_few").otherwise("ambiguous_many")
    return rows.withColumn("grain", grain)


@catalog.query("""WITH a AS (SELECT l_orderkey AS k, count(*) AS n, CAST(sum(l_partkey) AS BIGINT) AS s FROM lineitem GROUP BY 1), b AS (SELECT o_orderkey + 1 AS k, o_custkey % 7 + 1 AS n, o_custkey * 3 AS s FROM orders),
t AS (SELECT n, s % 1000 AS s, min(k) AS target FROM b GROUP BY 1, 2 HAVING count(*) = 1) SELECT a.k, target FROM a JOIN t ON a.n = t.n AND a.s % 1000 = t.s""")
def total_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups matched by their tuple of totals, where only one target has that tuple."""
    own = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(F.count("*").alias("n"), F.sum("l_partkey").alias("s")).select("k", F.struct("n", (F.col("s") % 1000).alias("s")).alias("signature"))
    other = table(spark, sf_dir, "orders").select((F.col("o_orderkey") + 1).alias("target"), F.struct((F.col("o_custkey") % 7 + 1).alias("n"), (F.col("o_custkey") * 3 % 1000).alias("s")).alias("signature"))
    return own.join(lookup.singleton_index(other, "signature", "target"), "signature").select("k", "target")


@catalog.query(f"WITH {FACTS} SELECT election, method, count(*) AS n FROM (SELECT election, CASE WHEN area % 4 = 0 THEN 'direct_crosswalk' WHEN area % 4 = 1 THEN 'direct_review' WHEN area % 4 = 2 THEN 'inferred_link' ELSE 'pending' END AS method FROM facts) WHERE starts_with(method, 'direct_') GROUP BY 1, 2")
def method_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose method begins with direct_."""
    rest = F.col("area") % 4
    method = F.when(rest == 0, "direct_crosswalk").when(rest == 1, "direct_review").when(rest == 2, "inferred_link").otherwise("pending")
    return facts(spark, sf_dir).withColumn("method", method).where(F.col("method").startswith("direct_")).groupBy("election", "method").agg(F.count("*").alias("n"))


@catalog.query("""SELECT p_partkey, CASE p_size % 6 WHEN 0 THEN 'component' WHEN 1 THEN 'override' WHEN 2 THEN CASE WHEN p_partkey % 2 = 0 THEN 'locality_single' ELSE 'locality_pending' END WHEN 3 THEN 'crosswalk' ELSE 'unresolved' END AS method,
CASE WHEN p_size % 6 IN (0, 1, 3) THEN 'stat:' || p_partkey WHEN p_size % 6 = 2 AND p_partkey % 2 = 0 THEN 'loc:' || p_partkey ELSE '' END AS target,
CASE WHEN p_size % 6 = 4 THEN 'no_match: ' || p_brand WHEN p_size % 6 = 5 THEN 'ambiguous: ' || p_type ELSE '' END AS reason, p_size % 6 < 4 AND NOT (p_size % 6 = 2 AND p_partkey % 2 = 1) AS mapped FROM part""")
def assignment_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each solution's constructor gives one and the same struct, with blanks where it has nothing to say."""
    k, kind = F.col("p_partkey"), F.col("p_size") % 6

    def made(method: str, target=F.lit(""), reason=F.lit(""), mapped: bool = False):
        return F.struct(F.lit(method).alias("method"), target.alias("target"), reason.alias("reason"), F.lit(mapped).alias("mapped"))

    stat, place = F.concat(F.lit("stat:"), k), F.concat(F.lit("loc:"), k)
    plan = (
        F.when(kind == 0, made("component", stat, mapped=True)).when(kind == 1, made("override", stat, mapped=True))
        .when((kind == 2) & (k % 2 == 0), made("locality_single", place, mapped=True)).when(kind == 2, made("locality_pending"))
        .when(kind == 3, made("crosswalk", stat, mapped=True)).when(kind == 4, made("unresolved", reason=F.concat(F.lit("no_match: "), "p_brand")))
        .otherwise(made("unresolved", reason=F.concat(F.lit("ambiguous: "), "p_type")))
    )
    return table(spark, sf_dir, "part").select("p_partkey", plan.alias("p")).select("p_partkey", "p.*")


# Eight sources in order of precedence: (method, rows, class, confidence, guard).
_EIGHT = [
    ("reviewed_override", "k % 101 = 0", "reviewed", "high", "true"),
    ("official_envelope", "k % 53 = 0", "envelope", "high", "true"),
    ("direct_crosswalk", "k % 2 = 0", "direct", "high", "s <> 'P'"),
    ("cross_election", "k % 3 = 0", "inferred", "moderate", "s <> 'F'"),
    ("residual_partition", "k % 5 = 0", "inferred", "moderate", "s = 'F'"),
    ("stable_component", "k % 7 = 0", "inferred", "moderate", "true"),
    ("current_locality", "k % 11 = 0", "fallback", "low", "s = 'O'"),
    ("custom_point", "k % 13 = 0", "custom", "low", "true"),
]
_FIRST = " ".join(f"WHEN {rows} AND {guard} THEN {i}" for i, (_, rows, _, _, guard) in enumerate(_EIGHT))


@catalog.query(f"""WITH o AS (SELECT o_orderkey AS k, o_orderstatus AS s FROM orders), f AS (SELECT *, CASE {_FIRST} ELSE 8 END AS i FROM o)
SELECT k AS o_orderkey, CASE WHEN i < 8 THEN k % 100 + i END AS target, CASE i {' '.join(f"WHEN {i} THEN '{e[0]}'" for i, e in enumerate(_EIGHT))} ELSE 'unresolved' END AS method,
CASE i {' '.join(f"WHEN {i} THEN '{e[2]}'" for i, e in enumerate(_EIGHT))} ELSE 'unresolved' END AS evidence_class, CASE i {' '.join(f"WHEN {i} THEN '{e[3]}'" for i, e in enumerate(_EIGHT))} ELSE 'none' END AS confidence, i = 7 AS synthetic FROM f""")
def eight_source_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All eight kinds of evidence in order, each built by its own rule and kept to its own rows by a guard."""
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("s"))
    sources = [cascade.Evidence(m, rows.where(own).select("o_orderkey", (F.col("k") % 100 + i).alias("t")), kind, sure, guard=F.expr(guard), synthetic=m == "custom_point") for i, (m, own, kind, sure, guard) in enumerate(_EIGHT)]
    return cascade.resolve(rows, "o_orderkey", sources).select("o_orderkey", "target", "method", "evidence_class", "confidence", "synthetic")


@catalog.query("""WITH t AS (SELECT source, lang, count(*) AS n, count(*) FILTER (text IS NULL) AS blank FROM documents GROUP BY 1, 2)
SELECT source, CAST(sum(n) AS BIGINT) AS n_rows, CAST(sum(blank) AS BIGINT) AS n_blank, count(*) AS n_labels, bool_or(regexp_matches(coalesce(lang, ''), '^(en|de)$')) AS has_statistical, CASE WHEN bool_or(regexp_matches(coalesce(lang, ''), '^(en|de)$')) THEN CASE WHEN sum(blank) = 0 THEN 'complete' ELSE 'partial' END ELSE 'label_absent' END AS interpretation FROM t GROUP BY 1""")
def source_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which labels each source has, and what that means for it."""
    rows = table(spark, sf_dir, "documents").groupBy("source", "lang").agg(F.count("*").alias("n"), F.count_if(F.col("text").isNull()).alias("blank"))
    has = F.bool_or(F.coalesce("lang", F.lit("")).rlike("^(en|de)$"))
    got = rows.groupBy("source").agg(F.sum("n").alias("n_rows"), F.sum("blank").alias("n_blank"), F.count("*").alias("n_labels"), has.alias("has_statistical"))
    return got.withColumn("interpretation", F.when(~F.col("has_statistical"), "label_absent").when(F.col("n_blank") == 0, "complete").otherwise("partial"))


@catalog.query("SELECT r_name, count(n_nationkey) AS files, count(n_nationkey) = 5 AS expected, string_agg(n_name, '|' ORDER BY n_name) AS names FROM region LEFT JOIN nation ON n_regionkey = r_regionkey GROUP BY 1")
def catalog_gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether each collection holds as many members as its catalogue says."""
    rows = table(spark, sf_dir, "region").join(table(spark, sf_dir, "nation"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
    got = rows.groupBy("r_name").agg(F.count("n_nationkey").alias("files"), aggregate.distinct_joined(F.col("n_name")).alias("names"))
    return got.select("r_name", "files", (F.col("files") == 5).alias("expected"), "names")


@catalog.query("""WITH a AS (SELECT p_partkey % 40 AS alias, min(p_partkey % 13) AS area FROM part GROUP BY 1), f AS (SELECT s_suppkey % 60 AS alias, count(*) AS n FROM supplier GROUP BY 1), p AS (SELECT c_custkey % 13 AS area, count(*) AS published FROM customer GROUP BY 1),
j AS (SELECT f.alias, f.n, a.area FROM f LEFT JOIN a USING (alias)), w AS (SELECT *, CAST(sum(n) OVER (PARTITION BY area) AS BIGINT) AS counted FROM j)
SELECT alias, w.area, n, counted, published, CASE WHEN w.area IS NULL THEN 'missing_alias' WHEN counted = published THEN 'agrees' ELSE 'differs' END AS status FROM w LEFT JOIN p ON p.area = w.area""")
def published_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counted features of each area against published ones, with the aliases that lead nowhere."""
    part, k = table(spark, sf_dir, "part"), F.col("p_partkey")
    aliases = part.groupBy((k % 40).alias("alias")).agg(F.min(k % 13).alias("area"))
    features = table(spark, sf_dir, "supplier").groupBy((F.col("s_suppkey") % 60).alias("alias")).agg(F.count("*").alias("n"))
    published = table(spark, sf_dir, "customer").groupBy((F.col("c_custkey") % 13).alias("area")).agg(F.count("*").alias("published"))
    rows = features.join(aliases, "alias", "left").withColumn("counted", F.sum("n").over(Window.partitionBy("area"))).join(published, "area", "left")
    status = F.when(F.col("area").isNull(), "missing_alias").when(F.col("counted") == F.col("published"), "agrees").otherwise("differs")
    return rows.select("alias", "area", "n", "counted", "published", status.alias("status"))


@catalog.query(f"WITH {FACTS}, t AS (SELECT election, party, count(*) AS n FROM facts GROUP BY 1, 2) SELECT election, '{{' || string_agg('\"' || party || '\":' || n, ',' ORDER BY party) || '}}' AS by_party, CAST(sum(n) AS BIGINT) AS n_rows FROM t GROUP BY 1")
def nested_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A summary by election with its counts by party as one JSON object, names in order."""
    counts = facts(spark, sf_dir).groupBy("election", "party").agg(F.count("*").alias("n"))
    pairs = F.array_sort(F.collect_list(F.struct("party", "n")))
    return counts.groupBy("election").agg(F.to_json(F.map_from_entries(pairs)).alias("by_party"), F.sum("n").alias("n_rows"))


@catalog.query("""WITH r AS (SELECT s_suppkey, CASE WHEN s_suppkey % 6 = 0 THEN '' WHEN s_suppkey % 2 = 0 THEN 'uid:' || (s_suppkey // 4) ELSE s_nationkey || ':' || (s_suppkey % 10) END AS k FROM supplier)
SELECT k AS rule_key, count(*) AS n_rules, CASE WHEN k = '' THEN 'blank' ELSE 'repeated' END AS fault FROM r GROUP BY 1 HAVING k = '' OR count(*) > 1""")
def rule_index_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules keyed by a row id, or else by group and number: blank and repeated keys are faults."""
    k = F.col("s_suppkey")
    key = F.when(k % 6 == 0, "").when(k % 2 == 0, F.concat(F.lit("uid:"), F.floor(k / 4).cast("string"))).otherwise(F.concat_ws(":", "s_nationkey", k % 10))
    got = table(spark, sf_dir, "supplier").groupBy(key.alias("rule_key")).agg(F.count("*").alias("n_rules")).where("rule_key = '' or n_rules > 1")
    return got.withColumn("fault", F.when(F.col("rule_key") == "", "blank").otherwise("repeated"))


@catalog.query("""SELECT p_brand AS code, arg_max(p_partkey, p_partkey) AS last_row, arg_max(p_name, p_partkey) AS name, count(*) AS n_rows FROM part GROUP BY 1""")
def dimension_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dimension by code, of which the row declared last counts, with all that were declared counted."""
    last = F.max(F.struct("p_partkey", "p_name"))
    got = table(spark, sf_dir, "part").groupBy(F.col("p_brand").alias("code")).agg(last.alias("r"), F.count("*").alias("n_rows"))
    return got.select("code", F.col("r.p_partkey").alias("last_row"), F.col("r.p_name").alias("name"), "n_rows")


@catalog.query("""WITH r AS (SELECT s_suppkey AS rule, s_nationkey AS grp, s_suppkey % 30 AS low, s_suppkey % 30 + s_suppkey % 7 - 1 AS high, CASE WHEN s_suppkey % 9 = 0 THEN NULL ELSE s_suppkey % 4 END AS expected FROM supplier)
SELECT rule, CASE WHEN expected IS NULL THEN 'incomplete' WHEN high < low THEN 'empty_range' ELSE 'overlap' END AS fault FROM r
WHERE expected IS NULL OR high < low OR EXISTS (SELECT 1 FROM r o WHERE o.grp = r.grp AND o.high >= o.low AND o.expected IS NOT NULL AND (o.low, o.high, o.rule) < (r.low, r.high, r.rule) AND o.high >= r.low)""")
def range_rule_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Range rules that are incomplete, empty, or begin inside one before them."""
    k = F.col("s_suppkey")
    rules = table(spark, sf_dir, "supplier").select(k.alias("rule"), F.col("s_nationkey").alias("grp"), (k % 30).alias("low"), (k % 30 + k % 7 - 1).alias("high"), F.when(k % 9 != 0, k % 4).alias("expected"))
    faulty = rules.where("expected is null or high < low").select("rule", F.when(F.col("expected").isNull(), "incomplete").otherwise("empty_range").alias("fault"))
    before = F.max("high").over(Window.partitionBy("grp").orderBy("low", "high", "rule").rowsBetween(Window.unboundedPreceding, -1))
    good = rules.where("expected is not null and high >= low").withColumn("_before", before)
    return faulty.unionAll(good.where("_before >= low").select("rule", F.lit("overlap").alias("fault")))


@catalog.query("""WITH s AS (SELECT s_suppkey AS host, s_suppkey * 3 % 40 AS member, 'joined' AS family FROM supplier WHERE s_suppkey % 2 = 0), t AS (SELECT s_suppkey AS host, s_suppkey * 7 % 40 AS member, 'component' AS family FROM supplier WHERE s_suppkey % 2 = 1), u AS (SELECT * FROM s UNION ALL SELECT * FROM t)
SELECT host, member, family, EXISTS (SELECT 1 FROM nation WHERE n_nationkey = member) AS known FROM u""")
def composite_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Composites of two families of rules in one table, with the members that no geography has marked."""
    k = F.col("s_suppkey")
    supplier = table(spark, sf_dir, "supplier")
    both = supplier.where(k % 2 == 0).select(k.alias("host"), (k * 3 % 40).alias("member"), F.lit("joined").alias("family")).unionByName(supplier.where(k % 2 == 1).select(k.alias("host"), (k * 7 % 40).alias("member"), F.lit("component").alias("family")))
    known = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("bigint").alias("member"), F.lit(True).alias("known"))
    return both.join(known, "member", "left").select("host", "member", "family", F.coalesce("known", F.lit(False)).alias("known"))
