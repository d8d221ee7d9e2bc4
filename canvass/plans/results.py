"""Results by area: totals, winners, wide and long forms, subtotals, coverage, rankings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.nested import row_sum, votes_array, votes_map
from ..functions.normalize import share
from ..operators import aggregate, contracts, ranking, reshape
from ._tables import FACTS, FLAGS, SEGMENTS, Catalog, cents, facts, table

catalog = Catalog()


@catalog.query(f"""WITH {FACTS}, v AS (SELECT area, party, count(*) AS n FROM facts GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY area ORDER BY n DESC, party) AS k FROM v)
SELECT area, CAST(sum(n) AS BIGINT) AS valid_votes, max(party) FILTER (k = 1) AS winner, max(n) FILTER (k = 1) AS winner_votes,
  max(party) FILTER (k = 2) AS runner_up, max(n) FILTER (k = 2) AS runner_up_votes,
  max(n) FILTER (k = 1) - coalesce(max(n) FILTER (k = 2), 0) AS margin,
  round_even(max(n) FILTER (k = 1) / sum(n)::DOUBLE * 1e6, 0) / 1e6 AS winner_share
FROM r GROUP BY area""")
def area_results_winner(spark: SparkSession, sf_dir: str) -> DataFrame:
    votes = facts(spark, sf_dir).groupBy("area", "party").agg(F.count("*").alias("n"))
    return ranking.winners(votes, ["area"], "party", "n")


@catalog.query(f"""WITH {FACTS} SELECT area, {', '.join(f"count(*) FILTER (party = '{s}') AS {s}" for s in SEGMENTS)} FROM facts GROUP BY area""")
def area_results_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    votes = facts(spark, sf_dir).select("area", "party", F.lit(1).alias("one"))
    return reshape.to_wide(votes, ["area"], "party", "one", SEGMENTS)


@catalog.query(f"""WITH {FACTS}, w AS (SELECT region, {', '.join(f"count(*) FILTER (party = '{s}') AS {s}" for s in SEGMENTS)} FROM facts GROUP BY region),
l AS (UNPIVOT w ON {', '.join(SEGMENTS)} INTO NAME party VALUE votes)
SELECT region, CAST(sum(votes) AS BIGINT) AS total, arg_max(party, votes * 10 - (CASE party {' '.join(f"WHEN '{s}' THEN {i}" for i, s in enumerate(SEGMENTS))} END)) AS winner, max(votes) AS winner_votes FROM l GROUP BY region""")
def row_wise_winner(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Winner inside each wide row, ties in column order, without turning the table."""
    votes = facts(spark, sf_dir).select("region", "party", F.lit(1).alias("one"))
    wide = reshape.to_wide(votes, ["region"], "party", "one", SEGMENTS).withColumn("_v", votes_array(SEGMENTS))
    return wide.select("region", row_sum(*map(F.col, SEGMENTS)).alias("total"), F.col("_v")[0]["party"].alias("winner"), F.col("_v")[0]["votes"].alias("winner_votes"))


@catalog.query("""SELECT c_nationkey AS area, count(*) AS eligible, count(*) FILTER (c_acctbal > 0) AS actual,
round_even(count(*) FILTER (c_acctbal > 0)::DOUBLE / nullif(count(*) FILTER (c_mktsegment <> 'BUILDING'), 0) * 1e6, 0) / 1e6 AS turnout FROM customer GROUP BY 1""")
def area_turnout_null_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("area")).agg(F.count("*").alias("eligible"), F.count_if(F.col("c_acctbal") > 0).alias("actual"), F.count_if(F.col("c_mktsegment") != "BUILDING").alias("_d"))
    return got.select("area", "eligible", "actual", share(F.col("actual"), F.col("_d")).alias("turnout"))


@catalog.query(f"WITH {FACTS} SELECT area, count(DISTINCT custkey || '::' || election) AS contributors, count(*) AS n_rows FROM facts GROUP BY area")
def contributing_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.concat_ws("::", "custkey", "election")
    return facts(spark, sf_dir).groupBy("area").agg(F.countDistinct(key).alias("contributors"), F.count("*").alias("n_rows"))


@catalog.query(f"""WITH {FACTS} SELECT election, area, CAST(sum(cents) AS BIGINT) AS cents, count(*) AS n_rows, min(cents) AS low, max(cents) AS high FROM facts GROUP BY 1, 2""")
def area_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts(spark, sf_dir).groupBy("election", "area").agg(F.sum("cents").alias("cents"), F.count("*").alias("n_rows"), F.min("cents").alias("low"), F.max("cents").alias("high"))


@catalog.query(f"""WITH {FACTS} SELECT election, CASE WHEN grouping(party) = 1 THEN 'all_parties' ELSE party END AS party, CASE WHEN grouping(region) = 1 THEN '' ELSE CAST(region AS VARCHAR) END AS region,
count(*) AS n_rows, CAST(sum(cents) AS BIGINT) AS cents FROM facts GROUP BY GROUPING SETS ((election, party, region), (election))""")
def subtotal_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregate.subtotals(facts(spark, sf_dir), ["election"], ["party", "region"], "party", "all_parties", [F.count("*").alias("n_rows"), F.sum("cents").alias("cents")])


@catalog.query(f"""WITH {FACTS} SELECT region, party, count(*) AS n_rows, CAST(grouping(region) * 2 + grouping(party) AS BIGINT) AS level FROM facts GROUP BY CUBE (region, party)""")
def rollup_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extension: the reference has only the hand-made subtotal above."""
    return facts(spark, sf_dir).cube("region", "party").agg(F.count("*").alias("n_rows"), F.grouping_id().alias("level"))


@catalog.query(f"""WITH {FACTS}, c AS (SELECT area, party, count(*) AS n FROM facts GROUP BY ALL) SELECT area, party FROM c QUALIFY row_number() OVER (PARTITION BY area ORDER BY n DESC, party) = 1""")
def mode_with_tie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts(spark, sf_dir).groupBy("area").agg(F.mode("party", True).alias("party"))


@catalog.query("""SELECT l_partkey, string_agg(DISTINCT l_returnflag, '|' ORDER BY l_returnflag) AS flags, count(DISTINCT l_returnflag) AS n_flags FROM lineitem GROUP BY 1""")
def set_agg_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(aggregate.distinct_joined(F.col("l_returnflag")).alias("flags"), F.countDistinct("l_returnflag").alias("n_flags"))


@catalog.query(f"""WITH {FACTS}, t AS (SELECT party, CAST(cents % 7 AS BIGINT) AS cents, custkey FROM facts)
SELECT party, count(*) AS n_rows, count(DISTINCT custkey) AS n_keys, round_even(count(DISTINCT custkey)::DOUBLE / count(*) * 1e6, 0) / 1e6 AS share FROM t GROUP BY party""")
def party_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = facts(spark, sf_dir).groupBy("party").agg(F.count("*").alias("n_rows"), F.countDistinct("custkey").alias("n_keys"))
    return got.withColumn("share", share(F.col("n_keys"), F.col("n_rows")))


_COVER = f"""WITH {FACTS}, c AS (SELECT region, area, count(*) AS n_rows, count(*) FILTER (cents >= 2500000) AS n_covered, CAST(sum(cents) AS BIGINT) AS weight, CAST(coalesce(sum(cents) FILTER (cents >= 2500000), 0) AS BIGINT) AS weight_covered FROM facts GROUP BY 1, 2)
SELECT *, round_even(weight_covered::DOUBLE / weight::DOUBLE * 1e6, 0) / 1e6 AS share, coalesce(round_even(weight_covered::DOUBLE / weight::DOUBLE * 1e6, 0) / 1e6 < 0.95, true) AS partial FROM c"""


@catalog.query(_COVER)
def coverage_by_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregate.coverage(facts(spark, sf_dir), ["region", "area"], F.col("cents") >= 2_500_000, "cents")


_YEARS = ["1995", "1996", "1997", "1998", "1999", "2000", "2001"]


@catalog.query(f"""WITH p AS (SELECT DISTINCT o_custkey, CAST(year(o_orderdate) AS VARCHAR) AS y FROM orders WHERE year(o_orderdate) BETWEEN 1995 AND 2001),
a AS (SELECT o_custkey, list(y ORDER BY y) AS ys FROM p GROUP BY 1)
SELECT o_custkey, CAST(len(ys) AS BIGINT) AS n_present, array_to_string(ys, '|') AS present,
array_to_string(list_filter({_YEARS}, lambda x: NOT list_contains(ys, x)), '|') AS missing,
CASE WHEN len(ys) = 7 THEN 'always' WHEN len(ys) >= 5.25 THEN 'mostly' WHEN len(ys) >= 2.8 THEN 'sometimes' ELSE 'rarely' END AS status FROM a""")
def persistence_by_entity(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_custkey", F.year("o_orderdate").cast("string").alias("y"))
    return aggregate.persistence(orders, "o_custkey", "y", _YEARS)


@catalog.query("""WITH m AS (SELECT o_custkey, count(DISTINCT o_orderpriority) AS k, string_agg(DISTINCT o_orderpriority, '|' ORDER BY o_orderpriority) AS ps FROM orders GROUP BY 1)
SELECT CASE WHEN k = 5 THEN 'every' WHEN k >= 4 THEN 'most' WHEN k >= 2 THEN 'some' ELSE 'one' END AS bucket, count(*) AS n, min(ps) AS sample FROM m GROUP BY 1""")
def omission_recurrence(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.countDistinct("o_orderpriority").alias("k"), aggregate.distinct_joined(F.col("o_orderpriority")).alias("ps"))
    bucket = F.when(F.col("k") == 5, "every").when(F.col("k") >= 4, "most").when(F.col("k") >= 2, "some").otherwise("one")
    return own.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n"), F.min("ps").alias("sample"))


@catalog.query("""SELECT o_custkey, CAST(sum(CAST(round(o_totalprice*100) AS BIGINT)) - coalesce(sum(CAST(round(o_totalprice*100) AS BIGINT)) FILTER (o_orderstatus = 'F'), 0) AS BIGINT) AS cents_left, count(*) FILTER (o_orderstatus <> 'F') AS rows_left FROM orders GROUP BY 1""")
def residual_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderstatus", cents("o_totalprice").alias("cents"))
    return aggregate.residuals(orders, "o_custkey", F.col("o_orderstatus") == "F", ["cents"])


@catalog.query(f"""WITH {FACTS}, a AS (SELECT region, area, count(*) AS n FROM facts GROUP BY ALL), g AS (SELECT region, CAST(sum(n) AS BIGINT) AS total, count(*) AS n_areas, min(n) = max(n) AS all_equal FROM a GROUP BY 1)
SELECT region, total, n_areas, all_equal, total = (SELECT count(*) FROM facts f WHERE f.region = g.region) AS adds_up FROM g""")
def display_group_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = facts(spark, sf_dir)
    own = rows.groupBy("region", "area").agg(F.count("*").alias("n")).groupBy("region").agg(F.sum("n").alias("total"), F.count("*").alias("n_areas"), (F.min("n") == F.max("n")).alias("all_equal"))
    direct = rows.groupBy("region").agg(F.count("*").alias("_n"))
    return own.join(direct, "region").select("region", "total", "n_areas", "all_equal", (F.col("total") == F.col("_n")).alias("adds_up"))


@catalog.query("""WITH t AS (SELECT l_returnflag AS party, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS total_votes FROM lineitem GROUP BY 1) SELECT party, total_votes FROM t""")
def column_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = table(spark, sf_dir, "lineitem").select(*[F.when(F.col("l_returnflag") == f, F.col("l_quantity").cast("bigint")).alias(f) for f in FLAGS])
    return reshape.column_totals(wide, FLAGS)


@catalog.query("""WITH w AS (SELECT l_suppkey, CAST(coalesce(sum(CAST(l_quantity AS BIGINT)) FILTER (l_returnflag = 'A'), 0) AS BIGINT) AS A, CAST(coalesce(sum(CAST(l_quantity AS BIGINT)) FILTER (l_returnflag = 'N'), 0) AS BIGINT) AS N, CAST(coalesce(sum(CAST(l_quantity AS BIGINT)) FILTER (l_returnflag = 'R'), 0) AS BIGINT) AS R FROM lineitem GROUP BY 1)
SELECT l_suppkey, party, votes FROM (UNPIVOT w ON A, N, R INTO NAME party VALUE votes)""")
def unpivot_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_returnflag", F.col("l_quantity").cast("bigint").alias("q"))
    return reshape.to_long(reshape.to_wide(lines, ["l_suppkey"], "l_returnflag", "q", FLAGS), ["l_suppkey"], FLAGS)


@catalog.query("""WITH w AS (SELECT l_suppkey, l_returnflag, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS q FROM lineitem GROUP BY 1, 2)
SELECT l_suppkey, '{' || string_agg('"' || l_returnflag || '":' || q, ',' ORDER BY l_returnflag) || '}' AS party_votes FROM (SELECT s.l_suppkey, f.l_returnflag, coalesce(q, 0) AS q FROM (SELECT DISTINCT l_suppkey FROM lineitem) s CROSS JOIN (SELECT unnest(['A','N','R']) AS l_returnflag) f LEFT JOIN w ON w.l_suppkey = s.l_suppkey AND w.l_returnflag = f.l_returnflag) GROUP BY 1""")
def result_record_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_returnflag", F.col("l_quantity").cast("bigint").alias("q"))
    wide = reshape.to_wide(lines, ["l_suppkey"], "l_returnflag", "q", FLAGS)
    return wide.select("l_suppkey", F.to_json(votes_map(FLAGS)).alias("party_votes"))


@catalog.query("""SELECT l_orderkey, l_linenumber, min(l_partkey) AS l_partkey FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice) AS k FROM lineitem) WHERE k = 1 GROUP BY 1, 2""")
def dedupe_keep_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = [F.col(c) for c in ("l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")]
    return ranking.keep_first(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], order).select("l_orderkey", "l_linenumber", "l_partkey")


@catalog.query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@catalog.query("SELECT o_orderkey, o_orderpriority, CAST(round(o_totalprice*100) AS BIGINT) AS cents FROM orders ORDER BY o_orderpriority, cents DESC, o_orderkey LIMIT 100")
def sort_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A top-k report: the limit is the feature."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", cents("o_totalprice").alias("cents"))
    return ranking.top_k(orders, 100, [F.asc("o_orderpriority"), F.desc("cents"), F.asc("o_orderkey")])


@catalog.query("""SELECT o_orderkey, CAST(substr(c_name, 10) AS BIGINT) AS suffix, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS seq, count(*) OVER (PARTITION BY o_custkey) AS group_size FROM orders JOIN customer ON o_custkey = c_custkey""")
def source_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positional numbers over an explicit order, group sizes, and ids by their numeric suffix."""
    from pyspark.sql import Window

    own = Window.partitionBy("o_custkey")
    rows = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return rows.select("o_orderkey", F.substring("c_name", 10, 20).cast("bigint").alias("suffix"), F.row_number().over(own.orderBy("o_orderdate", "o_orderkey")).cast("bigint").alias("seq"), F.count("*").over(own).alias("group_size"))


@catalog.query("""SELECT 'customer' AS kind, c_custkey AS id, c_mktsegment AS segment, NULL::VARCHAR AS brand FROM customer UNION ALL SELECT 'part', p_partkey, NULL, p_brand FROM part""")
def union_hetero(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "customer").select(F.lit("customer").alias("kind"), F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("segment"))
    b = table(spark, sf_dir, "part").select(F.lit("part").alias("kind"), F.col("p_partkey").alias("id"), F.col("p_brand").alias("brand"))
    return reshape.union_by_name([a, b])


@catalog.query("""WITH a AS (SELECT DISTINCT c_nationkey AS k FROM customer WHERE c_acctbal > 5000), b AS (SELECT DISTINCT s_nationkey AS k FROM supplier WHERE s_acctbal > 5000)
SELECT k, 'both' AS kind FROM (SELECT k FROM a INTERSECT SELECT k FROM b) UNION ALL SELECT k, 'left' FROM (SELECT k FROM a EXCEPT SELECT k FROM b) UNION ALL SELECT k, 'right' FROM (SELECT k FROM b EXCEPT SELECT k FROM a)""")
def set_ops(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "customer").where("c_acctbal > 5000").select(F.col("c_nationkey").alias("k")).distinct()
    b = table(spark, sf_dir, "supplier").where("s_acctbal > 5000").select(F.col("s_nationkey").alias("k")).distinct()
    named = lambda df, kind: df.select("k", F.lit(kind).alias("kind"))
    return named(a.intersect(b), "both").unionAll(named(a.subtract(b), "left")).unionAll(named(b.subtract(a), "right"))


@catalog.query("""SELECT 'price_positive' AS rule, count(*) FILTER (NOT o_totalprice > 0) AS n_violations FROM orders UNION ALL SELECT 'status_known', count(*) FILTER (o_orderstatus NOT IN ('F','O','P')) FROM orders UNION ALL SELECT 'cents_exact', count(*) FILTER (abs(o_totalprice * 100 - round(o_totalprice * 100)) > 0.001) FROM orders""")
def row_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = {"price_positive": F.col("o_totalprice") > 0, "status_known": F.col("o_orderstatus").isin("F", "O", "P"), "cents_exact": F.abs(F.col("o_totalprice") * 100 - F.round(F.col("o_totalprice") * 100)) <= 0.001}
    return contracts.violations(table(spark, sf_dir, "orders"), rules)
