"""Number and name forms over real columns, index conflicts, composite configurations and shapes, gap rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import normalize
from ..operators import contracts, coverage, lookup
from ._tables import Catalog, cents, table
from .maps import _TWICE, cells

catalog = Catalog()

_RAW = """r AS (SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN CASE WHEN c < 0 THEN '-' ELSE '' END || abs(c) // 100 || '.' || lpad(CAST(abs(c) % 100 AS VARCHAR), 2, '0') WHEN 1 THEN ' ' || c_custkey || '.0 ' WHEN 2 THEN '00' || c_custkey ELSE c_name END AS raw
  FROM (SELECT *, CAST(round(c_acctbal * 100) AS BIGINT) AS c FROM customer)),
n AS (SELECT *, TRY_CAST(trim(raw) AS DOUBLE) AS d, CAST(TRY_CAST(trim(raw) AS DECIMAL(38, 6)) AS VARCHAR) AS t, regexp_replace(raw, '[^0-9]', '', 'g') AS digits FROM r)"""


@catalog.query(f"""WITH {_RAW} SELECT c_custkey, raw, CASE WHEN d IS NOT NULL AND floor(d) = d THEN CAST(CAST(d AS BIGINT) AS VARCHAR) ELSE regexp_replace(digits, '^0+(.)', '\\1') END AS code,
coalesce(regexp_replace(regexp_replace(t, '(\\.[0-9]*?)0+$', '\\1'), '\\.$', ''), '') AS number, CAST(coalesce(round_even(d, 0), 0) AS BIGINT) AS rounded, regexp_replace(raw, '\\.0+$', '') AS trimmed FROM n""")
def number_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Balances, keys and names as texts, and four readings of them that differ on purpose."""
    k, c = F.col("c_custkey"), cents("c_acctbal")
    money = F.concat(F.when(c < 0, "-").otherwise(""), F.floor(F.abs(c) / 100), F.lit("."), F.lpad((F.abs(c) % 100).cast("string"), 2, "0"))
    raw = F.when(k % 4 == 0, money).when(k % 4 == 1, F.concat(F.lit(" "), k, F.lit(".0 "))).when(k % 4 == 2, F.concat(F.lit("00"), k)).otherwise(F.col("c_name"))
    r = F.col("raw")
    return table(spark, sf_dir, "customer").select(k, raw.alias("raw")).select(k, r, normalize.locality_code(r).alias("code"), normalize.number_text(r).alias("number"), normalize.banker_int(r).alias("rounded"), normalize.drop_zero_fraction(r).alias("trimmed"))


@catalog.query("""SELECT doc_id, sha256(regexp_replace(regexp_replace(lower(nfc_normalize(coalesce(text, ''))), '\\p{Pd}', '-', 'g'), '[^\\p{L}\\p{N}_-]', '', 'g')) AS form_sha256, sha256(regexp_replace(lower(nfc_normalize(coalesce(text, ''))), '[^0-9a-z\\x{0590}-\\x{05FF}]', '', 'g')) AS label_sha256 FROM documents""")
def text_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matching and label forms of whole documents."""
    text = F.col("text")
    return table(spark, sf_dir, "documents").select("doc_id", F.sha2(normalize.nfkc_name(text), 256).alias("form_sha256"), F.sha2(normalize.label_key(text), 256).alias("label_sha256"))


@catalog.query("""SELECT p_partkey, CASE WHEN p_size % 5 = 0 THEN '' ELSE CAST(p_partkey AS VARCHAR) END AS code, p_name AS name, p_size % 3 = 0 AS yes FROM part""")
def source_identities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names with a code in brackets behind them taken apart, and flags written in several ways."""
    k, size = F.col("p_partkey"), F.col("p_size")
    identity = F.when(size % 5 == 0, F.concat("p_name", F.lit("  "))).otherwise(F.concat("p_name", F.lit(" ["), k, F.lit("] ")))
    flag = F.when(size % 3 == 0, F.element_at(F.array(F.lit(" TRUE"), F.lit("1"), F.lit("Yes ")), (k % 3 + 1).cast("int"))).otherwise(F.element_at(F.array(F.lit("no"), F.lit(""), F.lit(None).cast("string")), (k % 3 + 1).cast("int")))
    return table(spark, sf_dir, "part").select(k, normalize.bracket_code(identity).alias("code"), normalize.bracket_name(identity).alias("name"), normalize.truthy(flag).alias("yes"))


@catalog.query("""WITH i AS (SELECT o_custkey AS locality, o_orderpriority AS sheet, CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE o_orderstatus END AS area FROM orders),
v AS (SELECT locality, sheet, count(*) AS n_rows, count(*) FILTER (area <> '') AS selected, count(*) FILTER (area = '') AS blank, string_agg(DISTINCT area, '|' ORDER BY area) FILTER (area <> '') AS areas, count(DISTINCT area) FILTER (area <> '') AS n_areas FROM i GROUP BY 1, 2)
SELECT locality, sheet, n_rows, selected, blank, coalesce(areas, '') AS areas, CASE WHEN n_areas > 1 THEN 'conflict' WHEN n_areas = 1 THEN 'one' ELSE 'none' END AS status FROM v""")
def index_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An index of sheets: keys with several values are conflicts and named; selected and blank rows apart."""
    area = F.when(F.col("o_orderkey") % 4 == 0, "").otherwise(F.col("o_orderstatus"))
    rows = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("locality"), F.col("o_orderpriority").alias("sheet"), area.alias("area"))
    chosen = normalize.present(F.col("area"))
    found = rows.groupBy("locality", "sheet").agg(F.count("*").alias("n_rows"), F.count(chosen).alias("selected"), F.count_if(chosen.isNull()).alias("blank"), F.array_sort(F.collect_set(chosen)).alias("values"))
    status = F.when(F.size("values") > 1, "conflict").when(F.size("values") == 1, "one").otherwise("none")
    return found.select("locality", "sheet", "n_rows", "selected", "blank", F.array_join("values", "|").alias("areas"), status.alias("status"))


_CONFIG = """c AS (SELECT s_suppkey AS composite, s_suppkey % 3 AS election, s_nationkey AS host, CASE WHEN s_suppkey % 7 = 0 THEN [(s_nationkey + 1) % 25, s_nationkey] ELSE [s_nationkey, (s_nationkey + 1) % 25, (s_nationkey * 3 + s_suppkey) % 30] END AS parts FROM supplier),
e AS (SELECT composite, election, host, unnest(parts) AS part, unnest(range(len(parts))) AS place FROM c), u AS (SELECT election, part, count(DISTINCT composite) AS n FROM e GROUP BY 1, 2)"""


@catalog.query(f"""WITH {_CONFIG} SELECT composite, string_agg(CAST(part AS VARCHAR), '|' ORDER BY place) AS codes, string_agg(coalesce(n_name, '?'), '|' ORDER BY place) AS names, count(*) FILTER (n_name IS NULL) AS unknown,
max(CASE WHEN place = 0 THEN part = host END) AS host_first, count(*) = count(DISTINCT part) AS distinct_parts, max(u.n) > 1 AS shared FROM e JOIN u USING (election, part) LEFT JOIN nation ON n_nationkey = part GROUP BY composite""")
def composite_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Joined composites with their parts' names in order; whether the host comes first, parts are distinct and no other's of the election."""
    k, n = F.col("s_suppkey"), F.col("s_nationkey")
    parts = F.when(k % 7 == 0, F.array((n + 1) % 25, n)).otherwise(F.array(n, (n + 1) % 25, ((n * 3 + k) % 30).cast("int")))
    rows = table(spark, sf_dir, "supplier").select(k.alias("composite"), (k % 3).alias("election"), n.alias("host"), F.posexplode(parts).alias("place", "part"))
    shared = rows.groupBy("election", "part").agg(F.countDistinct("composite").alias("_n"))
    names = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("part"), "n_name")
    joined = rows.join(shared, ["election", "part"]).join(names, "part", "left")
    listed = F.array_sort(F.collect_list(F.struct("place", "part", F.coalesce("n_name", F.lit("?")).alias("name"))))
    found = joined.groupBy("composite", "host").agg(listed.alias("p"), F.count_if(F.col("n_name").isNull()).alias("unknown"), F.max("_n").alias("n"))
    text = lambda f: F.array_join(F.transform("p", lambda x: x[f].cast("string")), "|")
    return found.select("composite", text("part").alias("codes"), text("name").alias("names"), "unknown", (F.col("p")[0]["part"] == F.col("host")).alias("host_first"), (F.size(F.array_distinct(F.transform("p", lambda x: x["part"]))) == F.size("p")).alias("distinct_parts"), (F.col("n") > 1).alias("shared"))


@catalog.query(f"""WITH {_TWICE}, a AS (SELECT nation, sum(area) AS area FROM s GROUP BY 1), f AS (SELECT 'region' || n_regionkey AS composite, n_nationkey AS part FROM nation UNION SELECT 'pair' || s_nationkey, s_nationkey FROM supplier UNION SELECT 'pair' || s_nationkey, s_nationkey + 20 FROM supplier)
SELECT composite, count(*) AS n_parts, count(*) FILTER (area IS NULL) AS missing, CASE WHEN count(*) FILTER (area IS NULL) = 0 THEN sum(area) END AS area FROM f LEFT JOIN a ON nation = part GROUP BY 1""")
def composite_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Composites of two rule families: parts that no geometry has are counted; where all are there, the area of their union."""
    pair = table(spark, sf_dir, "supplier").select(F.concat(F.lit("pair"), "s_nationkey").alias("composite"), F.explode(F.array(F.col("s_nationkey"), F.col("s_nationkey") + 20)).alias("nation"))
    rules = table(spark, sf_dir, "nation").select(F.concat(F.lit("region"), "n_regionkey").alias("composite"), F.col("n_nationkey").alias("nation")).unionAll(pair).distinct()
    shapes = cells(spark, sf_dir)
    known = shapes.select("nation").distinct().withColumn("_known", F.lit(True))
    counts = rules.join(known, "nation", "left").groupBy("composite").agg(F.count("*").alias("n_parts"), F.count_if(F.col("_known").isNull()).alias("missing"))
    whole = rules.join(counts.where("missing = 0").select("composite"), "composite", "left_semi").join(shapes, "nation")
    areas = coverage.ring_summary(coverage.dissolved(coverage.edges(whole, ["composite"], "ring"), "composite"), "composite").groupBy("composite").agg(F.sum("area").alias("area"))
    return counts.join(areas, "composite", "left").select("composite", "n_parts", "missing", "area")


@catalog.query("""WITH g AS (SELECT o_orderkey AS uid, o_custkey AS locality, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders WHERE o_orderstatus = 'P'),
l AS (SELECT l_orderkey AS uid, count(*) AS n_lines, CAST(sum(l_quantity) AS BIGINT) AS voters FROM lineitem GROUP BY 1), e AS (SELECT s_suppkey AS locality, min(s_name) AS enriched FROM supplier GROUP BY 1)
SELECT g.uid, g.locality, coalesce(n_lines, 0) AS n_lines, coalesce(voters, 0) AS voters, coalesce(enriched, '') AS enriched, CASE WHEN n_lines IS NULL THEN 'no_rows' WHEN voters > 100 THEN 'large' WHEN enriched IS NULL THEN 'no_evidence' ELSE 'reviewable' END AS gap,
CASE WHEN coalesce(voters, 0) = 0 THEN NULL ELSE cents // voters END AS cents_each FROM g LEFT JOIN l USING (uid) LEFT JOIN e USING (locality)""")
def gap_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pending rows joined one to one with their counts, classified, with what enriches them or blanks."""
    pending = table(spark, sf_dir, "orders").where("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("uid"), F.col("o_custkey").alias("locality"), cents("o_totalprice").alias("cents"))
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("uid")).agg(F.count("*").alias("n_lines"), F.sum("l_quantity").cast("bigint").alias("voters"))
    more = lookup.first_index(table(spark, sf_dir, "supplier"), "s_suppkey", [F.col("s_name")]).select(F.col("s_suppkey").alias("locality"), F.col("s_name").alias("enriched"))
    rows = contracts.joined(pending, lines, ["uid"], validate="one_to_one").join(more, "locality", "left")
    gap = F.when(F.col("n_lines").isNull(), "no_rows").when(F.col("voters") > 100, "large").when(F.col("enriched").isNull(), "no_evidence").otherwise("reviewable")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    each = F.when(F.coalesce("voters", F.lit(0)) > 0, F.floor(F.col("cents") / F.col("voters"))).alias("cents_each")
    return rows.select("uid", "locality", zero("n_lines"), zero("voters"), F.coalesce("enriched", F.lit("")).alias("enriched"), gap.alias("gap"), each)


_PATTERNS = [("first", "^almond"), ("large", "BRASS$"), ("none", "^no such name"), ("brand", "Brand#1[0-9]")]


@catalog.query(f"""WITH r AS (SELECT p_partkey, p_name || ' ' || p_brand || ' ' || p_type AS name, p_size FROM part), p(kind, pattern) AS (VALUES {', '.join(f"('{k}', '{p}')" for k, p in _PATTERNS)})
SELECT kind, count(p_partkey) AS n_matches, CASE WHEN count(p_partkey) = 0 THEN 'missing' WHEN count(p_partkey) = 1 THEN 'selected' ELSE 'ambiguous' END AS status, min(p_partkey) AS first_match, count(p_partkey) > 0 AND count(p_partkey) FILTER (p_size > 5) = count(p_partkey) AS cached FROM p LEFT JOIN r ON regexp_matches(name, pattern) GROUP BY kind""")
def resource_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Resources chosen by patterns of their names, one for each; a cache counts only if every file of it is there."""
    name = F.concat_ws(" ", "p_name", "p_brand", "p_type")
    hits = F.filter(F.array(*[F.when(name.rlike(p), F.lit(kind)) for kind, p in _PATTERNS]), lambda k: k.isNotNull())
    found = table(spark, sf_dir, "part").select("p_partkey", "p_size", F.explode(hits).alias("kind"))
    counts = found.groupBy("kind").agg(F.count("*").alias("n"), F.min("p_partkey").alias("first_match"), F.count_if(F.col("p_size") > 5).alias("there"))
    kinds = spark.createDataFrame([(k,) for k, _ in _PATTERNS], "kind string")
    n = F.coalesce("n", F.lit(0))
    status = F.when(n == 0, "missing").when(n == 1, "selected").otherwise("ambiguous")
    return kinds.join(counts, "kind", "left").select("kind", n.alias("n_matches"), status.alias("status"), "first_match", ((n > 0) & (F.coalesce("there", F.lit(0)) == n)).alias("cached"))


@catalog.query("""WITH v AS (SELECT c_nationkey AS area, unnest(list_distinct([lower(c_mktsegment), c_mktsegment, replace(replace(c_mktsegment, 'U', 'Ü'), 'E', 'É')])) AS party FROM customer), n AS (SELECT area, party, count(*) // 5 AS votes FROM v GROUP BY 1, 2)
SELECT area, party, votes, row_number() OVER (PARTITION BY area ORDER BY votes DESC, party COLLATE de) AS place FROM n""")
def locale_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parties by votes, ties in the order of a language: accents after letters, small letters before large ones."""
    name = F.col("c_mktsegment")
    names = F.array_distinct(F.array(F.lower(name), name, F.replace(F.replace(name, F.lit("U"), F.lit("Ü")), F.lit("E"), F.lit("É"))))
    votes = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("area"), F.explode(names).alias("party")).groupBy("area", "party").agg(F.floor(F.count("*") / 5).alias("votes"))
    return votes.withColumn("place", F.row_number().over(Window.partitionBy("area").orderBy(F.desc("votes"), F.collate("party", "de"))))
