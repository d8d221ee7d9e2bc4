"""Scans and sinks round by round, small forms of values, registries, display rules and geography lists."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import nested, normalize
from ..operators import aggregate, contracts, lookup, ranking
from ..operators.skew import dealt
from ..sources import files, paged, release, versions
from ..storage import saved, shared_dir
from ._tables import FACTS, Catalog, cents, facts, table

catalog = Catalog()


def _folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


@catalog.query("""SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name || ', "' || p_brand || '"' AS label, CASE WHEN p_size > 25 THEN '' ELSE p_type || chr(10) || p_size END AS note FROM part""")
def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written as CSV with byte order marks, quotes, line breaks and blanks, and read again as strings."""
    rows = table(spark, sf_dir, "part").select("p_partkey", F.concat("p_name", F.lit(', "'), "p_brand", F.lit('"')).alias("label"), F.when(F.col("p_size") <= 25, F.concat_ws("\n", "p_type", "p_size")).alias("note"))
    folder = _folder(spark, "csv")
    release.write_csv(rows, ["p_partkey"], folder, parts=4)
    return files.csv_strings(spark, folder)


@catalog.query("SELECT n_regionkey, CAST(n_nationkey AS VARCHAR) AS code, n_name AS name, 'Point' AS kind, n_nationkey * 1.5::DOUBLE AS x, n_regionkey + 0.25::DOUBLE AS y FROM nation")
def geojson_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A feature collection for each region, written as JSON documents and read again as features with their points."""
    nation = table(spark, sf_dir, "nation")
    point = F.array(F.col("n_nationkey") * F.lit(1.5), F.col("n_regionkey") + F.lit(0.25))
    feature = release.feature_json(F.struct(F.col("n_nationkey").alias("code"), F.col("n_name").alias("name"), "n_regionkey"), F.lit("Point"), point)
    folder = _folder(spark, "geojson")
    release.feature_collection(nation.select("n_regionkey", feature.alias("feature")), ["n_regionkey"], "feature").select("json").repartition(5).write.text(folder)
    found = files.geojson_features(spark, folder).withColumn("p", files.positions(F.col("coordinates"))[0])
    return found.select(F.col("properties")["n_regionkey"].cast("int").alias("n_regionkey"), F.col("properties")["code"].alias("code"), F.col("properties")["name"].alias("name"), "kind", F.col("p.x").alias("x"), F.col("p.y").alias("y"))


def _cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sheet for each region: a title, the header in row 3 and a row for each nation."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    sheet = F.concat(F.lit("s"), "r_regionkey").alias("sheet")
    cell = lambda row, col, value: F.struct(row.cast("int").alias("row"), F.lit(col).alias("col"), value.cast("string").alias("value"))
    head = region.select(sheet, F.explode(F.array(cell(F.lit(0), 0, F.col("r_name")), cell(F.lit(2), 1, F.lit("Code  no")), cell(F.lit(2), 3, F.lit("Name of it")))).alias("c"))
    row = F.col("n_nationkey") + 3
    body = nation.select(F.concat(F.lit("s"), "n_regionkey").alias("sheet"), F.explode(F.array(cell(row, 1, F.col("n_nationkey")), cell(row, 3, F.concat(F.lit(" "), "n_name", F.lit("  "))))).alias("c"))
    return head.unionAll(body).select("sheet", "c.*")


@catalog.query("SELECT 's' || n_regionkey AS sheet, CAST(n_nationkey + 3 AS INTEGER) AS row, CAST(n_nationkey AS VARCHAR) AS Code, n_name AS Name FROM nation")
def sheet_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows below a header that has to be found first."""
    return files.sheet_rows(_cells(spark, sf_dir), ["Code", "Name"])


@catalog.query("SELECT 's' || r_regionkey || '!R3C2' AS place, 'Code no' AS value FROM region")
def cell_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where a label stands in all sheets."""
    return files.cell_places(_cells(spark, sf_dir), "Code")


@catalog.query("SELECT n_regionkey AS page_id, 0 AS \"table\", CAST(row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) - 1 AS INTEGER) AS row, CAST(n_nationkey AS VARCHAR) AS code, n_name || ' & co' AS name FROM nation")
def html_table_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the tables of pages, tags and references resolved."""
    row = F.concat(F.lit("<tr><td>"), "n_nationkey", F.lit("</td><td><b>"), "n_name", F.lit("</b> &amp;  co</td></tr>"))
    rows = F.array_sort(F.collect_list(F.struct("n_nationkey", row.alias("html"))))
    pages = table(spark, sf_dir, "nation").groupBy(F.col("n_regionkey").alias("page_id")).agg(F.concat(F.lit("<table>"), F.array_join(F.transform(rows, lambda r: r["html"]), ""), F.lit("</table>")).alias("html"))
    found = files.html_tables(pages, "page_id", "html")
    return found.select("page_id", "table", "row", F.col("cells")[0].alias("code"), F.col("cells")[1].alias("name"))


@catalog.query("""WITH l AS (SELECT l_orderkey AS doc, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) AS place, l_returnflag = 'N' AS starts, CAST(l_partkey AS VARCHAR) AS text FROM lineitem),
n AS (SELECT *, count(*) FILTER (starts) OVER (PARTITION BY doc ORDER BY place) AS record FROM l) SELECT doc, record, string_agg(text, ' ' ORDER BY place) AS text FROM n WHERE record > 0 GROUP BY 1, 2""")
def line_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines joined to records that begin where a line of a kind stands."""
    own = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("doc"), F.row_number().over(own).alias("place"), "l_returnflag", F.concat(F.lit(" "), "l_partkey").alias("text"))
    return files.joined_lines(lines, "doc", "place", "text", F.col("l_returnflag") == "N")


@catalog.query("""WITH t AS (SELECT c_nationkey, string_agg(c_name || chr(10), '' ORDER BY c_name) AS body, count(*) AS n FROM customer GROUP BY 1)
SELECT 'c_nationkey=' || c_nationkey AS category, octet_length(encode(body)) AS bytes, n AS lines, sha256(body) AS sha256, starts_with(body, 'C') AS right_kind FROM t""")
def manifest_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Length, lines, hash and kind of each file of a written folder."""
    folder = _folder(spark, "manifest")
    rows = table(spark, sf_dir, "customer").select("c_nationkey", "c_name").repartition("c_nationkey").sortWithinPartitions("c_nationkey", "c_name")
    rows.write.partitionBy("c_nationkey").text(folder)
    return release.manifest(spark, folder, b"C").select("category", "bytes", "lines", "sha256", "right_kind")


@catalog.query("SELECT c_custkey, c_name, 2 AS versions FROM customer WHERE c_custkey % 2 = 1")
def published_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table published twice in one place: readers see the second version, the first is still there."""
    folder, rows = _folder(spark, "published"), table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    for rest in (0, 1):
        versions.publish(rows.where(F.col("c_custkey") % 2 == rest), folder)
    return versions.read(spark, folder).withColumn("versions", F.lit(len(versions.pointed(spark, folder))))


@catalog.query("""SELECT o_orderstatus AS election, count(*) AS before, count(c_custkey) FILTER (o_orderstatus <> 'P' AND c_nationkey <> 3) AS after, count(*) = count(c_custkey) FILTER (o_orderstatus <> 'P' AND c_nationkey <> 3) AS conserved
FROM orders LEFT JOIN customer ON o_custkey = c_custkey GROUP BY 1 UNION ALL SELECT '(others)', 0, 0, true""")
def observed_conservation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each election before and after a join and a filter that lose some, counted by the job that writes them."""
    orders = table(spark, sf_dir, "orders").withColumnRenamed("o_orderstatus", "election")
    kept = versions.Conserved("election", sorted(r["election"] for r in orders.select("election").distinct().limit(versions.MOST_GROUPS + 1).collect()))
    areas = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    rows = kept.before(orders).join(areas, "o_custkey").where("election <> 'P' and c_nationkey <> 3")
    versions.publish(kept.after(rows), _folder(spark, "conserved"))
    return spark.createDataFrame([(g, b, a, a == b) for g, b, a in kept.counts()], "election string, before long, after long, conserved boolean")


@catalog.query("""SELECT CASE WHEN p_partkey % 10 IN (0, 5) THEN 'rejected' ELSE 'kept' END AS kind, CASE p_partkey % 10 WHEN 0 THEN p_partkey || ',' || p_brand WHEN 5 THEN p_partkey || ',' || p_brand || ',' || p_size || ',more' ELSE CAST(p_partkey AS VARCHAR) END AS line FROM part""")
def csv_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with too few or too many cells are told apart from the others; blank lines are skipped."""
    k, folder = F.col("p_partkey"), _folder(spark, "faulty")
    good = F.concat_ws(",", k, "p_brand", "p_size")
    line = F.when(k % 10 == 0, F.concat_ws(",", k, "p_brand")).when(k % 10 == 5, F.concat(good, F.lit(",more"))).when(k % 10 == 7, F.concat(good, F.lit("\n  "))).otherwise(good)
    table(spark, sf_dir, "part").select(line).write.text(folder)
    rows, rejected = files.csv_checked(spark, folder, ["key", "brand", "size"], header=False)
    return rows.select(F.lit("kept").alias("kind"), F.col("key").alias("line")).unionAll(rejected.select(F.lit("rejected"), "line"))


_PAGED_IN_TASK = 10_000  # rows; small rows would be merged into one task, which then writes a file for each page of all


@catalog.query("SELECT c_custkey, c_name, CAST(c_custkey // 500 AS INTEGER) AS page FROM customer")
def paged_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers written in pages of 500 and read page by page: lengths verified, ids complete."""
    rows, folder = table(spark, sf_dir, "customer").select("c_custkey", "c_name"), _folder(spark, "pages")
    dealt(rows.withColumn("page", F.floor(F.col("c_custkey") / 500)), "page", _PAGED_IN_TASK).sortWithinPartitions("page", "c_custkey").write.partitionBy("page").json(folder)
    found = paged.scan(spark, folder, "canvass.sources.paged:folder_page", rows.count(), 500)
    record = F.from_json("record", "c_custkey long, c_name string")
    read = saved(found.select(record.alias("r"), "page").select("r.c_custkey", "r.c_name", "page"), "read")
    return paged.require_complete(read, "c_custkey", rows)


@catalog.query("SELECT c_custkey AS id, c_name AS name FROM customer WHERE c_custkey % 3 = 0")
def fetched_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers asked for by id, some hundred at a time; every batch returns its ids, each once."""
    rows, folder = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name")), _folder(spark, "records")
    dealt(rows.withColumn("page", F.floor(F.col("id") / 100)), "page", _PAGED_IN_TASK).write.partitionBy("page").json(folder)
    wanted = rows.where("id % 3 = 0").select("id")
    found = paged.fetched(wanted, "id", folder, "canvass.sources.paged:folder_ids", 100).select("id", F.get_json_object("record", "$.name").alias("name"))
    return paged.require_complete(saved(found, "fetched"), "id", wanted)


@catalog.query("""SELECT CASE WHEN c_custkey % 30 = 0 THEN '' ELSE 'loc:' || c_custkey END AS id, CASE WHEN c_nationkey < 20 THEN 'stat:' ELSE 'custom:' END || c_nationkey AS area, CASE WHEN c_nationkey < 20 THEN 'statistical' ELSE 'custom' END AS area_type,
CASE WHEN c_custkey % 30 = 0 THEN 'blank_id' WHEN c_nationkey NOT IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 0) THEN 'unknown_area' ELSE '' END AS fault FROM customer""")
def table_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table copied with ids in standard form, the type told by their prefix, and its faults named."""
    k, nation = F.col("c_custkey"), F.col("c_nationkey")
    rows = table(spark, sf_dir, "customer").select(F.when(k % 30 == 0, "").otherwise(F.concat(F.lit("loc:"), k)).alias("id"), nation, F.concat(F.when(nation < 20, "stat:").otherwise("custom:"), nation).alias("area"))
    known = table(spark, sf_dir, "supplier").where("s_acctbal > 0").select(F.col("s_nationkey").alias("c_nationkey")).distinct().withColumn("_known", F.lit(True))
    kind = F.when(F.col("area").startswith("stat:"), "statistical").when(F.col("area").startswith("custom:"), "custom")
    fault = F.when(F.col("id") == "", "blank_id").when(F.col("_known").isNull(), "unknown_area").otherwise("")
    return rows.join(known, "c_nationkey", "left").select("id", "area", kind.alias("area_type"), fault.alias("fault"))


@catalog.query("SELECT l_orderkey AS uid, CAST(sum(CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END) + sum(CASE WHEN l_returnflag = 'N' THEN 1 ELSE 0 END) + sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS BIGINT) AS votes, 'ballot' AS kind FROM lineitem GROUP BY 1")
def dynamic_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All columns of a wide table that are not known by name are parties; their sum, and a constant column."""
    wide = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("uid")).agg(*[F.count_if(F.col("l_returnflag") == f).alias(f) for f in "ANR"])
    parties = nested.other_columns(wide, {"uid"})
    return wide.select("uid", nested.row_sum(*[F.col(p) for p in parties]).alias("votes"), F.lit("ballot").alias("kind"))


@catalog.query("SELECT o_orderkey, n_lines, first_line FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n_lines, min(l_linenumber) AS first_line FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey")
def one_to_one_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A join that fails unless both sides have each key once."""
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("n_lines"), F.min("l_linenumber").alias("first_line"))
    return contracts.joined(table(spark, sf_dir, "orders").select("o_orderkey"), lines, ["o_orderkey"], validate="one_to_one")


@catalog.query("SELECT event_id, event_type, json_extract_string(props, '$.k') AS k FROM events WHERE coalesce(trim(json_extract_string(props, '$.k')), '') <> '' AND coalesce(trim(event_type), '') <> '' AND user_id IS NOT NULL")
def key_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of which no key is blank."""
    rows = table(spark, sf_dir, "events").select("event_id", "event_type", F.get_json_object("props", "$.k").alias("k"), "user_id")
    keys = [normalize.present(F.col("k")), normalize.present(F.col("event_type")), F.col("user_id")]
    return rows.where(keys[0].isNotNull() & keys[1].isNotNull() & keys[2].isNotNull()).drop("user_id")


@catalog.query("SELECT c_nationkey AS area, c_mktsegment AS party, count(*) AS n FROM customer WHERE c_custkey < 0 GROUP BY ALL")
def typed_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No rows in, no rows out, and the columns as ever."""
    return table(spark, sf_dir, "customer").where("c_custkey < 0").groupBy(F.col("c_nationkey").alias("area"), F.col("c_mktsegment").alias("party")).agg(F.count("*").alias("n"))


@catalog.query("SELECT l_orderkey, count(DISTINCT l_returnflag) AS n_values FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_returnflag) > 1")
def conflicting_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys with several values where one was promised."""
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.countDistinct("l_returnflag").alias("n_values")).where("n_values > 1")


# Raw text and what the number forms make of it, as the SQL states it: raw, locality code, number text, rounded, without .0
_NUMBERS = [
    ("12.5", "125", "12.5", 12, "12.5"), (" 10.0 ", "10", "10", 10, " 10.0 "), ("0010", "10", "10", 10, "0010"), ("nan", "", "", None, "nan"),
    ("13.50", "1350", "13.5", 14, "13.50"), ("2.5", "25", "2.5", 2, "2.5"), ("x7y8", "78", "", 0, "x7y8"), ("5.00", "5", "5", 5, "5"), ("", "", "", 0, ""), ("-3", "-3", "-3", -3, "-3"),
]


def _pick(texts: list[str], key: Column) -> Column:
    return F.element_at(F.array(*[F.lit(x) for x in texts]), (key % len(texts) + 1).cast("int"))


def _sql_list(values: list) -> str:
    return "[" + ", ".join("NULL" if v is None else str(v) if isinstance(v, int) else "'" + v.replace("'", "''") + "'" for v in values) + "]"


@catalog.query(f"""SELECT p_partkey, {_sql_list([n[0] for n in _NUMBERS])}[p_partkey % {len(_NUMBERS)} + 1] AS raw, {_sql_list([n[1] for n in _NUMBERS])}[p_partkey % {len(_NUMBERS)} + 1] AS code, {_sql_list([n[2] for n in _NUMBERS])}[p_partkey % {len(_NUMBERS)} + 1] AS number,
coalesce({_sql_list([n[3] for n in _NUMBERS])}[p_partkey % {len(_NUMBERS)} + 1], 0)::BIGINT AS rounded, {_sql_list([n[4] for n in _NUMBERS])}[p_partkey % {len(_NUMBERS)} + 1] AS trimmed FROM part""")
def number_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw text, four readings that differ on purpose."""
    raw = F.col("raw")
    rows = table(spark, sf_dir, "part").select("p_partkey", _pick([n[0] for n in _NUMBERS], F.col("p_partkey")).alias("raw"))
    rounded = F.when(F.lower(F.trim(raw)) == "nan", F.lit(0).cast("bigint")).otherwise(normalize.banker_int(raw))
    return rows.select("p_partkey", "raw", normalize.locality_code(raw).alias("code"), normalize.number_text(raw).alias("number"), rounded.alias("rounded"), normalize.drop_zero_fraction(raw).alias("trimmed"))


# Raw names and their forms: raw, matching form, label form, code in brackets, name before it, whether it means yes.
_NAMES = [
    ("Ａｂ－c [12]", "ab-c12", "abc12", "12", "Ａｂ－c", False), ("שָׁלוֹם", "שלום", "שָׁלוֹם", "", "שָׁלוֹם", False), ("a‎b — d", "ab-d", "abd", "", "a‎b — d", False),
    ("TRUE", "true", "true", "", "TRUE", True), (" yes ", "yes", "yes", "", "yes", True), ("ﬁve [0007] ", "five0007", "five0007", "0007", "ﬁve", False),
]


@catalog.query(f"""SELECT p_partkey, {_sql_list([n[1] for n in _NAMES])}[p_partkey % {len(_NAMES)} + 1] AS form, {_sql_list([n[2] for n in _NAMES])}[p_partkey % {len(_NAMES)} + 1] AS label, {_sql_list([n[3] for n in _NAMES])}[p_partkey % {len(_NAMES)} + 1] AS code, {_sql_list([n[4] for n in _NAMES])}[p_partkey % {len(_NAMES)} + 1] AS name,
{_sql_list([int(n[5]) for n in _NAMES])}[p_partkey % {len(_NAMES)} + 1] = 1 AS yes FROM part""")
def name_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Compatibility forms, bracketed codes and yes-words."""
    raw = F.col("raw")
    rows = table(spark, sf_dir, "part").select("p_partkey", _pick([n[0] for n in _NAMES], F.col("p_partkey")).alias("raw"))
    return rows.select("p_partkey", normalize.nfkc_name(raw).alias("form"), normalize.label_key(raw).alias("label"), normalize.bracket_code(raw).alias("code"), normalize.bracket_name(raw).alias("name"), normalize.truthy(raw).alias("yes"))


@catalog.query("SELECT o_orderkey, format('{:,}', CAST(round(o_totalprice * 100) AS BIGINT)) AS shown, printf('%.1f', round_even(o_custkey % 1000 / 1000.0::DOUBLE * 1000, 0) / 10) || '%' AS percent FROM orders")
def formatted_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers as people read them."""
    return table(spark, sf_dir, "orders").select("o_orderkey", normalize.grouped_number(cents("o_totalprice")).alias("shown"), normalize.percent(F.col("o_custkey") % 1000 / 1000).alias("percent"))


@catalog.query("SELECT p_partkey, coalesce(nullif(CASE WHEN p_size % 3 = 0 THEN '' ELSE p_name END, ''), nullif(CASE WHEN p_size % 2 = 0 THEN ' ' ELSE p_type END, ' '), p_brand) AS name, CASE WHEN p_size % 3 = 0 THEN p_brand ELSE p_name || ' (' || p_brand || ')' END AS label FROM part")
def localized_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A name in the first language that has one, and a label of name and code."""
    size = F.col("p_size")
    one, two = F.when(size % 3 == 0, "").otherwise(F.col("p_name")), F.when(size % 2 == 0, " ").otherwise(F.col("p_type"))
    named = normalize.present(one)
    return table(spark, sf_dir, "part").select("p_partkey", normalize.first_present(one, two, F.col("p_brand")).alias("name"), F.coalesce(F.concat(named, F.lit(" ("), "p_brand", F.lit(")")), F.col("p_brand")).alias("label"))


@catalog.query("""WITH n AS (SELECT count(l_tax) AS l_tax, count(l_discount) AS l_discount, count(l_quantity) AS l_quantity FROM lineitem)
SELECT name, n_values, CASE name WHEN 'l_comment' THEN 'absent' WHEN 'l_tax' THEN 'not_a_party' WHEN 'l_discount' THEN 'kept' ELSE 'kept' END AS reason FROM (SELECT 'l_comment' AS name, 0 AS n_values UNION ALL SELECT 'l_tax', l_tax FROM n UNION ALL SELECT 'l_discount', l_discount FROM n UNION ALL SELECT 'l_quantity', l_quantity FROM n)""")
def excluded_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns left out by rule, each with its reason, and those that stay, with the values that each holds."""
    rows, rules = table(spark, sf_dir, "lineitem"), {"l_comment": "not_a_party", "l_tax": "not_a_party"}
    names = sorted({*rules, "l_discount", "l_quantity"})
    counted = rows.agg(*[F.count(n).alias(n) if n in rows.columns else F.lit(0).cast("long").alias(n) for n in names]).unpivot([], names, "name", "n_values")
    reason = F.when(~F.col("name").isin(rows.columns), "absent").when(F.col("name").isin(*rules), "not_a_party").otherwise("kept")
    return counted.select("name", "n_values", reason.alias("reason"))


@catalog.query("""WITH a AS (SELECT c_nationkey AS k, count(*) AS customers, max(c_acctbal) AS top FROM customer GROUP BY 1), b AS (SELECT s_nationkey AS k, count(*) AS suppliers FROM supplier GROUP BY 1) SELECT a.k, customers, top, suppliers FROM a LEFT JOIN b USING (k)""")
def side_by_side(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns beside columns: by key, as rows have no positions."""
    made = F.struct(F.count("*").alias("customers"), F.max("c_acctbal").alias("top")).alias("made")
    rows = table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("k")).agg(made)
    other = table(spark, sf_dir, "supplier").groupBy(F.col("s_nationkey").alias("k")).agg(F.count("*").alias("suppliers"))
    return rows.select("k", "made.*").join(other, "k", "left")


@catalog.query("""WITH a AS (SELECT DISTINCT o_custkey AS k FROM orders), b AS (SELECT DISTINCT c_custkey AS k FROM customer WHERE c_custkey % 50 <> 7), d AS (SELECT a.k AS l, b.k AS r FROM a FULL JOIN b ON a.k = b.k)
SELECT count(*) FILTER (r IS NULL) AS missing, count(*) FILTER (l IS NULL) AS extra, count(*) FILTER (l IS NULL OR r IS NULL) = 0 AS equal FROM d""")
def set_equality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether two sets of keys are one, with the numbers that speak against it."""
    left, right = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k")), table(spark, sf_dir, "customer").where("c_custkey % 50 <> 7").select(F.col("c_custkey").alias("k"))
    sides = contracts.set_difference(left, right, "k")
    return sides.agg(F.count_if(F.col("side") == "missing").alias("missing"), F.count_if(F.col("side") == "extra").alias("extra"), (F.count("*") == 0).alias("equal"))


@catalog.query(f"""WITH {FACTS}, v AS (SELECT area, CASE WHEN ascii(party) % 2 = 0 THEN lower(party) ELSE party END AS party, count(*) // 20 AS votes FROM facts GROUP BY 1, 2) SELECT area, party, votes, row_number() OVER (PARTITION BY area ORDER BY votes DESC, lower(party)) AS place FROM v""")
def collated_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parties by votes, ties by name whatever its case."""
    party = F.when(F.ascii("party") % 2 == 0, F.lower("party")).otherwise(F.col("party"))
    votes = facts(spark, sf_dir).groupBy("area", party.alias("party")).agg(F.floor(F.count("*") / 20).alias("votes"))
    order = Window.partitionBy("area").orderBy(F.desc("votes"), F.collate("party", "UTF8_LCASE"))
    return votes.withColumn("place", F.row_number().over(order))


@catalog.query("SELECT n_nationkey AS id, n_name AS name, 'base' AS source FROM nation WHERE n_nationkey < 15 UNION ALL SELECT s_nationkey, min(s_name), 'supplement' FROM supplier WHERE s_nationkey >= 15 GROUP BY 1")
def append_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A supplement adds only the ids that the base has not."""
    base = table(spark, sf_dir, "nation").where("n_nationkey < 15").select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"), F.lit("base").alias("source"))
    more = table(spark, sf_dir, "supplier").groupBy(F.col("s_nationkey").alias("id")).agg(F.min("s_name").alias("name"), F.lit("supplement").alias("source"))
    return base.unionByName(more.join(base.select("id"), "id", "left_anti"))


@catalog.query("SELECT n_nationkey AS id, CASE WHEN n = 1 THEN 'S' || only_one ELSE 'N' || n_nationkey END AS geometry, coalesce(n, 0) AS candidates FROM nation LEFT JOIN (SELECT s_nationkey, count(*) AS n, min(s_suppkey) AS only_one FROM supplier WHERE s_acctbal > 8000 GROUP BY 1) ON s_nationkey = n_nationkey")
def representative_swap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A feature takes another's geometry where exactly one stands for it."""
    other = table(spark, sf_dir, "supplier").where("s_acctbal > 8000").groupBy(F.col("s_nationkey").alias("id")).agg(F.count("*").alias("n"), F.min("s_suppkey").alias("only_one"))
    rows = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("id")).join(other, "id", "left")
    own = F.when(F.col("n") == 1, F.concat(F.lit("S"), "only_one")).otherwise(F.concat(F.lit("N"), "id"))
    return rows.select("id", own.alias("geometry"), F.coalesce("n", F.lit(0)).alias("candidates"))


@catalog.query("""WITH t AS (SELECT p_partkey % 60 AS target, list_sort(list(DISTINCT p_partkey % 17)) AS needed FROM part GROUP BY 1), h AS (SELECT p_partkey % 60 AS target, list_sort(list(DISTINCT p_partkey % 17)) AS held FROM part WHERE p_size > 4 GROUP BY 1)
SELECT t.target, len(needed) AS n_needed, coalesce(len(held), 0) AS n_held, needed IS NOT DISTINCT FROM held AS complete FROM t LEFT JOIN h USING (target)""")
def transition_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Targets whose sources are all there, so that they may be joined to one."""
    part, k = table(spark, sf_dir, "part"), F.col("p_partkey")
    keys = lambda rows, name: rows.groupBy((k % 60).alias("target")).agg(F.array_sort(F.collect_set(k % 17)).alias(name))
    both = keys(part, "needed").join(keys(part.where("p_size > 4"), "held"), "target", "left")
    return both.select("target", F.size("needed").cast("bigint").alias("n_needed"), F.coalesce(F.size("held"), F.lit(0)).cast("bigint").alias("n_held"), F.col("needed").eqNullSafe(F.col("held")).alias("complete"))


@catalog.query("""SELECT vec_id, CASE WHEN label % 2 = 0 THEN 'Point' ELSE 'MultiPoint' END AS kind, CASE WHEN label % 2 = 0 THEN 1 ELSE 2 END AS n_points, list_min(list_filter(embedding[1 : CASE WHEN label % 2 = 0 THEN 64 ELSE 32 END], lambda x, i: i % 2 = 1))::DOUBLE AS first_min_x FROM embeddings""")
def marker_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A marker for each part of a feature: one box, or two for a feature of two halves."""
    e, double = F.col("embedding"), F.col("label") % 2 == 1
    half = F.floor(F.size(e) / 2).cast("int")
    boxes = F.when(double, F.array(nested.bounds(nested.pairs_of(F.slice(e, F.lit(1), half))), nested.bounds(nested.pairs_of(F.slice(e, half + 1, half))))).otherwise(F.array(nested.bounds(nested.pairs_of(e))))
    return table(spark, sf_dir, "embeddings").select("vec_id", F.when(double, "MultiPoint").otherwise("Point").alias("kind"), F.size(boxes).alias("n_points"), boxes[0]["min_x"].cast("double").alias("first_min_x"))


@catalog.query("""WITH m AS (SELECT 'stat' || CASE WHEN s_suppkey % 3 = 0 THEN '2008' WHEN s_suppkey % 3 = 1 THEN '2011' ELSE '1999' END || ':' || s_suppkey AS marker FROM supplier)
SELECT marker, regexp_extract(marker, '^stat([0-9]{4}):', 1) AS vintage, split_part(marker, ':', 2) AS id, regexp_extract(marker, '^stat([0-9]{4}):', 1) IN ('2008', '2011') AS valid FROM m""")
def display_markers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of the form stat<vintage>:<id> taken apart, with the vintages that are none."""
    k = F.col("s_suppkey")
    marker = F.concat(F.lit("stat"), F.when(k % 3 == 0, "2008").when(k % 3 == 1, "2011").otherwise("1999"), F.lit(":"), k)
    vintage = F.regexp_extract("marker", "^stat([0-9]{4}):", 1)
    return table(spark, sf_dir, "supplier").select(marker.alias("marker")).select("marker", vintage.alias("vintage"), F.split_part("marker", F.lit(":"), F.lit(2)).alias("id"), vintage.isin("2008", "2011").alias("valid"))


@catalog.query("""WITH r AS (SELECT DISTINCT p_brand AS letter FROM part), o AS (SELECT p_brand AS letter, count(*) AS n_rows FROM part WHERE p_size > 10 AND p_brand NOT LIKE '%2' GROUP BY 1), c AS (SELECT letter, CASE WHEN letter LIKE '%1' THEN replace(letter, '1', '9') ELSE letter END AS canonical FROM r)
SELECT letter, canonical, coalesce(n_rows, 0) AS n_rows, CASE WHEN letter LIKE '%2' THEN 'ignored' WHEN canonical <> letter THEN 'corrected' ELSE 'kept' END AS status FROM c LEFT JOIN o USING (letter)""")
def registry_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registry letters in canonical form, with those that are ignored and corrected."""
    letter, part = F.col("letter"), table(spark, sf_dir, "part").withColumnRenamed("p_brand", "letter")
    counted = part.where((F.col("p_size") > 10) & ~letter.endswith("2")).groupBy("letter").agg(F.count("*").alias("n_rows"))
    canonical = F.when(letter.endswith("1"), F.replace(letter, F.lit("1"), F.lit("9"))).otherwise(letter)
    status = F.when(letter.endswith("2"), "ignored").when(canonical != letter, "corrected").otherwise("kept")
    return part.select("letter").distinct().join(counted, "letter", "left").select("letter", canonical.alias("canonical"), F.coalesce("n_rows", F.lit(0)).alias("n_rows"), status.alias("status"))


@catalog.query(r"SELECT doc_id, coalesce(list_max(list_transform(regexp_extract_all(text, '[^ \t\n\x0b\x0c\r]+'), lambda w: length(w))), 0)::INTEGER AS longest_run, coalesce(list_max(list_transform(regexp_extract_all(text, '[^ \t\n\x0b\x0c\r]+'), lambda w: length(w))), 0) >= 16 AS broken FROM documents")
def broken_spacing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts whose longest run without a space shows that spaces are missing."""
    runs = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"([^ \t\n\x0b\x0c\r]+)"), F.lit(1))
    longest = F.coalesce(F.array_max(F.transform(runs, lambda w: F.length(w))), F.lit(0))
    return table(spark, sf_dir, "documents").select("doc_id", longest.alias("longest_run"), (longest >= 16).alias("broken"))


@catalog.query("""WITH a AS (SELECT p_brand AS letter, min(p_name) AS name FROM part WHERE p_size < 3 GROUP BY 1), b AS (SELECT p_brand AS letter, max(p_name) AS name FROM part WHERE p_size < 30 GROUP BY 1), r AS (SELECT p_brand AS letter, count(*) AS votes FROM part WHERE p_size > 45 GROUP BY 1), l AS (SELECT DISTINCT p_brand AS letter FROM part)
SELECT letter, coalesce(CASE WHEN length(b.name) > length(a.name) THEN b.name END, a.name, b.name, letter) AS name, CASE WHEN a.name IS NOT NULL AND NOT coalesce(length(b.name) > length(a.name), false) THEN 'official' WHEN b.name IS NOT NULL THEN 'encyclopedia' ELSE 'letter' END AS source, CASE WHEN coalesce(votes, 0) = 0 THEN 'zero_votes' ELSE 'matched' END AS status
FROM l LEFT JOIN a USING (letter) LEFT JOIN b USING (letter) LEFT JOIN r USING (letter)""")
def registry_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names by the priority of their sources, a clearly longer one first, with the source and a status."""
    part = table(spark, sf_dir, "part").withColumnRenamed("p_brand", "letter")
    official, other = part.where("p_size < 3").groupBy("letter").agg(F.min("p_name").alias("a")), part.where("p_size < 30").groupBy("letter").agg(F.max("p_name").alias("b"))
    votes = part.where("p_size > 45").groupBy("letter").agg(F.count("*").alias("votes"))
    rows = part.select("letter").distinct().join(official, "letter", "left").join(other, "letter", "left").join(votes, "letter", "left")
    longer = F.coalesce(F.length("b") > F.length("a"), F.lit(False))
    source = F.when(F.col("a").isNotNull() & ~longer, "official").when(F.col("b").isNotNull(), "encyclopedia").otherwise("letter")
    return rows.select("letter", F.coalesce(F.when(longer, F.col("b")), "a", "b", "letter").alias("name"), source.alias("source"), F.when(F.coalesce("votes", F.lit(0)) == 0, "zero_votes").otherwise("matched").alias("status"))


@catalog.query("""WITH f AS (SELECT l_suppkey AS locality, l_shipdate AS placed, l_orderkey AS k, l_linenumber AS n, l_quantity FROM lineitem WHERE l_quantity > 20 AND l_discount < 0.05), r AS (SELECT *, row_number() OVER (PARTITION BY locality ORDER BY placed, k, n, l_quantity) AS i FROM f) SELECT locality, k AS source_key, l_quantity AS size FROM r WHERE i = 1""")
def detailed_footprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first source of each locality that is large and plain enough."""
    rows = table(spark, sf_dir, "lineitem").where("l_quantity > 20 and l_discount < 0.05")
    first = ranking.keep_first(rows, ["l_suppkey"], [F.col("l_shipdate"), F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_quantity")])
    return first.select(F.col("l_suppkey").alias("locality"), F.col("l_orderkey").alias("source_key"), F.col("l_quantity").alias("size"))


@catalog.query("""WITH r AS (SELECT p_brand || ':' || p_type AS k, p_size - 3 AS votes, CASE WHEN p_partkey % 4 = 0 THEN 'http://x.org/' || p_partkey ELSE 'https://x.org/' || p_partkey END AS url FROM part), n AS (SELECT k, count(*) AS n FROM r GROUP BY 1)
SELECT k AS registry_key, votes, url, concat_ws('|', CASE WHEN votes < 0 THEN 'negative' END, CASE WHEN NOT regexp_matches(url, '^https://') THEN 'url' END, CASE WHEN n > 60 THEN 'repeated' END) AS faults FROM r JOIN n USING (k)""")
def registry_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registry rows with the faults of each: negative counts, insecure addresses, repeated keys."""
    k = F.col("p_partkey")
    rows = table(spark, sf_dir, "part").select(F.concat_ws(":", "p_brand", "p_type").alias("registry_key"), (F.col("p_size") - 3).alias("votes"), F.concat(F.when(k % 4 == 0, "http://x.org/").otherwise("https://x.org/"), k).alias("url"))
    n = rows.groupBy("registry_key").agg(F.count("*").alias("_n"))
    faults = F.concat_ws("|", F.when(F.col("votes") < 0, "negative"), F.when(normalize.https_url(F.col("url")).isNull(), "url"), F.when(F.col("_n") > 60, "repeated"))
    return rows.join(n, "registry_key").select("registry_key", "votes", "url", faults.alias("faults"))


@catalog.query("SELECT s_suppkey, coalesce(CASE WHEN s_suppkey % 3 = 0 THEN s_name END, CASE WHEN s_suppkey % 3 = 1 THEN 'n' || s_nationkey END, 'id ' || s_suppkey) AS name, CASE WHEN s_suppkey % 3 = 0 THEN 'name' WHEN s_suppkey % 3 = 1 THEN 'nation' ELSE 'id' END AS taken_from FROM supplier")
def fallback_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A required value from the first column that has one, and which that was."""
    k = F.col("s_suppkey")
    choices = [("name", F.when(k % 3 == 0, F.col("s_name"))), ("nation", F.when(k % 3 == 1, F.concat(F.lit("n"), "s_nationkey"))), ("id", F.concat(F.lit("id "), k))]
    taken = F.coalesce(*[F.when(c.isNotNull(), F.struct(c.alias("name"), F.lit(n).alias("taken_from"))) for n, c in choices])
    return table(spark, sf_dir, "supplier").select("s_suppkey", taken.alias("t")).select("s_suppkey", "t.*")


@catalog.query("""WITH m AS (SELECT DISTINCT c_nationkey AS id FROM customer WHERE c_acctbal > 9900), f AS (SELECT n_nationkey AS id, n_regionkey AS composite FROM nation WHERE n_nationkey NOT IN (SELECT id FROM m)), c AS (SELECT composite, string_agg(CAST(id AS VARCHAR), '|' ORDER BY CAST(id AS VARCHAR)) AS components, count(*) AS n FROM f GROUP BY 1)
SELECT composite, components, n, n > 2 AS hides_components FROM c""")
def fallback_display(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Localities without mapped results are shown by their composite, which hides its parts if it has enough."""
    mapped = table(spark, sf_dir, "customer").where("c_acctbal > 9900").select(F.col("c_nationkey").alias("id")).distinct()
    rest = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("id"), F.col("n_regionkey").alias("composite")).join(mapped, "id", "left_anti")
    got = rest.groupBy("composite").agg(aggregate.distinct_joined(F.col("id")).alias("components"), F.count("*").alias("n"))
    return got.withColumn("hides_components", F.col("n") > 2)


@catalog.query("""WITH o AS (SELECT s_nationkey AS id, arg_min(s_name, s_suppkey) AS override_name, arg_min('#' || lpad(CAST(s_suppkey AS VARCHAR), 6, '0'), s_suppkey) AS colour FROM supplier WHERE s_suppkey % 7 < 3 GROUP BY 1)
SELECT n_nationkey AS id, coalesce(override_name, n_name) AS name, coalesce(colour, '#888888') AS colour, regexp_matches(coalesce(colour, '#888888'), '^#[0-9a-f]{6}$') AS valid_colour, override_name IS NOT NULL AS overridden FROM nation LEFT JOIN o ON id = n_nationkey""")
def display_overrides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names and colours of the display, overrides first, with the colours that are none."""
    k = F.col("s_suppkey")
    over = lookup.first_index(table(spark, sf_dir, "supplier").where(k % 7 < 3), "s_nationkey", [k]).select(F.col("s_nationkey").alias("id"), F.col("s_name").alias("override_name"), F.concat(F.lit("#"), F.lpad(k.cast("string"), 6, "0")).alias("colour"))
    rows = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("id"), "n_name").join(over, "id", "left")
    colour = F.coalesce("colour", F.lit("#888888"))
    return rows.select("id", F.coalesce("override_name", "n_name").alias("name"), colour.alias("colour"), colour.rlike("^#[0-9a-f]{6}$").alias("valid_colour"), F.col("override_name").isNotNull().alias("overridden"))


@catalog.query(f"""WITH {FACTS}, s AS (SELECT election, count(*) AS n, count(*) FILTER (area < 20) AS stat, count(*) FILTER (region < 4) AS loc FROM facts GROUP BY 1)
SELECT election, 'statistical' AS mode, stat AS covered, n AS total, round_even(stat / n::DOUBLE * 1e6, 0) / 1e6 AS share FROM s UNION ALL SELECT election, 'locality', loc, n, round_even(loc / n::DOUBLE * 1e6, 0) / 1e6 FROM s""")
def coverage_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One summary row's columns by prefix, as a row for each mode."""
    got = facts(spark, sf_dir).groupBy("election").agg(F.count("*").alias("total"), F.count_if(F.col("area") < 20).alias("statistical_covered"), F.count_if(F.col("region") < 4).alias("locality_covered"))
    long = got.unpivot(["election", "total"], ["statistical_covered", "locality_covered"], "mode", "covered")
    return long.select("election", F.regexp_replace("mode", "_covered$", "").alias("mode"), "covered", "total", normalize.share(F.col("covered"), F.col("total")).alias("share"))


@catalog.query("""WITH m AS (SELECT o_orderkey, o_custkey, count(*) OVER (PARTITION BY o_custkey, date_trunc('day', o_orderdate)) AS n FROM orders) SELECT o_orderkey, n, CASE WHEN n = 1 THEN 'matched' ELSE 'ambiguous' END AS status FROM m WHERE o_custkey % 3 <> 0 UNION ALL SELECT o_orderkey, 0, 'not_found' FROM m WHERE o_custkey % 3 = 0""")
def match_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each fact with the number of rules that match it: none, one, or too many."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("day"))
    rules = orders.where("o_custkey % 3 <> 0").groupBy("o_custkey", "day").agg(F.count("*").alias("n"))
    n = F.coalesce("n", F.lit(0))
    return orders.join(rules, ["o_custkey", "day"], "left").select("o_orderkey", n.alias("n"), F.when(n == 0, "not_found").when(n == 1, "matched").otherwise("ambiguous").alias("status"))


@catalog.query("SELECT l_returnflag, '{' || string_agg('\"' || l_linestatus || '\":' || n, ',' ORDER BY l_linestatus) || '}' AS value_counts FROM (SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY 1, 2) GROUP BY 1")
def value_count_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts by value as one map."""
    counts = table(spark, sf_dir, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"))
    return counts.groupBy("l_returnflag").agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct("l_linestatus", "n"))))).alias("value_counts"))


@catalog.query("""WITH w AS (SELECT c_nationkey, c_custkey // 2 AS grp, CAST(round(c_acctbal * 100) AS BIGINT) AS a, c_custkey % 5 AS b FROM customer), g AS (SELECT grp, CAST(sum(a) AS BIGINT) AS a, CAST(sum(b) AS BIGINT) AS b, count(*) AS n, count(DISTINCT c_nationkey) AS areas FROM w GROUP BY 1)
SELECT grp, a, b, n, CASE WHEN areas > 1 THEN 'hidden_conflict' WHEN n = 1 THEN 'single' ELSE 'collapsed' END AS status FROM g""")
def group_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Display groups with every additive column summed; a group over several areas is in conflict."""
    rows = table(spark, sf_dir, "customer").select("c_nationkey", F.floor(F.col("c_custkey") / 2).alias("grp"), cents("c_acctbal").alias("a"), (F.col("c_custkey") % 5).alias("b"))
    additive = nested.other_columns(rows, {"c_nationkey", "grp"})
    got = rows.groupBy("grp").agg(*[F.sum(c).alias(c) for c in additive], F.count("*").alias("n"), F.countDistinct("c_nationkey").alias("areas"))
    return got.select("grp", *additive, "n", F.when(F.col("areas") > 1, "hidden_conflict").when(F.col("n") == 1, "single").otherwise("collapsed").alias("status"))


@catalog.query("""WITH t AS (SELECT DISTINCT l_partkey AS old, l_suppkey AS new FROM lineitem WHERE l_quantity > 49), f AS (SELECT old, min(new) AS new, count(*) AS n FROM t GROUP BY 1), r AS (SELECT new, count(*) AS m FROM t GROUP BY 1)
SELECT old, f.new, CASE WHEN n > 1 THEN 'split' WHEN m > 1 THEN 'merged' WHEN old % 7 = f.new % 7 THEN 'validated' ELSE 'unconfirmed' END AS status FROM f JOIN r USING (new)""")
def validated_transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transitions that are unique both ways, and whether other evidence confirms them."""
    links = table(spark, sf_dir, "lineitem").where("l_quantity > 49").select(F.col("l_partkey").alias("old"), F.col("l_suppkey").alias("new")).distinct()
    forward, back = links.groupBy("old").agg(F.min("new").alias("new"), F.count("*").alias("n")), links.groupBy("new").agg(F.count("*").alias("m"))
    status = F.when(F.col("n") > 1, "split").when(F.col("m") > 1, "merged").when(F.col("old") % 7 == F.col("new") % 7, "validated").otherwise("unconfirmed")
    return forward.join(back, "new").select("old", "new", status.alias("status"))


@catalog.query("""WITH n AS (SELECT count(o_orderkey) AS o_orderkey, count(o_custkey) AS o_custkey, count(o_orderstatus) AS o_orderstatus, count(*) FILTER (o_orderkey % 3 = 0) AS fill_color FROM orders)
SELECT name, n_values, regexp_matches(name, '(color|colour|fill|stroke)') AND n_values > 0 AS forbidden FROM n UNPIVOT (n_values FOR name IN (o_orderkey, o_custkey, o_orderstatus, fill_color))""")
def colour_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns of a release with their values; one of presentation that holds any may not be in it."""
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", F.when(F.col("o_orderkey") % 3 == 0, "#fff").alias("fill_color"))
    counted = rows.agg(*[F.count(c).alias(c) for c in rows.columns]).unpivot([], rows.columns, "name", "n_values")
    return counted.withColumn("forbidden", F.col("name").rlike("(color|colour|fill|stroke)") & (F.col("n_values") > 0))


@catalog.query("""SELECT DISTINCT event_id, user_id, event_type FROM events""")
def saved_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events once each, through a table in the shared folder: what a stream drops as repeated."""
    return saved(table(spark, sf_dir, "events").select("event_id", "user_id", "event_type").dropDuplicates(["event_id"]), "once")
