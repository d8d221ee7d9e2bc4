"""Workbooks, tables of pages, Geobuf files, composites, fallbacks and hidden areas, outlines, plan summaries."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import normalize
from ..operators import contracts, coverage, lookup, ranking
from ..sources import files, geobuf, release, workbook
from ..storage import saved, shared_dir
from . import audits
from ._tables import Catalog, cents, table
from .maps import ACROSS, _sql_corner, cells

catalog = Catalog()


@catalog.query("SELECT 'k' || c_nationkey || '.xlsx' AS path, CAST(c_custkey AS VARCHAR) AS code, c_name AS name, c_mktsegment AS ballot FROM customer")
def workbook_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A workbook for each nation, header in row 10 of its last sheet, read by position under new names."""
    rows = table(spark, sf_dir, "customer")
    books = saved(workbook.grouped(rows, F.concat(F.lit("k"), "c_nationkey", F.lit(".xlsx")), ["c_custkey", "c_name", "c_mktsegment"], 10), "books")
    return workbook.last_sheet(books, 10, ["code", "name", "ballot"]).drop("row")


@catalog.query("""SELECT o_custkey AS page_id, CAST(o_orderkey AS VARCHAR) AS letter, CASE WHEN o_orderkey % 3 = 0 THEN 'The list of ' || o_orderpriority ELSE o_orderpriority || ' & co' END AS name, o_custkey * 1000 + o_orderkey % 1000 AS votes FROM orders""")
def html_header_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with several tables: the one with the wanted header, columns in its own order, the longer of title and text."""
    k, long = F.col("o_orderkey"), F.col("o_orderkey") % 3 == 0
    shown = F.concat(F.when(long, F.concat(F.lit('<td title="The list of '), "o_orderpriority", F.lit('">'), F.lit("short"))).otherwise(F.concat(F.lit('<td title="x"><b>'), "o_orderpriority", F.lit("</b> &amp;\n co"))), F.lit("</td>"))
    row = F.concat(F.lit("<tr><td>"), k, F.lit("</td>"), shown, F.lit("<td>"), F.format_number(F.col("o_custkey") * 1000 + k % 1000, 0), F.lit(" votes</td></tr>"))
    bodies = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("page_id")).agg(F.array_join(F.array_sort(F.collect_list(row)), "").alias("body"))
    head = "<table><tr><td>menu</td></tr><tr><td>home</td></tr></table><table><tr><th>Letters</th><th>Name of  list</th><th>Votes</th></tr><tbody>"
    pages = bodies.select("page_id", F.concat(F.lit(head), "body", F.lit("<tr><td>7</td></tr></tbody></table>")).alias("html"))
    found = files.html_records(pages, "page_id", "html", {"Name of list": "name", "Letters": "letter"})
    return found.select("page_id", "letter", "name", normalize.int_value(F.col("last")).alias("votes"))


@catalog.query("""SELECT 'n' || c_nationkey AS path, CAST(c_custkey AS VARCHAR) AS id, c_name AS name, CAST(CAST(round(c_acctbal * 100) AS BIGINT) AS VARCHAR) AS cents, CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE c_mktsegment END AS segment FROM customer""")
def geobuf_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A Geobuf file for each nation, decoded again: ids, tables of keys and values, missing properties."""
    rows = table(spark, sf_dir, "customer").select(F.concat(F.lit("n"), "c_nationkey").alias("path"), "c_custkey", "c_name", cents("c_acctbal").alias("cents"), F.when(F.col("c_custkey") % 4 != 0, F.col("c_mktsegment")).alias("segment"))

    def made(frame):
        import pandas as pd

        listed = [(str(k), {"name": n, "cents": int(c), "segment": s}) for k, n, c, s in zip(frame["c_custkey"], frame["c_name"], frame["cents"], frame["segment"], strict=True)]
        return pd.DataFrame({"path": [frame["path"].iloc[0]], "content": [geobuf.encoded(listed)]})

    found = geobuf.features_of(saved(rows.groupBy("path").applyInPandas(made, "path string, content binary"), "geobuf"))
    return found.select("path", "id", *(F.col("properties")[c].alias(c) for c in ("name", "cents", "segment")))


@catalog.query("SELECT c_custkey, CAST(round(c_acctbal * 100) AS BIGINT)::DOUBLE AS number FROM customer")
def strict_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers that must be numbers: blanks around them are allowed, anything else fails the job."""
    return table(spark, sf_dir, "customer").select("c_custkey", normalize.strict_number(F.concat(F.lit(" "), cents("c_acctbal"), F.lit("  "))).alias("number"))


@catalog.query("SELECT l_returnflag, count(*) AS n FROM lineitem GROUP BY 1")
def keys_required(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows counted once it is sure that none lacks a key."""
    return contracts.require_present(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_returnflag"], "lines").groupBy("l_returnflag").agg(F.count("*").alias("n"))


_COMPOSITES = """r AS (SELECT c_nationkey AS locality, count(*) AS n FROM customer WHERE c_acctbal > 9000 GROUP BY 1),
c AS (SELECT s_suppkey AS composite, s_nationkey AS host, CASE WHEN s_suppkey % 11 = 0 THEN [(s_nationkey + 1) % 25] ELSE [s_nationkey, (s_nationkey + s_suppkey) % 25] END AS components FROM supplier WHERE s_suppkey % 3 = 0)"""


def _composites(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, n = F.col("s_suppkey"), F.col("s_nationkey")
    parts = F.when(k % 11 == 0, F.array((n + 1) % 25)).otherwise(F.array(n, ((n + k) % 25).cast("int")))
    return table(spark, sf_dir, "supplier").where(k % 3 == 0).select(k.alias("composite"), n.alias("host"), parts.alias("components"))


@catalog.query(f"""WITH {_COMPOSITES} SELECT composite, host, 'invalid' AS fault FROM c WHERE NOT list_contains(components, host)
UNION ALL SELECT composite, host, 'host_twice' FROM c WHERE host IN (SELECT host FROM c GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT composite, host, 'no_host_result' FROM c WHERE host NOT IN (SELECT locality FROM r)
UNION ALL SELECT DISTINCT composite, host, 'hides_result' FROM (SELECT composite, host, unnest(components) AS part FROM c) WHERE part <> host AND part IN (SELECT locality FROM r)""")
def composite_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four faults that keep a composite from standing for its host."""
    results = table(spark, sf_dir, "customer").where("c_acctbal > 9000").groupBy(F.col("c_nationkey").alias("locality")).agg(F.count("*").alias("n"))
    return lookup.composite_faults(results, "locality", _composites(spark, sf_dir))


@catalog.query("""WITH f AS (SELECT s_suppkey, 'f' || s_suppkey % 60 AS id, CASE WHEN s_suppkey % 9 = 0 THEN '' ELSE 'l' || s_nationkey END AS locality, 'K' || s_suppkey % 7 % 2 AS election FROM supplier),
n AS (SELECT *, count(*) OVER (PARTITION BY id) AS times FROM f), g AS (SELECT DISTINCT 'l' || c_nationkey AS locality FROM customer WHERE c_acctbal > 9000)
SELECT s_suppkey, CASE WHEN n.locality = '' OR election <> 'K1' THEN 'invalid' WHEN times > 1 THEN 'duplicate' WHEN n.locality NOT IN (SELECT locality FROM g) THEN 'no_geometry' ELSE '' END AS fault FROM n""")
def fallback_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fallback rows of another election, without a locality, with an id that stands twice, or without geometry."""
    k = F.col("s_suppkey")
    rows = table(spark, sf_dir, "supplier").select(k, F.concat(F.lit("f"), k % 60).alias("id"), F.when(k % 9 == 0, "").otherwise(F.concat(F.lit("l"), "s_nationkey")).alias("locality"), F.concat(F.lit("K"), k % 7 % 2).alias("election"))
    times = rows.groupBy("id").agg(F.count("*").alias("times"))
    shapes = table(spark, sf_dir, "customer").where("c_acctbal > 9000").select(F.concat(F.lit("l"), "c_nationkey").alias("locality")).distinct().withColumn("shape", F.lit(True))
    fault = F.when((F.col("locality") == "") | (F.col("election") != "K1"), "invalid").when(F.col("times") > 1, "duplicate").when(F.col("shape").isNull(), "no_geometry").otherwise("")
    return rows.join(times, "id").join(shapes, "locality", "left").select("s_suppkey", fault.alias("fault"))


@catalog.query("""WITH c AS (SELECT s_nationkey AS locality, unnest(CASE WHEN s_suppkey % 2 = 0 THEN [s_nationkey, (s_nationkey + 3) % 25] ELSE [s_nationkey] END) AS part FROM supplier WHERE s_acctbal > 5000)
SELECT DISTINCT c_custkey FROM customer WHERE c_acctbal < 0 AND c_nationkey IN (SELECT part FROM c)""")
def hidden_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Areas that a fallback hides: those of its locality, or of all parts where it is a composite."""
    n = F.col("s_nationkey")
    parts = F.when(F.col("s_suppkey") % 2 == 0, F.array(n, ((n + 3) % 25).cast("int"))).otherwise(F.array(n))
    hidden = table(spark, sf_dir, "supplier").where("s_acctbal > 5000").select(F.explode(parts).alias("c_nationkey")).distinct()
    return table(spark, sf_dir, "customer").where("c_acctbal < 0").join(hidden, "c_nationkey", "left_semi").select("c_custkey")


@catalog.query("""WITH c AS (SELECT 'c' || s_suppkey AS id, s_suppkey % 4 = 1 AS active, ['l' || s_nationkey, 'l' || s_suppkey % 25] AS parts FROM supplier WHERE s_suppkey % 2 = 1)
SELECT unnest(parts) AS locality FROM c WHERE active UNION SELECT id FROM c WHERE NOT active""")
def hidden_localities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An active composite hides its parts; one that is not active is hidden itself."""
    k = F.col("s_suppkey")
    hidden = F.when(k % 4 == 1, F.array(F.concat(F.lit("l"), "s_nationkey"), F.concat(F.lit("l"), k % 25))).otherwise(F.array(F.concat(F.lit("c"), k)))
    return table(spark, sf_dir, "supplier").where(k % 2 == 1).select(F.explode(hidden).alias("locality")).distinct()


@catalog.query("""WITH p AS (SELECT p_brand AS election, CASE p_size % 6 WHEN 0 THEN 'component' WHEN 1 THEN 'override' WHEN 2 THEN CASE WHEN p_partkey % 2 = 0 THEN 'locality_single' ELSE 'locality_pending' END WHEN 3 THEN 'crosswalk' ELSE 'unresolved' END AS method,
p_size % 6 < 4 AND NOT (p_size % 6 = 2 AND p_partkey % 2 = 1) AS mapped FROM part), m AS (SELECT election, count(*) AS n_rows, count(*) FILTER (mapped) AS n_mapped, max(CASE WHEN method = 'override' THEN 1 ELSE 0 END) = 1 AS has_overrides FROM p GROUP BY 1),
c AS (SELECT election, method, count(*) AS n FROM p GROUP BY 1, 2)
SELECT c.election, method, n, n_rows, n_mapped, round_even(n_mapped / n_rows::DOUBLE * 1e6, 0) / 1e6 AS mapped_share, has_overrides FROM c JOIN m USING (election)""")
def plan_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The assignment plan of each election by method, beside the election's totals and share of mapped rows."""
    plan = audits.assignment_plan(spark, sf_dir).join(table(spark, sf_dir, "part").select("p_partkey", F.col("p_brand").alias("election")), "p_partkey")
    counts = plan.groupBy("election", "method", "mapped").agg(F.count("*").alias("n"))
    total = counts.groupBy("election").agg(F.sum("n").alias("n_rows"), F.coalesce(F.sum(F.when(F.col("mapped"), F.col("n"))), F.lit(0)).alias("n_mapped"), F.max(F.col("method") == "override").alias("has_overrides"))
    return counts.groupBy("election", "method").agg(F.sum("n").alias("n")).join(total, "election").select("election", "method", "n", "n_rows", "n_mapped", normalize.share(F.col("n_mapped"), F.col("n_rows")).alias("mapped_share"), "has_overrides")


@catalog.query("""WITH f AS (SELECT 'brand|size' || CASE WHEN p_size % 10 = 0 THEN '' ELSE '|type' END || CASE WHEN p_partkey % 50 = 0 THEN '|zone' ELSE '' END AS fields FROM part)
SELECT fields, count(*) AS n, CASE WHEN contains(fields, 'type') THEN '' ELSE 'type' END AS lacking, CASE WHEN contains(fields, 'zone') THEN 'zone' ELSE '' END AS more FROM f GROUP BY 1""")
def field_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features by their set of dynamic fields, and how each set differs from the usual one."""
    given = F.map_filter(F.create_map(F.lit("brand"), F.col("p_brand"), F.lit("size"), F.col("p_size").cast("string"), F.lit("type"), F.when(F.col("p_size") % 10 != 0, F.col("p_type")), F.lit("zone"), F.when(F.col("p_partkey") % 50 == 0, "z")), lambda _, v: v.isNotNull())
    return contracts.field_sets(table(spark, sf_dir, "part").select(given.alias("properties")), "properties")


def _outline_sql(where: str) -> str:
    corners = [_sql_corner(*c) for c in (("i", "j"), ("(i + 1)", "j"), ("(i + 1)", "(j + 1)"), ("i", "(j + 1)"))]
    sides = " UNION ALL ".join(f"SELECT g, {a}, {b} FROM c" for a, b in zip(corners, [*corners[1:], corners[0]], strict=True))
    return f"""(WITH c AS (SELECT c_nationkey AS g, c_custkey % {ACROSS} AS i, c_custkey // {ACROSS} AS j FROM customer WHERE {where}), e(g, x1, y1, x2, y2) AS ({sides})
SELECT g, count(*) AS vertices, sum(x1 * y2 - x2 * y1) / 2.0::DOUBLE AS area FROM e WHERE NOT EXISTS (SELECT 1 FROM e r WHERE r.g = e.g AND r.x1 = e.x2 AND r.y1 = e.y2 AND r.x2 = e.x1 AND r.y2 = e.y1) GROUP BY g HAVING count(*) > 12 AND area > 40000)"""


@catalog.query(f"""WITH s AS (SELECT 0 AS place, 'newer' AS source, * FROM {_outline_sql("c_mktsegment = 'BUILDING'")} UNION ALL SELECT 1, 'older', * FROM {_outline_sql("c_mktsegment <> 'BUILDING'")})
SELECT g AS nation, arg_min(source, place) AS source, arg_min(vertices, place) AS vertices, arg_min(area, place) AS area FROM s GROUP BY g""")
def detailed_outlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each nation's outline from the first source whose union has over 12 vertices and enough area."""
    found = []
    for place, (source, where) in enumerate((("newer", "segment = 'BUILDING'"), ("older", "segment <> 'BUILDING'"))):
        rings = coverage.ring_summary(coverage.dissolved(coverage.edges(cells(spark, sf_dir).where(where), ["nation"], "ring"), "nation"), "nation")
        sums = rings.groupBy("nation").agg(F.sum("n_edges").alias("vertices"), F.sum("area").alias("area")).where("vertices > 12 and area > 40000")
        found.append(sums.select("nation", F.lit(source).alias("source"), F.lit(place).alias("place"), "vertices", "area"))
    return ranking.keep_first(found[0].unionByName(found[1]), ["nation"], [F.col("place")]).select("nation", "source", "vertices", "area")


_CUSTOMER_LINES = """WITH l AS (SELECT c_nationkey % 3 AS part, c_custkey, concat_ws(',', c_custkey, c_name, CASE WHEN c_custkey % 5 = 0 THEN concat(chr(34), 'a, ', chr(34), chr(34), 'b', chr(34), chr(34), chr(34)) ELSE c_mktsegment END) AS line FROM customer),
f AS (SELECT 'part' || part || '.csv' AS name, chr(65279) || 'c_custkey,c_name,note' || chr(10) || string_agg(line || chr(10), '' ORDER BY c_custkey) AS text FROM l GROUP BY part)"""


@catalog.query(f"{_CUSTOMER_LINES} SELECT name, octet_length(encode(text)) AS bytes, sha256(text) AS sha256, true AS same_for_one_part FROM f")
def stable_exports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV files of several parts joined, zipped and unzipped again: the bytes do not depend on how the rows were dealt."""
    k, folder = F.col("c_custkey"), f"{shared_dir(spark)}/exports-{uuid.uuid4().hex}"
    rows = table(spark, sf_dir, "customer").select(k, "c_name", F.when(k % 5 == 0, 'a, "b"').otherwise(F.col("c_mktsegment")).alias("note"), (F.col("c_nationkey") % 3).alias("part"))
    once, again = ([release.export_csv(rows.where(F.col("part") == p).drop("part"), ["c_custkey"], f"{folder}/{n}/part{p}.csv", parts=n) for p in range(3)] for n in (8, 1))
    same = {e["path"]: e == f for e, f in zip(once, again, strict=True)}
    release.stable_zip(spark, [f"{folder}/8/{e['path']}" for e in once], f"{folder}/zip/all.zip")
    found = release.unzipped(spark.read.format("binaryFile").load(f"{folder}/zip"))
    equal = F.create_map(*[F.lit(x) for pair in same.items() for x in pair])
    return found.select("name", F.octet_length("content").cast("long").alias("bytes"), F.sha2("content", 256).alias("sha256"), equal[F.col("name")].alias("same_for_one_part"))
