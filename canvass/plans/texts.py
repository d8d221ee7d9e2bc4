"""Normalisers over text columns, JSON, HTML, streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import normalize as N
from ..streaming import events
from ._tables import Catalog, table

catalog = Catalog()


@catalog.query(r"""SELECT doc_id, trim(regexp_replace(text, '[\s\x{85}\x{A0}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+', ' ', 'g')) AS text FROM documents""")
def normalize_spaces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", N.spaces(F.col("text")).alias("text"))


@catalog.query(r"""SELECT page_id, lower(regexp_replace(url, '[^\p{L}\p{N}]+', '', 'g')) AS name, trim(regexp_replace(lower(url), '[^a-z0-9]+', '_', 'g'), '_') AS slug FROM pages""")
def normalize_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", N.name_key(F.col("url")).alias("name"), N.slug(F.col("url")).alias("slug"))


_MESSY = "CASE WHEN c_custkey % 3 = 0 THEN '00' || c_custkey || '.0' WHEN c_custkey % 3 = 1 THEN c_custkey || '-12' ELSE c_custkey || '.50' END"


def _messy(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    text = F.when(k % 3 == 0, F.concat(F.lit("00"), k, F.lit(".0"))).when(k % 3 == 1, F.concat(k, F.lit("-12"))).otherwise(F.concat(k, F.lit(".50")))
    return table(spark, sf_dir, "customer").select("c_custkey", text.alias("t"))


@catalog.query(rf"""WITH m AS (SELECT c_custkey, {_MESSY} AS t FROM customer)
SELECT c_custkey, CAST(CAST(regexp_replace(t, '[^0-9]', '', 'g') AS BIGINT) AS VARCHAR) AS digits, CASE WHEN c_custkey % 3 = 1 THEN CAST(CAST(regexp_replace(t, '[^0-9]', '', 'g') AS BIGINT) AS VARCHAR) ELSE CAST(c_custkey AS VARCHAR) END AS code FROM m""")
def normalize_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two normalisers that differ on purpose: all digits, and the whole part of a decimal."""
    t = F.col("t")
    return _messy(spark, sf_dir).select("c_custkey", N.digits_code(t).alias("digits"), N.decimal_code(t).alias("code"))


@catalog.query(rf"""WITH m AS (SELECT c_custkey, {_MESSY} AS t FROM customer)
SELECT c_custkey, CAST(regexp_extract(t, '-?[0-9]+') AS BIGINT) AS whole, CASE WHEN c_custkey % 3 = 2 THEN c_custkey || '.5' WHEN c_custkey % 3 = 0 THEN '00' || c_custkey ELSE c_custkey || '' END AS ballot, CASE WHEN c_custkey % 2 = 0 THEN c_custkey // 10 ELSE c_custkey END AS base FROM m""")
def int_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("t")
    return _messy(spark, sf_dir).select("c_custkey", N.int_value(t).alias("whole"), N.ballot_text(t).alias("ballot"), N.ballot_base(t, F.col("c_custkey") % 2 == 0).alias("base"))


@catalog.query("""WITH l AS (SELECT p_brand, unnest(list_distinct(list_filter([trim(p_type), trim(p_name), trim(p_type), ''], lambda x: x <> ''))) AS v FROM part) SELECT p_brand, v, count(*) AS n FROM l GROUP BY 1, 2""")
def pipe_list_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = F.concat_ws("|", "p_type", F.concat(F.lit(" "), "p_name"), "p_type", F.lit(""))
    return table(spark, sf_dir, "part").select("p_brand", F.explode(N.pipe_list(joined)).alias("v")).groupBy("p_brand", "v").agg(F.count("*").alias("n"))


@catalog.query(r"""SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title, CAST(len(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS INT) AS n_links, CASE WHEN regexp_matches(url, '^https://[^\s/?#]+([/?#]\S*)?$') THEN url END AS https_url FROM pages""")
def html_links_or_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = F.size(F.regexp_extract_all("html", F.lit('<a href="([^"]*)"'), F.lit(1)))
    return table(spark, sf_dir, "pages").select("page_id", F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"), links.alias("n_links"), N.https_url(F.col("url")).alias("https_url"))


@catalog.query("""SELECT event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) % 10 AS bucket, count(*) AS n, CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS total FROM events GROUP BY 1, 2""")
def json_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("bigint")
    return table(spark, sf_dir, "events").select("event_type", k.alias("k")).groupBy("event_type", (F.col("k") % 10).alias("bucket")).agg(F.count("*").alias("n"), F.sum("k").alias("total"))


@catalog.query("""WITH h AS (SELECT n_name, list_reduce([2166136261::HUGEINT] || list_transform(string_split(n_name, ''), lambda x: ascii(x)::HUGEINT), lambda a, c: ((xor(a::BIGINT, c::BIGINT))::HUGEINT * 16777619) % 4294967296) AS h FROM nation)
SELECT n_name, CAST(abs(CASE WHEN h >= 2147483648 THEN h - 4294967296 ELSE h END) % 360 AS INT) AS hue FROM h""")
def stable_hue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select("n_name", N.stable_hue(F.col("n_name")).alias("hue"))


@catalog.query("""SELECT conv_id, turn, CASE WHEN role IN ('user', 'system') THEN 'in' ELSE 'out' END AS side, format('{:+d}', turn - 1) AS note FROM conversations""")
def template_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", F.when(F.col("role").isin("user", "system"), "in").otherwise("out").alias("side"), F.format_string("%+d", F.col("turn") - 1).alias("note"))


@catalog.query("""SELECT date_trunc('day', ts) AS start, event_type, count(*) AS n, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents FROM events GROUP BY 1, 2""")
def windowed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extension: tumbling windows, the same function as on a stream."""
    return events.windowed_counts(table(spark, sf_dir, "events"))


@catalog.query("""WITH g AS (SELECT *, ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) >= INTERVAL 6 HOUR AS new FROM events), s AS (SELECT *, sum(CASE WHEN new THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts) AS k FROM g)
SELECT user_id, min(ts) AS start, count(*) AS n FROM s GROUP BY user_id, k""")
def sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extension: session windows."""
    return events.sessions(table(spark, sf_dir, "events"))
