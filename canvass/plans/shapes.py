"""Coordinate arrays, grid joins, fingerprints and releases."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import nested
from ..operators import aggregate, geometry
from ..sources import release
from ._tables import Catalog, table

catalog = Catalog()

_XY = "list_filter(embedding, lambda x, i: i % 2 = 1) AS xs, list_filter(embedding, lambda x, i: i % 2 = 0) AS ys"


@catalog.query(f"""WITH p AS (SELECT vec_id, {_XY} FROM embeddings) SELECT vec_id, list_min(xs)::DOUBLE AS min_x, list_min(ys)::DOUBLE AS min_y, list_max(xs)::DOUBLE AS max_x, list_max(ys)::DOUBLE AS max_y,
round_even((list_min(xs)::DOUBLE + list_max(xs)::DOUBLE) / 2 * 1e6, 0) / 1e6 AS x, round_even((list_min(ys)::DOUBLE + list_max(ys)::DOUBLE) / 2 * 1e6, 0) / 1e6 AS y FROM p""")
def bbox_center(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = nested.pairs_of(F.col("embedding"))
    rows = table(spark, sf_dir, "embeddings").select("vec_id", nested.bounds(points).alias("box"))
    return rows.select("vec_id", "box.*", nested.centre(F.col("box")).alias("c")).select("vec_id", "min_x", "min_y", "max_x", "max_y", "c.x", "c.y")


@catalog.query("""SELECT vec_id, CAST(len(embedding) // 2 AS INT) AS vertices, CASE WHEN len(embedding) // 2 <= 12 THEN 'marker' ELSE 'polygon' END AS display FROM embeddings""")
def vertex_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.size(nested.pairs_of(F.col("embedding")))
    return table(spark, sf_dir, "embeddings").select("vec_id", n.alias("vertices"), geometry.display_mode(n).alias("display"))


@catalog.query("""SELECT vec_id, list_transform(embedding, lambda x: round_even(x::DOUBLE * 1e6, 0) / 1e6) AS rounded FROM embeddings""")
def coord_round(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select("vec_id", nested.rounded(F.col("embedding")).alias("rounded"))


@catalog.query("""WITH b AS (SELECT p_partkey AS id, p_partkey % 97 * 1.0 AS min_x, p_size * 1.0 AS min_y, p_partkey % 97 + 1.5 AS max_x, p_size + 0.5 AS max_y FROM part)
SELECT a.id AS a, b.id AS b FROM b a JOIN b ON a.id < b.id AND greatest(a.min_x, b.min_x) < least(a.max_x, b.max_x) AND greatest(a.min_y, b.min_y) < least(a.max_y, b.max_y)""")
def grid_overlap_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    x, y = (F.col("p_partkey") % 97).cast("double"), F.col("p_size").cast("double")
    box = F.struct(x.alias("min_x"), y.alias("min_y"), (x + 1.5).alias("max_x"), (y + 0.5).alias("max_y"))
    return geometry.overlapping(table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), box.alias("box")), "id", "box", 4.0)


@catalog.query("""WITH l AS (SELECT o_orderstatus, o_orderkey || '|' || o_custkey AS line, substr(sha256(CAST(o_orderkey AS VARCHAR)), 1, 3) AS slice FROM orders),
p AS (SELECT o_orderstatus, slice, count(*) AS n, sha256(string_agg(line, chr(10) ORDER BY line)) AS sha FROM l GROUP BY 1, 2)
SELECT o_orderstatus, CAST(sum(n) AS BIGINT) AS n_rows, sha256(string_agg(slice || '|' || sha, chr(10) ORDER BY slice || '|' || sha)) AS sha256 FROM p GROUP BY 1""")
def fingerprint_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregate.fingerprint(table(spark, sf_dir, "orders"), "o_orderstatus", "o_orderkey", "o_custkey")


@catalog.query("""WITH a AS (SELECT 'nation/' || n_nationkey AS path, sha256(n_name) AS sha FROM nation)
SELECT substr(sha256(string_agg(path || ':' || sha, chr(10) ORDER BY path)), 1, 16) AS build_id, count(*) AS n_assets FROM a""")
def content_build_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    assets = table(spark, sf_dir, "nation").select(F.concat(F.lit("nation/"), "n_nationkey").alias("path"), F.sha2("n_name", 256).alias("sha"))
    return release.build_id(assets, "path", "sha")


@catalog.query("""SELECT n_nationkey, '{"type":"Feature","properties":{"name":"' || n_name || '"},"geometry":{"type":"Point","coordinates":[' || n_nationkey || '.5,' || n_regionkey || '.5]}}' AS feature FROM nation""")
def feature_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = F.array(F.col("n_nationkey") + 0.5, F.col("n_regionkey") + 0.5).cast("array<double>")
    return table(spark, sf_dir, "nation").select("n_nationkey", release.feature_json(F.struct(F.col("n_name").alias("name")), F.lit("Point"), at).alias("feature"))
