"""Tables of a data folder, and the roles they play.

orders are the facts (o_orderkey is the row id, o_orderstatus the election), a customer's nation the area,
its region the group of areas, market segments and priorities the parties; lineitem, supplier and events
are further evidence; embeddings are coordinate arrays.  Money is counted in cents, so sums are exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
FLAGS = ["A", "N", "R"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cents(c: str) -> Column:
    return F.round(F.col(c) * 100).cast("bigint")


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """o_orderkey, election, area, region, party (segment), custkey, cents."""
    orders, customer, nation = (table(spark, sf_dir, t) for t in ("orders", "customer", "nation"))
    areas = customer.join(nation, customer["c_nationkey"] == nation["n_nationkey"])
    return orders.join(areas, orders["o_custkey"] == areas["c_custkey"]).select(
        "o_orderkey", F.col("o_orderstatus").alias("election"), F.col("c_nationkey").alias("area"), F.col("n_regionkey").alias("region"), F.col("c_mktsegment").alias("party"), F.col("o_custkey").alias("custkey"), cents("o_totalprice").alias("cents")
    )


#: The same rows in SQL, for the oracle.
FACTS = """facts AS (
  SELECT o_orderkey, o_orderstatus AS election, c_nationkey AS area, n_regionkey AS region, c_mktsegment AS party, o_custkey AS custkey,
         CAST(round(o_totalprice * 100) AS BIGINT) AS cents
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""


class Catalog:
    """Queries by name, each with its SQL where SQL can express it."""

    def __init__(self) -> None:
        self.queries: dict = {}
        self.oracle: dict[str, str] = {}

    def query(self, sql: str | None = None):
        def add(f):
            self.queries[f.__name__] = f
            if sql:
                self.oracle[f.__name__] = sql
            return f

        return add
