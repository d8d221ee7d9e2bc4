"""All queries over the driver's tables, with their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import assets, audits, evidence, indexes, lookups, maps, packages, results, rules, shapes, texts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
for _part in (results, lookups, rules, evidence, texts, shapes, audits, assets, maps, packages, indexes):
    QUERIES |= _part.catalog.queries
    ORACLE_SQL |= _part.catalog.oracle
