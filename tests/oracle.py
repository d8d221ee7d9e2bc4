"""Compare a Spark query with its DuckDB SQL: same columns, same rows in any order."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for t in TABLES:
        if Path(f"{sf_dir}/{t}.parquet").exists():
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else v
    return tuple(map(_plain, v)) if isinstance(v, list | tuple) else v


def rows_of(rows, names: list[str]) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def difference(spark, query, sql: str, sf_dir: str) -> str:
    """'' where they agree, else what differs."""
    df = query(spark, sf_dir)
    own = rows_of(df.collect(), df.columns)
    got = connect(sf_dir).sql(sql)
    theirs = rows_of(got.fetchall(), got.columns)
    if sorted(df.columns) != sorted(got.columns):
        return f"columns {sorted(df.columns)} and {sorted(got.columns)}"
    if own == theirs:
        return ""
    odd = next(((a, b) for a, b in zip(own, theirs, strict=False) if a != b), None)
    return f"{len(own)} and {len(theirs)} rows; first difference {odd}"
