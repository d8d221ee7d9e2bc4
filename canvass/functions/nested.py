"""Arrays and structs: rows of dynamic columns, ranked votes, coordinates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .normalize import round6


def other_columns(df: DataFrame, known: set[str]) -> list[str]:
    """The dynamic columns of a wide table: all that are not known, in order."""
    return [c for c in df.columns if c not in known]


def row_sum(*columns: Column) -> Column:
    return reduce(lambda a, b: a + b, [F.coalesce(c, F.lit(0)) for c in columns], F.lit(0).cast("bigint"))


def votes_array(parties: list[str]) -> Column:
    """Wide vote columns as an array of (votes, -place, party), largest first; ties keep column order."""
    made = F.array(*[F.struct(F.coalesce(F.col(f"`{p}`"), F.lit(0)).cast("bigint").alias("votes"), F.lit(-i).alias("place"), F.lit(p).alias("party")) for i, p in enumerate(parties)])
    return F.sort_array(made, asc=False)


def votes_map(parties: list[str]) -> Column:
    return F.map_from_arrays(F.array(*[F.lit(p) for p in parties]), F.array(*[F.col(f"`{p}`").cast("bigint") for p in parties]))


def bounds(points: Column) -> Column:
    """struct<min_x, min_y, max_x, max_y> of an array of (x, y) structs."""
    xs, ys = F.transform(points, lambda p: p["x"]), F.transform(points, lambda p: p["y"])
    return F.struct(F.array_min(xs).alias("min_x"), F.array_min(ys).alias("min_y"), F.array_max(xs).alias("max_x"), F.array_max(ys).alias("max_y"))


def centre(box: Column) -> Column:
    return F.struct(round6((box["min_x"] + box["max_x"]) / 2).alias("x"), round6((box["min_y"] + box["max_y"]) / 2).alias("y"))


def pairs_of(numbers: Column) -> Column:
    """An array of numbers as (x, y) points, two by two."""
    even = F.sequence(F.lit(1), F.size(numbers) - 1, F.lit(2))
    return F.transform(even, lambda i: F.struct(F.element_at(numbers, i).cast("double").alias("x"), F.element_at(numbers, i + 1).cast("double").alias("y")))


def rounded(numbers: Column) -> Column:
    return F.transform(numbers, lambda x: round6(x.cast("double")))


def ring_area(points: Column) -> Column:
    """Area of a ring of points by the shoelace sum."""
    n = F.size(points)
    follow = F.concat(F.slice(points, 2, F.greatest(n - 1, F.lit(0))), F.slice(points, 1, 1))
    crossed = F.zip_with(points, follow, lambda p, q: p["x"] * q["y"] - q["x"] * p["y"])
    return F.abs(F.aggregate(crossed, F.lit(0.0), lambda a, x: a + x)) / 2
