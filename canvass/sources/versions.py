"""Publishing by versions: immutable folders, and pointers that name the current one.

``<target>/versions/<name>`` holds a table that is never written again; ``<target>/pointers/<number>`` holds its name
and a line end.  A pointer is created exclusively and only when its version is complete, so a reader, who takes
the highest pointer that is whole, sees one version or the one before, never a mixture and never nothing.  A job that dies
at any step leaves the old version current.  Nothing is renamed, which object stores would copy.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.contracts import ContractError

MOST_GROUPS = 1000


def _fs(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _names(spark: SparkSession, folder: str) -> list[str]:
    fs, at = _fs(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(at)) if fs.exists(at) else []


def _content(spark: SparkSession, path: str) -> str:
    fs, at = _fs(spark, path)
    stream = fs.open(at)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def pointed(spark: SparkSession, target: str) -> list[tuple[int, str]]:
    """(number, version) of all whole pointers, the current one last; one whose line end is missing is not there yet."""
    found = [(int(n), _content(spark, f"{target}/pointers/{n}")) for n in _names(spark, f"{target}/pointers") if n.isdigit()]
    return [(n, text[:-1]) for n, text in sorted(found) if text.endswith("\n")]


def current(spark: SparkSession, target: str) -> str | None:
    """Folder of the current version; None before the first."""
    found = pointed(spark, target)
    return f"{target}/versions/{found[-1][1]}" if found else None


def read(spark: SparkSession, target: str, schema: str | None = None) -> DataFrame:
    folder = current(spark, target)
    if folder is None:
        raise FileNotFoundError(f"nothing is published at {target}")
    return (spark.read.schema(schema) if schema else spark.read).parquet(folder)


def _point(spark: SparkSession, target: str, version: str, tries: int = 100) -> int:
    """Create the next free pointer; another writer's meanwhile makes it one higher."""
    number = max([int(n) for n in _names(spark, f"{target}/pointers") if n.isdigit()], default=0)
    for _ in range(tries):
        number += 1
        fs, at = _fs(spark, f"{target}/pointers/{number:010d}")
        if fs.exists(at):
            continue
        try:
            stream = fs.create(at, False)  # fails where the file is there
        except Exception:
            if fs.exists(at):
                continue
            raise
        try:
            stream.write(bytearray(f"{version}\n".encode()))
        finally:
            stream.close()
        return number
    raise OSError(f"no free pointer at {target}")


def publish(df: DataFrame, target: str, *, partition_by: list[str] | None = None, check: Callable[[str], None] | None = None) -> str:
    """Write ``df`` as a new version and make it current; returns its folder.

    ``check`` gets the folder when it is written; what it raises leaves the old version current.  Spark's own marker of
    a complete write must be there as well.
    """
    spark = df.sparkSession
    version = uuid.uuid4().hex
    folder = f"{target}/versions/{version}"
    (df.write.partitionBy(*partition_by) if partition_by else df.write).parquet(folder)
    if check:
        check(folder)
    _point(spark, target, version)
    return folder


def prune(spark: SparkSession, target: str, keep: int = 2) -> list[str]:
    """Delete versions that none of the ``keep`` last pointers names, with their pointers; returns their names.

    Readers of an older version fail then, so keep more than one.  Versions of writers under way are deleted as well: prune when none is.
    """
    if keep < 1:
        raise ValueError("the current version stays")
    pointers = pointed(spark, target)
    kept = {v for _, v in pointers[-keep:]}
    for number, version in pointers[:-keep]:
        if version not in kept:
            fs, at = _fs(spark, f"{target}/pointers/{number:010d}")
            fs.delete(at, False)
    gone = [v for v in _names(spark, f"{target}/versions") if v not in kept]
    for version in gone:
        fs, at = _fs(spark, f"{target}/versions/{version}")
        fs.delete(at, True)
    return gone


class Conserved:
    """Rows by group, counted on their way through a plan: before and after what must not lose any.

    Both counts are metrics of the job that writes, so no second pass reads the data.  ``groups`` are the values to tell apart,
    ``MOST_GROUPS`` at most; rows of others, and of none, count together.  A stage that is computed again
    after an executor was lost may count twice; so a difference is only believed after :meth:`require` has counted what was written.
    """

    def __init__(self, group: str, groups: list[object]) -> None:
        if len(groups) > MOST_GROUPS:
            raise ValueError(f"{len(groups)} groups; {MOST_GROUPS} at most are told apart")
        self.group, self.groups = group, list(groups)
        self._seen: dict[str, Observation] = {}

    def _metrics(self) -> list[Column]:
        own = F.col(self.group)
        return [F.count_if(own.eqNullSafe(F.lit(g))).alias(f"g{i}") for i, g in enumerate(self.groups)] + [F.count("*").alias("all")]

    def _observed(self, df: DataFrame, side: str) -> DataFrame:
        self._seen[side] = Observation(f"{side}-{uuid.uuid4().hex}")
        return df.observe(self._seen[side], *self._metrics())

    def before(self, df: DataFrame) -> DataFrame:
        return self._observed(df, "before")

    def after(self, df: DataFrame) -> DataFrame:
        return self._observed(df, "after")

    def _counts(self, metrics: dict[str, int]) -> dict[object, int]:
        told = {g: metrics[f"g{i}"] for i, g in enumerate(self.groups)}
        return told | {"(others)": metrics["all"] - sum(told.values())}

    def counts(self) -> list[tuple[object, int, int]]:
        """(group, before, after) once the writing job has run."""
        before, after = (self._counts(self._seen[side].get) for side in ("before", "after"))
        return [(g, before[g], after[g]) for g in before]

    def require(self, written: DataFrame) -> None:
        """Fail unless every group kept its rows; ``written`` is read only where the metrics differ."""
        odd = [(g, b, a) for g, b, a in self.counts() if b != a]
        if odd:
            recounted = self._counts(written.agg(*self._metrics()).first().asDict())
            odd = [(g, b, recounted[g]) for g, b, _ in self.counts() if b != recounted[g]]
        if odd:
            raise ContractError(f"rows are not conserved (group, before, after): {odd[:10]}")
