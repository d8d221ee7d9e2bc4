"""Tables in the folder that all executors share, for steps that must not be recomputed."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; a folder of our own only where the setting is absent on a single machine (tests).

    On a cluster without the setting executors would write to their own disks and results would be
    incomplete, so that fails.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if context.master != "local" and not context.master.startswith("local["):
        raise ValueError(f"spark.checkpoint.dir must name a folder that all executors of {context.master} share")
    if context.applicationId not in _own:
        _own[context.applicationId] = "file://" + tempfile.mkdtemp(prefix="canvass-")
        context.setCheckpointDir(_own[context.applicationId])
    return _own[context.applicationId]


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: cuts lineage, survives lost executors."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    back.saved_at = path
    return back


def discard(*tables: DataFrame) -> None:
    """Delete tables of :func:`saved` that nothing reads any more; other frames are left alone."""
    for table in tables:
        if path := getattr(table, "saved_at", None):
            spark = table.sparkSession
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
