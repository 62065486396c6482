"""Cutting lineage, and tables that lazy results read, in the folder that the whole cluster shares."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

#: What lazy results still read: (session, path, table or "").
_HELD: list[tuple[SparkSession, str, str]] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder under spark.checkpoint.dir.  One is chosen here only where that is unset and Spark runs in one process."""
    context = spark.sparkContext
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not context.getCheckpointDir():
        if not at:
            if not context.master.startswith("local["):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            at = tempfile.mkdtemp(prefix="pelagia-")
        context.setCheckpointDir(at)
        _HELD.append((spark, context.getCheckpointDir(), ""))  # Spark makes it for this session alone
    return (at or context.getCheckpointDir()).rstrip("/")


def checkpointed(df: DataFrame) -> DataFrame:
    """df, written once under spark.checkpoint.dir."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def staged_path(spark: SparkSession, name: str, table: str = "") -> str:
    """A new path in the shared folder that release() deletes."""
    path = f"{shared_folder(spark)}/pelagia/{name}-{uuid.uuid4().hex}"
    _HELD.append((spark, path, table))
    return path


def bucketed(df: DataFrame, name: str, by: Sequence[str], buckets: int, sort: bool = True) -> DataFrame:
    """df, written as a table in `buckets` buckets by columns: joins and groups by them, or by more columns, move nothing of it.

    release() drops the table; a table to be kept is written by the caller the same way under a name and path of its own.
    """
    spark, table = df.sparkSession, f"{name}_{uuid.uuid4().hex[:12]}"
    # One task a bucket writes one file, which then counts as sorted.
    writer = df.repartition(buckets, *by).write.format("parquet").bucketBy(buckets, *by)
    (writer.sortBy(*by) if sort else writer).option("path", staged_path(spark, name, table)).saveAsTable(table)
    return spark.table(table)


def release() -> None:
    """Delete the tables and checkpoints that lazy results read.  Call it when the results are written; all go when Python ends."""
    while _HELD:
        spark, path, table = _HELD.pop()
        context = spark.sparkContext
        if context._jsc is None:  # the session is over
            continue
        if table:
            spark.sql(f"DROP TABLE IF EXISTS {table}")
        at = context._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(context._jsc.hadoopConfiguration()).delete(at, True)


atexit.register(release)
