"""Folders that the driver and all executors share, for tables that a query writes and reads again."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """A new folder's path in the one that spark.checkpoint.dir names; it is deleted when the session's process ends, or by ``delete``.

    Without that setting, and without a checkpoint folder, a session within one process gets a folder of its own; a cluster gets an error, as its machines share none.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="lorebed-"))
        root = spark.sparkContext.getCheckpointDir()
    path = f"{root.rstrip('/')}/lorebed-{uuid.uuid4().hex}"
    system, target = _at(spark, path)
    system.deleteOnExit(target)
    return path


def _at(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def delete(spark: SparkSession, path: str) -> None:
    system, target = _at(spark, path)
    system.delete(target, True)


def stored(rows: DataFrame) -> DataFrame:
    """The rows, written and read again: what several passes read is made once, and the lineage ends there."""
    path = shared_folder(rows.sparkSession)
    rows.write.parquet(path)
    out = rows.sparkSession.read.schema(rows.schema).parquet(path)
    out._stored_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes stored tables that nothing reads any more."""
    for rows in tables:
        path = rows.__dict__.pop("_stored_at", None)
        if path:
            delete(rows.sparkSession, path)
