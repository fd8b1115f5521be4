"""What the operators share in running on Spark: shipping this library, stored tables, row keys."""

from __future__ import annotations

import os
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ROOT = str(Path(__file__).resolve().parents[2])


#: Bytes of an Arrow batch that a task passes to Python at once, unless the session asks for other than Spark's default.
BATCH_BYTES = 12 << 20


def ship(spark: SparkSession) -> None:
    """Lets Python workers import this library where they see the driver's files (elsewhere: ``--py-files``), and bounds their batches."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name) in ("67108864b", "64MB", "67108864"):
        spark.conf.set(name, str(BATCH_BYTES))
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, paths)])


def shared_dir(spark: SparkSession) -> str:
    """The folder that the session names in spark.checkpoint.dir, or else its checkpoint folder.

    Where it has neither, a session within one process gets a folder of its own; on a cluster that is an error, as its machines share none.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="lorebed-"))
        named = spark.sparkContext.getCheckpointDir()
    return named.rstrip("/")


def stored(df: DataFrame) -> DataFrame:
    """The rows as a table in the shared folder: the lineage ends there, so a lost executor costs no more than one read."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/lorebed-{uuid.uuid4().hex}"
    cleanup = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(cleanup)
    try:
        # What the write shuffled is of no use after it.
        spark.conf.set(cleanup, "true")
        df.write.parquet(path)
    finally:
        spark.conf.set(cleanup, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes stored tables that nothing reads any more."""
    for df in tables:
        path = df.__dict__.pop("_stored_at", None)
        if path:
            target = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def keyed(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """A 128-bit key of a row by its id and text: rows that share an id stay apart unless their texts are equal too."""
    mark = F.when(F.col(id_col).isNull(), "0").otherwise("1")
    return F.unhex(F.md5(F.concat_ws("\x00", mark, F.col(id_col).cast("string"), F.when(F.col(text_col).isNull(), "0").otherwise("1"), F.col(text_col))))


def set_apart(docs: DataFrame, used: set[str]) -> DataFrame:
    """The rows with all columns but the used ones under names that no operator adds; ``toDF(*docs.columns)`` undoes it."""
    return docs.toDF(*[c if c in used else f"__own_{i}" for i, c in enumerate(docs.columns)])


def spread_join(rows: DataFrame, found: DataFrame, on: list[str], by: str = "key", how: str = "inner", salts: int = 8) -> DataFrame:
    """A join of rows of which one key may hold a third with a table that has each key once: each key goes to ``salts`` tasks, by the hash of ``by``.

    The table grows with the data, so it is never broadcast, however small it is now.
    """
    salted = rows.withColumn("__salt", F.pmod(F.xxhash64(by), F.lit(salts)))
    found = found.withColumn("__salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    return salted.join(found.hint("merge"), [*on, "__salt"], how).drop("__salt")


def text_or_empty(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def ascii_lower(column: Column) -> Column:
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
