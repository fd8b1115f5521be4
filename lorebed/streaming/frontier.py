"""The frontier as a stream: each url's row is state, and a batch writes the rows that it adds or changes."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..operators import frontier
from ..sources.tables import exists
from ..vocabulary import FRONTIER_COLUMNS

#: What holds the state: on local disk, with its changes in the checkpoint.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Merge(StatefulProcessor):
    """Merges the rows of one url as ``frontier.upsert`` does: the first row of all is kept, with the priority of the first row of the last batch."""

    def __init__(self, schema: T.StructType, key: str, order: str):
        self.schema, self.key, self.order = schema, key, order

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.row = handle.getValueState("row", self.schema)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        first = None
        for part in rows:
            own = part.loc[part[self.order].idxmin()]
            if first is None or own[self.order] < first[self.order]:
                first = own
        names = self.schema.fieldNames()
        known = self.row.exists()
        row = dict(zip(names, self.row.get())) if known else {c: key[0] if c == self.key else first[c] for c in names}
        row = {c: None if v is None or v != v else v for c, v in row.items()}
        changed = not known or row["priority"] != first["priority"]
        row["priority"] = first["priority"]
        row |= {f.name: int(row[f.name]) for f in self.schema if isinstance(f.dataType, T.IntegralType) and row[f.name] is not None}
        if changed:
            self.row.update(tuple(row[c] for c in names))
            yield pd.DataFrame([{**row, "inserted": not known}]).astype({f.name: "Int64" for f in self.schema if isinstance(f.dataType, T.IntegralType)})

    def close(self) -> None:
        pass


def changes(rows: DataFrame, order: str = "_ord") -> DataFrame:
    """The rows that a stream of frontier rows adds or changes, batch by batch, with ``inserted``."""
    schema = T.StructType([T.StructField(c, rows.schema[c].dataType) for c in FRONTIER_COLUMNS])
    out = T.StructType([*schema.fields, T.StructField("inserted", T.BooleanType())])
    # A name that begins with _ doesn't reach the processor.
    rows = rows.select(*FRONTIER_COLUMNS, F.col(order).alias("place"))
    return rows.groupBy("normalized_url").transformWithStateInPandas(Merge(schema, "normalized_url", "place"), outputStructType=out, outputMode="Update", timeMode="None")


def latest(spark: SparkSession, folder: str) -> DataFrame | None:
    """The frontier: the last row that any batch has written of each url."""
    if not exists(spark, folder):
        return None
    rows = spark.read.parquet(folder)
    last = rows.groupBy("normalized_url").agg(F.max_by(F.struct(*[c for c in FRONTIER_COLUMNS if c != "normalized_url"]), "batch").alias("row"))
    return last.select(*["normalized_url" if c == "normalized_url" else f"row.{c}" for c in FRONTIER_COLUMNS])


def run_until_done(spark: SparkSession, source: str, schema, folder: str, checkpoint: str, order: str = "_ord", files_per_batch: int = 100) -> DataFrame | None:
    """Merges all candidate files that are new since the last run.

    A batch reads and writes in proportion to itself; the frontier so far is in the state, by url. A batch that runs again after a crash writes
    its own folder again, from the state that it began with.
    """
    provider = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    try:
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)
        merged = changes(frontier.from_candidates(stream, order), order)
        write = lambda batch, number: batch.drop("inserted").write.mode("overwrite").parquet(f"{folder}/batch={number}")
        merged.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", provider)
    return latest(spark, folder)
