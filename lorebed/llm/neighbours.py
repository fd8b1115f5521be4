"""Each row beside the next one in order, at any size: ranges of the order, each with the head of the one after it."""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_next_in_ranges(rows: DataFrame, order: str, then: list[str], ranges_per_partition: int = 4) -> DataFrame:
    """The rows by ranges of ``order``, descending, sorted so that each is followed by the next one in the whole order.

    Adds ``range`` and ``halo``. The rows of a range are together in one partition, in order: ``order`` descending with nulls
    last, ties by ``then``. They are followed by copies of the first rows of the next range, marked as halo; after the last
    range comes the first one again. Only range bounds and each range's largest value, a few numbers for each partition, reach the driver.
    """
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = parts * ranges_per_partition
    bounds = sorted(set(rows.stat.approxQuantile(order, [k / wanted for k in range(1, wanted)], 0.25 / wanted)))
    place = F.lit(0)
    if bounds:
        # A binary search in the JVM, for as many ranges as there are partitions.
        value = rows.withColumn("__value", F.col(order).cast("double"))
        rows = Bucketizer(splits=[float("-inf"), *bounds, float("inf")], inputCol="__value", outputCol="__place", handleInvalid="keep").transform(value)
        place = F.col("__place").cast("int")
    rows = rows.withColumn("range", F.when(F.col(order).isNull(), F.lit(-1)).otherwise(place)).drop("__value", "__place")
    heads = [(r["range"], r["head"]) for r in rows.groupBy("range").agg(F.max(order).alias("head")).orderBy(F.desc("range")).collect()]
    if not heads:
        return rows.withColumn("halo", F.lit(False))
    before = {b: heads[i - 1][0] for i, (b, _) in enumerate(heads)}
    kind = rows.schema[order].dataType.simpleString()
    heads_df = F.broadcast(spark.createDataFrame([(b, h, before[b]) for b, h in heads], f"range int, head {kind}, receiver int"))
    own, halo = F.struct(F.col("range"), F.lit(False).alias("halo")), F.struct(F.col("receiver").alias("range"), F.lit(True).alias("halo"))
    sent = rows.join(heads_df, "range").withColumn("to", F.explode(F.when(F.col(order).eqNullSafe(F.col("head")), F.array(own, halo)).otherwise(F.array(own))))
    sent = sent.select(*[c for c in rows.columns if c != "range"], "to.range", "to.halo")
    return sent.repartition(parts, "range").sortWithinPartitions("range", "halo", F.desc_nulls_last(order), *then)

