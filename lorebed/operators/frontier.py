"""The crawl frontier: one row for each normalised url, merged and never shortened."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..vocabulary import FRONTIER_COLUMNS, MAX_RETRIES, STATUS_OF_PRIORITY
from .dedupe import first_of


def status_for(priority: Column) -> Column:
    """Missing counts as medium; the empty text and unknown priorities need review."""
    known = F.create_map(*[F.lit(x) for x in chain(*STATUS_OF_PRIORITY.items())])
    return F.coalesce(F.try_element_at(known, F.coalesce(priority, F.lit("medium"))), F.lit("needs_review"))


def from_candidates(candidates: DataFrame, order: str, limit: int = 0) -> DataFrame:
    """Frontier rows of the first ``limit`` candidates (0: all); those without a url go after the limit."""
    rows = candidates.orderBy(order).limit(limit) if limit else candidates
    rows = rows.where(F.coalesce(F.col("normalized_url"), F.lit("")) != "")
    known = {
        "priority": F.coalesce(F.col("priority"), F.lit("medium")), "status": status_for(F.col("priority")),
        "discovered_from": F.col("source_type"), "first_seen_date": F.col("discovered_date"),
        "retry_count": F.lit(0), "frontier_id": F.lit(None).cast("long"), "last_checked_date": F.lit(""), "crawl_error": F.lit(""),
    }
    return rows.select(*[known.get(c, F.col(c) if c in candidates.columns else F.lit("")).alias(c) for c in FRONTIER_COLUMNS], F.col(order).alias("_ord"))


def upsert(frontier: DataFrame, rows: DataFrame) -> DataFrame:
    """The frontier with the rows merged in by normalized_url; ``inserted`` marks new ones.

    A url that is there keeps its status, counters and first date, so nothing that was crawled is queued again; its priority is the new one's.
    New urls are inserted as their first row.
    """
    new = first_of(rows, ["normalized_url"], "_ord").drop("_ord")
    a, b = frontier.alias("a"), new.alias("b")
    joined = a.join(b, F.col("a.normalized_url") == F.col("b.normalized_url"), "full_outer")
    merged = [
        F.coalesce(F.col(f"b.{c}"), F.col(f"a.{c}")).alias(c) if c == "priority" else F.when(F.col("a.normalized_url").isNull(), F.col(f"b.{c}")).otherwise(F.col(f"a.{c}")).alias(c) for c in FRONTIER_COLUMNS
    ]
    return joined.select(*merged, F.col("a.normalized_url").isNull().alias("inserted"))


def save_bucketed(frontier: DataFrame, name: str, path: str, buckets: int) -> None:
    """The frontier as a table in buckets of normalized_url, each one file and sorted: joins on the url read it as it lies."""
    parts = frontier.select(*FRONTIER_COLUMNS).repartition(buckets, "normalized_url")
    parts.write.bucketBy(buckets, "normalized_url").sortBy("normalized_url").option("path", path).saveAsTable(name)


def upsert_bucketed(spark: SparkSession, name: str, rows: DataFrame) -> DataFrame:
    """``upsert`` into a table of ``save_bucketed``: only the new rows are shuffled, to where the frontier's buckets are. To be saved as another table."""
    return upsert(spark.table(name), rows)


def requeue_failed(frontier: DataFrame, most: int = MAX_RETRIES) -> DataFrame:
    """Failed rows with fewer retries than ``most`` are queued with one more; ``requeued`` marks them."""
    again = (F.col("status") == "failed") & (F.coalesce(F.col("retry_count"), F.lit(0)) < most)
    return frontier.withColumns(
        {"requeued": again, "status": F.when(again, "queued").otherwise(F.col("status")), "retry_count": F.coalesce(F.col("retry_count"), F.lit(0)) + again.cast("int")}
    )


def counts(frontier: DataFrame) -> DataFrame:
    return frontier.groupBy("status").agg(F.count("*").alias("n"))


def allowed_content(crawled: DataFrame, types: tuple[str, ...] = ("text/html", "application/xhtml+xml")) -> DataFrame:
    """Pages of a content type that is read, parameters such as the charset aside; which types is a choice."""
    return crawled.where(F.lower(F.trim(F.split_part(F.coalesce("content_type", F.lit("")), F.lit(";"), F.lit(1)))).isin(*types))


def crawlable(frontier: DataFrame, priorities: tuple[str, ...] = ("high", "medium"), limit: int = 1000) -> DataFrame:
    """The next batch of queued urls of the priorities that are crawled."""
    return frontier.where((F.col("status") == "queued") & F.col("priority").isin(*priorities)).orderBy("frontier_id").limit(limit)
