"""Search queries from templates, upserts by key, follow-ups and capped merges."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import casefold, or_default, strip, truthy
from ..vocabulary import COMPANY_TEMPLATES, FOLLOWUP_COMPANY_TEMPLATES, FOLLOWUP_LOCATION_TEMPLATES, GENERAL_QUERIES, LOCATION_TEMPLATES, MAX_ENTITIES, MAX_ITERATIONS, MAX_NEW_QUERIES, SITE_TERMS
from .dedupe import first_of


def _templates(spark: SparkSession, templates: list[str]) -> DataFrame:
    """A fixed handful of rows, which every task can have."""
    return F.broadcast(spark.createDataFrame(list(enumerate(templates)), "t int, template string"))


def _filled(seeds: DataFrame, column: str, templates: list[str], branch: int, source_type: str) -> DataFrame:
    rows = seeds.select("_ord", strip(F.col(column)).alias("v")).where(F.coalesce(F.col("v"), F.lit("")) != "")
    query = F.replace(F.col("template"), F.lit("{" + column + "}"), F.col("v"))
    return rows.crossJoin(_templates(seeds.sparkSession, templates)).select(
        F.lit(branch).alias("branch"), "_ord", "t", query.alias("query"), F.lit(source_type).alias("source_type")
    )


def expand(general: DataFrame, seeds: DataFrame, domains: DataFrame, locations: DataFrame, companies: DataFrame) -> DataFrame:
    """All queries in order (branch, _ord, t): general, seed, by site, by location, by company; first of equal ones by case wins.

    ``general`` has _ord and query; the other tables have _ord and their seed columns.
    """
    spark = general.sparkSession
    parts = [
        general.select(F.lit(0).alias("branch"), "_ord", F.lit(0).alias("t"), "query", F.lit("general").alias("source_type")),
        seeds.select(F.lit(1).alias("branch"), "_ord", F.lit(0).alias("t"), strip(F.col("query")).alias("query"), or_default(F.col("source_type"), "general").alias("source_type")),
        domains.where(truthy(F.col("use_site_queries"))).crossJoin(_templates(spark, SITE_TERMS)).select(F.lit(2).alias("branch"), "_ord", "t", F.concat(F.lit("site:"), F.col("domain"), F.lit(" "), F.col("template")).alias("query"), F.lit("site").alias("source_type")),
        _filled(locations, "location", LOCATION_TEMPLATES, 3, "location"),
        _filled(companies, "company", COMPANY_TEMPLATES, 4, "company"),
    ]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    rows = rows.where(F.col("query") != "").withColumns({"key": casefold(F.col("query")), "place": F.struct("branch", "_ord", "t")})
    return first_of(rows, ["key"], "place").drop("place", "key")


def general_queries(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(enumerate(GENERAL_QUERIES)), "_ord long, query string")


def upsert_queries(existing: DataFrame, new: DataFrame, iteration: int = 0) -> DataFrame:
    """Existing rows, then new ones with a key that none of them has. Both have _ord, query and source_type.

    Of existing rows that differ in case only, the first keeps its place and gets the values of the last.
    """
    old = existing.withColumn("key", casefold(F.col("query")))
    last = old.groupBy("key").agg(F.max_by(F.struct(*existing.columns), "_ord").alias("row"), F.min("_ord").alias("first"))
    kept = last.select(*[F.col(f"row.{c}") for c in existing.columns if c != "_ord"], F.col("first").alias("_ord"), F.lit(0).alias("part"), "key")
    added = first_of(new.withColumn("key", casefold(F.col("query"))), ["key"], "_ord").join(kept.select("key"), "key", "left_anti")
    added = added.select(
        *[F.col(c) if c in new.columns else F.lit(None).alias(c) for c in existing.columns if c not in ("_ord", "iteration", "status")],
        "_ord", F.lit(1).alias("part")
    )
    for c, v in (("iteration", str(iteration)), ("status", "new")):
        if c in existing.columns:
            added = added.withColumn(c, F.lit(v))
    return kept.drop("key").unionByName(added)


def followups(entities: DataFrame) -> DataFrame:
    """Queries for found entities: company templates for companies, location templates for others; first of equal ones by case wins."""
    spark = entities.sparkSession
    rows = [("company", k, t.replace("{company}", "{}")) for k, t in enumerate(FOLLOWUP_COMPANY_TEMPLATES)] + [
        ("location", k, t.replace("{location}", "{}")) for k, t in enumerate(FOLLOWUP_LOCATION_TEMPLATES)
    ]
    templates = F.broadcast(spark.createDataFrame(rows, "kind string, t int, template string"))
    kinds = entities.withColumn("kind", F.when(F.col("entity_type") == "company", "company").otherwise("location"))
    filled = kinds.join(templates, "kind").select(
        "_ord", "t", F.replace(F.col("template"), F.lit("{}"), F.col("entity")).alias("query"), F.concat(F.lit("expansion_"), "kind").alias("source_type")
    )
    filled = filled.withColumns({"key": casefold(F.col("query")), "place": F.struct("_ord", "t")})
    return first_of(filled, ["key"], "place").drop("key", "place")


def merge_new(new: DataFrame, prior: DataFrame, iteration: int, limit: int = MAX_NEW_QUERIES) -> DataFrame:
    """The first ``limit`` new queries, by (_ord, t), with a key that no earlier iteration has; the order's number is ``n``.

    The cap is the feature. It is a sort with a limit; only the rows within it are numbered.
    """
    if iteration > MAX_ITERATIONS:
        raise ValueError(f"iteration {iteration} is beyond {MAX_ITERATIONS}")
    known = prior.select(casefold(F.col("query")).alias("key")).distinct()
    fresh = first_of(new.withColumns({"key": casefold(F.col("query")), "place": F.struct("_ord", "t")}), ["key"], "place").join(known, "key", "left_anti")
    capped = fresh.orderBy("_ord", "t").limit(limit or MAX_NEW_QUERIES)
    return capped.withColumn("n", F.row_number().over(Window.orderBy("_ord", "t"))).withColumn("iteration", F.lit(str(iteration))).select("n", "query", "source_type", "iteration")


def capped_entities(entities: DataFrame, limit: int = MAX_ENTITIES) -> DataFrame:
    """The first entities of an iteration: endless discovery is not the aim."""
    return entities.orderBy("_ord").limit(limit)


def unprocessed(pages: DataFrame, processed: DataFrame, key: str = "page_id") -> DataFrame:
    """Pages that no earlier run has processed."""
    return pages.join(processed.select(key).distinct(), key, "left_anti")
