"""The stages as one command each, for spark-submit: ``stages.py STAGE --in PATH --out PATH [--limit N] [--dry-run]``.

Each stage is a function of tables; this file only reads, counts and writes.
"""

from __future__ import annotations

import argparse
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lorebed.operators import candidates, dedupe, discovery, export, frontier, validate
from lorebed.sources import settings, tables
from lorebed.sources.scratch import discard, stored
from lorebed.vocabulary import CANDIDATE_COLUMNS, DOMAIN_SUMMARY_COLUMNS, ENTITY_COLUMNS, FRONTIER_COLUMNS, QUERY_COLUMNS, SOURCE_COLUMNS

Stage = Callable[[SparkSession, argparse.Namespace], tuple[DataFrame, list[str] | None]]
STAGES: dict[str, Stage] = {}


def stage(f: Stage) -> Stage:
    STAGES[f.__name__.replace("_", "-")] = f
    return f


def first(rows: DataFrame, limit: int) -> DataFrame:
    """The first rows in order, or all for 0."""
    return rows.orderBy("_ord").limit(limit) if limit else rows


def _candidates(spark: SparkSession, options: argparse.Namespace, more: list[str] | None = None) -> DataFrame:
    return tables.read_csv(spark, options.source, [*CANDIDATE_COLUMNS, *(more or [])])


def _entities(spark: SparkSession, options: argparse.Namespace) -> DataFrame:
    if not tables.exists(spark, options.source):
        raise SystemExit(f"no entities at {options.source}")
    return tables.with_order(tables.read_jsonl_typed(spark, options.source))


@stage
def normalize_urls(spark, options):
    return candidates.normalized(_candidates(spark, options)), CANDIDATE_COLUMNS


@stage
def deduplicate_urls(spark, options):
    return dedupe.label_duplicates(_candidates(spark, options), "normalized_url", "_ord"), CANDIDATE_COLUMNS


@stage
def prioritize_urls(spark, options):
    return candidates.prioritized(_candidates(spark, options), "_ord"), [*CANDIDATE_COLUMNS, "priority"]


@stage
def domain_summary(spark, options):
    return candidates.domain_summary(_candidates(spark, options), "_ord"), DOMAIN_SUMMARY_COLUMNS


@stage
def update_frontier(spark, options):
    return frontier.from_candidates(_candidates(spark, options, ["priority"]), "_ord", options.limit), FRONTIER_COLUMNS


@stage
def generate_queries(spark, options):
    """From a folder with seed_queries.csv, seed_domains.csv, seed_locations.csv and seed_companies.csv; queries of ``--prior`` keep their status."""
    read = lambda name, columns: tables.read_csv(spark, f"{options.source}/{name}.csv", columns)
    seeds = [
        read("seed_queries", ["query", "source_type"]), read("seed_domains", ["domain", "use_site_queries"]), read("seed_locations", ["location"]),
        read("seed_companies", ["company"]),
    ]
    made = discovery.expand(discovery.general_queries(spark), *seeds)
    made = made.select(F.struct("branch", F.col("_ord").alias("seed"), "t").alias("_ord"), "query", "source_type")
    prior = tables.read_csv(spark, options.prior, QUERY_COLUMNS) if options.prior else tables.with_order(spark.createDataFrame([], tables.text_schema(QUERY_COLUMNS)))
    # Known queries first, in their order, then the new ones in theirs.
    place = F.struct("branch", "seed", "t")
    old = prior.select(F.struct(F.lit(0).alias("branch"), F.col("_ord").alias("seed"), F.lit(0).alias("t")).alias("_ord"), *QUERY_COLUMNS)
    rows = discovery.upsert_queries(old, made).select("_ord.*", "part", *QUERY_COLUMNS).withColumn("_ord", F.struct("part", place))
    return first(rows, options.limit), QUERY_COLUMNS


@stage
def followup_queries(spark, options):
    if not tables.exists(spark, options.source):
        raise SystemExit(f"no entities at {options.source}")
    made = discovery.followups(tables.read_csv(spark, options.source, ["entity", "entity_type"])).withColumn("_ord", F.struct("_ord", "t"))
    made = made.select("_ord", "query", "source_type", F.lit(str(options.iteration)).alias("iteration"), F.lit("new").alias("status"))
    return first(made, options.limit), QUERY_COLUMNS


@stage
def validate_records(spark, options):
    """Passed records to ``--out``; to ``--failed`` the others, repeats of facts and what failed in generation before. ``--pages`` has a JSON file for each page."""
    records = first(tables.with_order(tables.read_jsonl_typed(spark, options.source)), options.limit)
    pages = tables.read_page_inputs(spark, f"{options.pages}/*.json").select("page_id", "page_markdown")
    validated = validate.validate(records, pages)
    earlier = tables.read_jsonl_typed(spark, options.failed) if tables.exists(spark, options.failed) else None
    passed, failed = validate.split(validated, earlier, order="_ord")
    if not options.dry_run:
        # The earlier failures are read from the file that is replaced.
        kept = stored(failed)
        tables.write_jsonl(kept.drop("_ord"), options.failed)
        discard(kept)
    return passed, None


@stage
def merge_queries(spark, options):
    if options.iteration > options.settings.max_iterations:
        raise SystemExit(f"iteration {options.iteration} is beyond {options.settings.max_iterations}")
    prior = tables.read_csv(spark, options.prior, QUERY_COLUMNS) if options.prior else tables.read_csv(spark, options.source, QUERY_COLUMNS).limit(0)
    limit = options.limit or options.settings.max_queries
    merged = discovery.merge_new(tables.read_csv(spark, options.source, QUERY_COLUMNS).selectExpr("*", "0 AS t"), prior, options.iteration, limit)
    return merged.withColumns({"_ord": F.col("n"), "status": F.lit("new")}), QUERY_COLUMNS


@stage
def final_wiki(spark, options):
    return export.final_wiki(_entities(spark, options), options.limit), ENTITY_COLUMNS


@stage
def final_sources(spark, options):
    return export.sources(_entities(spark, options), options.limit), SOURCE_COLUMNS


@stage
def finetuning_data(spark, options):
    return export.finetuning(_entities(spark, options), options.limit).select("instruction", "input", "output"), None


def main(arguments: list[str] | None = None) -> int:
    """Writes a stage's table as CSV, or as JSON lines where it has no columns of its own. A dry run counts the rows and writes nothing."""
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("stage", choices=sorted(STAGES))
    parser.add_argument("--in", dest="source", required=True)
    parser.add_argument("--out", required=True)
    parser.add_argument("--prior", default="", help="queries of earlier iterations")
    parser.add_argument("--iteration", type=int, default=1)
    parser.add_argument("--pages", default="", help="a folder of page inputs")
    parser.add_argument("--failed", default="", help="records that fail, replaced")
    parser.add_argument("--config-dir", default="", help="a folder of settings; without it, those of the environment")
    parser.add_argument("--limit", type=int, default=0, help="0: no limit")
    parser.add_argument("--dry-run", action="store_true")
    options = parser.parse_args(arguments)
    options.settings = settings.load_dir(options.config_dir) if options.config_dir else settings.load()
    if options.stage == "validate-records" and not (options.pages and options.failed):
        parser.error("validate-records needs --pages and --failed")
    spark = SparkSession.builder.getOrCreate()
    log = settings.logger("lorebed.stages")
    rows, columns = STAGES[options.stage](spark, options)
    if options.dry_run:
        log.info("%s: %d rows, nothing written", options.stage, rows.count())
    elif columns is None:
        counts = tables.observed(rows, lambda new: tables.write_jsonl(new.drop("_ord"), options.out, order=None), rows=F.count("*"))
        log.info("%s: %d rows", options.stage, counts["rows"])
    else:
        counts = tables.observed(rows, lambda new: tables.write_csv(new, options.out, columns, order=None), rows=F.count("*"))
        log.info("%s: %d rows", options.stage, counts["rows"])
    return 0


if __name__ == "__main__":
    sys.exit(main())
