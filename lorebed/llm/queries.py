"""One query for each training-data operator, over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import centroids, chosenpath, decontam, fingerprints, infill, langid, licences, linededup, pieces, sharding, substrings, toxicity, urlfilter
from .job import stored
from .oracle import ORACLE

#: A public vocabulary; it stays where it is.
PIECES_FILE = "/opt/tokenizers/piece_bpe_32k.model"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = chosenpath.near_classes(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", "n_links", "n_text_links")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, toxicity.graded(table(spark, sf_dir, "labels")))
    return toxicity.score(docs, model).drop("text")


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    classes = fingerprints.near_duplicates(docs).select("key", "class_id", "n_links").dropDuplicates(["key"])
    # Stored first, so that the texts that were moved for it are gone before it is moved itself.
    return stored(fingerprints.fingerprint(docs)).join(classes.hint("merge"), "key", "left").drop("key")


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = linededup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.dedup_substrings(table(spark, sf_dir, "documents"), digest=True)


def op7_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pieces.encode(docs, pieces.load(PIECES_FILE)).drop("text")


def op8_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontam.verdicts(docs, table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "longest", "longest_item", "longest_at")


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge(table(spark, sf_dir, "pages"))


def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def op12_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = infill.fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select(
        "doc_id", "n", "form", F.col("prefix_units").alias("prefix_chars"), F.col("middle_units").alias("middle_chars"), F.sha2("output", 256).alias("output_sha256"),
        F.sha2(infill.restored(), 256).alias("restored_sha256"),
    )


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = centroids.cluster(table(spark, sf_dir, "embeddings"))
    shown = F.sha2(F.array_join(F.col("centroid").cast("array<string>"), ","), 256)
    return found.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", shown.alias("centroid_sha256"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f
        for f in (
            op1_jaccard_join, op2_toxicity, op3_fingerprints, op4_line_dedup, op5_language_id, op6_substring_dedup, op7_pieces, op8_licences, op9_decontamination,
            op10_url_filter, op11_sharding, op12_infill, op13_centroids
        )
    }


def oracle_sql() -> dict[str, str]:
    return ORACLE
