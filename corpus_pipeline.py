"""A training corpus from raw documents, in five stages; each works on all that the one before has kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lorebed.llm import chosenpath, decontam, langid, linededup, pieces
from lorebed.llm.job import discard, set_apart, stored
from lorebed.llm.queries import PIECES_FILE, table

#: A document stays if its language is this clear.
LEAST_SCORE = 0.5


def with_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is clear; those without a letter or text go. The model learns from the documents' own lang."""
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    model = langid.fit(docs.where(fold != 0))
    apart = set_apart(docs, {"text"})
    found = langid.predict(apart, model)
    return found.where((F.col("lang_pred") != langid.UNDETERMINED) & (F.col("score") >= LEAST_SCORE)).select(*apart.columns).toDF(*docs.columns)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines of recurring templates, and without those documents of which nothing is left."""
    apart = set_apart(docs, {"doc_id", "text", "n_chars"})
    kept = linededup.dedup_lines(apart)
    kept = kept.where((F.col("n_dropped") == 0) | F.col("text").rlike(r"[^\x09-\x0D\x20]"))
    return kept.withColumn("n_chars", F.when(F.col("n_dropped") == 0, F.col("n_chars")).otherwise(F.char_length("text").cast("long"))).select(*apart.columns).toDF(*docs.columns)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of equal or similar ones."""
    return chosenpath.dedup(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no benchmark item contaminates."""
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces in place of their texts."""
    return pieces.encode(docs, pieces.load(PIECES_FILE)).drop("text")  # ids, n_tokens and round_trip replace columns of these names


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", with_known_language),
    ("line_dedup", without_repeated_lines),
    ("jaccard_join", one_of_near_copies),
    ("decontamination", without_benchmark),
    ("pieces", encoded),
]

#: SQL can't express the language model, the join or the pieces; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        kept = stored(stage(spark, docs, sf_dir))
        discard(docs)  # of the stage before; the given table stays
        docs = kept
    return STAGES[-1][1](spark, docs, sf_dir)
