"""Records from pages without a language model: pages say in directives what an extractor is to find, so that all later stages can run offline."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import prefix, strip
from ..vocabulary import PROMPT_CHARS


def mock_records(pages: DataFrame, length: int = PROMPT_CHARS) -> DataFrame:
    """One record for each ``MOCK_ENTITY:`` line of a page; none for a page with ``MOCK_EMPTY``; ``MOCK_BAD_ENUM`` makes its type invalid.

    Pages are cut to what a prompt would hold. The evidence is the first paragraph that names the entity.
    """
    text = prefix(F.coalesce("page_markdown", F.lit("")), length)
    rows = pages.withColumn("__text", text).where(~F.col("__text").rlike(r"(?m)^MOCK_EMPTY\s*$"))
    names = F.regexp_extract_all("__text", F.lit(r"(?m)^MOCK_ENTITY:[ \t]*(.+?)[ \t]*$"), F.lit(1))
    rows = rows.select("page_id", "source_url", "__text", F.explode(names).alias("entity_name"))
    bad = F.col("__text").rlike(r"(?m)^MOCK_BAD_ENUM\s*$")
    paragraphs = F.filter(F.split("__text", r"\n\s*\n"), lambda p: F.contains(p, F.col("entity_name")) & ~F.startswith(strip(p), F.lit("MOCK_")))
    return rows.select(
        "page_id", "source_url", "entity_name", strip(F.coalesce(F.get(paragraphs, F.lit(0)), F.lit(""))).alias("evidence_text"),
        F.when(bad, "not_a_type").otherwise("company").alias("entity_type"),
        F.when(bad, "not_a_category").otherwise("unknown").alias("supply_chain_category"), F.lit("announced").alias("claim_status"),
        F.lit("0.9").alias("confidence_score"),
    )
