"""Record validation: reasons, grounding in the page, pass and fail."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.fuzzy import partial_at_least
from ..functions.records import as_text, confidence
from ..functions.text import casefold, fold_spaces, strip
from ..sources.scratch import stored
from ..vocabulary import CATEGORIES, ENTITY_TYPES, GROUNDING_THRESHOLD, MAX_UNVALIDATED_CONFIDENCE, MIN_CONFIDENCE, PAGE_CLAIM_STATUSES
from .dedupe import dedupe_facts


def field_reasons(records: DataFrame) -> DataFrame:
    """With rejection_reasons, written anew, and confidence_score from 0 to the cap before validation."""
    score = confidence(F.col("confidence_score"))
    empty = lambda c: strip(F.coalesce(F.col(c), F.lit(""))) == ""
    reasons = F.array(
        F.when(empty("entity_name"), "missing_entity_name"), F.when(empty("evidence_text"), "missing_evidence"),
        F.when(empty("source_url"), "missing_source_url"),
        F.when(~F.coalesce(F.col("entity_type"), F.lit("")).isin(ENTITY_TYPES), "invalid_entity_type"),
        F.when(~F.coalesce(F.col("supply_chain_category"), F.lit("")).isin(CATEGORIES), "invalid_category"),
        F.when(~F.coalesce(F.col("claim_status"), F.lit("")).isin(PAGE_CLAIM_STATUSES), "invalid_claim_status"),
        F.when(score < MIN_CONFIDENCE, "low_confidence"),
    )
    return records.withColumns({"rejection_reasons": F.array_compact(reasons), "confidence_score": F.least(score, F.lit(MAX_UNVALIDATED_CONFIDENCE))})


def grounded(
    rows: DataFrame, evidence: str = "evidence_text", page: str = "page_markdown", threshold: float = GROUNDING_THRESHOLD,
    fuzzy: bool = True, folded: bool = False
) -> DataFrame:
    """With is_grounded: the evidence is part of the page, white space and case aside, or close to a part of it.

    Python gets texts only where the native test leaves it open, and nulls for all other rows. ``folded``: the pages are folded already, once
    for all claims about them.
    """
    a, b = F.col("__evidence"), F.col("__page")
    rows = rows.withColumns({"__evidence": fold_spaces(F.col(evidence)), "__page": F.coalesce(F.col(page), F.lit("")) if folded else fold_spaces(F.col(page))})
    rows = rows.withColumn("is_grounded", (a != "") & (b != "") & F.contains(b, a))
    if fuzzy:
        open_ = ~F.col("is_grounded") & (a != "") & (b != "")
        rows = rows.withColumn("is_grounded", F.col("is_grounded") | partial_at_least(threshold)(F.when(open_, a), F.when(open_, b)))
    return rows.drop("__evidence", "__page")


def validate(records: DataFrame, pages: DataFrame, fuzzy: bool = True) -> DataFrame:
    """Records with their page's text by page_id, reasons and validation_status; a missing page is empty.

    Related organisations and fields are cleaned first. Grounding is asked only of records with evidence.
    """
    folded = pages.select("page_id", fold_spaces(F.col("page_markdown")).alias("page_markdown"))
    checked = field_reasons(normalize_records(records)).join(folded, "page_id", "left")
    asked = ~F.array_contains("rejection_reasons", "missing_evidence")
    tested = grounded(checked.withColumn("__asked", F.when(asked, F.col("evidence_text"))), evidence="__asked", fuzzy=fuzzy, folded=True).drop("__asked", "page_markdown")
    reasons = F.when(F.col("is_grounded") | ~asked, F.col("rejection_reasons")).otherwise(F.array_append("rejection_reasons", F.lit("unsupported_claim")))
    return tested.withColumn("rejection_reasons", reasons).withColumn(
        "validation_status", F.when(F.size("rejection_reasons") == 0, "passed").otherwise("failed")
    )


def split(validated: DataFrame, earlier_failures: DataFrame | None = None, order: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(passed, failed); failures of generation stay among the failed on every rerun. With an order, passed records that repeat an
    earlier one's fact are failures too. What was validated is stored, as both parts read it."""
    validated = stored(validated)
    passed, failed = validated.where("validation_status = 'passed'"), validated.where("validation_status = 'failed'")
    if earlier_failures is not None:
        failed = earlier_failures.where("failure_stage = 'generation'").unionByName(failed, allowMissingColumns=True)
    if order is not None:
        passed, repeats = dedupe_facts(passed, order)
        failed = failed.unionByName(repeats, allowMissingColumns=True)
    return passed, failed


def normalize_records(records: DataFrame) -> DataFrame:
    """Texts stripped, and related organisations without those that name nothing, the record's own entity or one named before.

    The absent original is known by its name alone; what it cleans is a choice of this library.
    """
    texts = [
        f.name for f in records.schema.fields if f.dataType.typeName() == "string" and f.name in ("entity_name", "entity_type", "supply_chain_category", "claim_status", "source_url")
    ]
    records = records.withColumns({c: strip(F.col(c)) for c in texts}) if texts else records
    if "related_organizations" not in records.columns:
        return records
    given = F.coalesce(F.col("related_organizations"), F.array().cast(records.schema["related_organizations"].dataType))
    named = F.transform(given, lambda o: o.withField("name", strip(as_text(o["name"]))))
    # Names are folded once and sorted with their places, so that repeats are neighbours; comparing each with all before it takes hours on long lists.
    ranked = lambda r: F.sort_array(F.transform(r["named"], lambda o, k: F.struct(casefold(F.coalesce(o["name"], F.lit(""))).alias("name"), k.alias("place"))))
    new = lambda s, r, k: (k == 0) | (s["name"] != F.get(r["ranked"], k - 1)["name"])
    kept = lambda r: F.filter(r["ranked"], lambda s, k: (s["name"] != "") & (s["name"] != r["self"]) & new(s, r, k))
    places = lambda r: F.sort_array(F.transform(kept(r), lambda s: s["place"]))
    first = lambda r: F.transform(places(r), lambda k: F.get(r["named"], k))
    # Each step is bound to a name; written out, it would be made anew for each organisation.
    bound = F.struct(named.alias("named"), casefold(F.coalesce(F.col("entity_name"), F.lit(""))).alias("self"))
    steps = F.transform(F.array(bound), lambda r: r.withField("ranked", ranked(r)))
    return records.withColumn("related_organizations", F.get(F.transform(steps, first), F.lit(0)))


def with_shared_organizations(records: DataFrame, lists: DataFrame, key: str) -> DataFrame:
    """Normalised records, each with the organisations of its key's list (key and related_organizations) behind its own: the same as if each had
    held the list when it was normalised, but a list is cleaned once and not once for each record. Lists are broadcast; no key has two."""
    shared = normalize_records(lists.select(F.col(key).alias("__key"), F.lit("").alias("entity_name"), "related_organizations"))
    shared = shared.select("__key", F.col("related_organizations").alias("__shared"), F.transform("related_organizations", lambda o: casefold(o["name"])).alias("__names"))
    rows = normalize_records(records).join(F.broadcast(shared), F.col(key) == F.col("__key"), "left")
    own = F.transform("related_organizations", lambda o: casefold(o["name"]))
    rows = rows.withColumn("__taken", F.array_append(own, casefold(F.coalesce(F.col("entity_name"), F.lit("")))))
    other = F.filter("__shared", lambda o, k: ~F.array_contains("__taken", F.get(F.col("__names"), k)))
    more = F.when(F.arrays_overlap("__names", "__taken"), other).otherwise(F.coalesce(F.col("__shared"), F.slice("related_organizations", 1, 0)))
    return rows.withColumn("related_organizations", F.concat("related_organizations", more)).drop("__key", "__shared", "__names", "__taken")


def demote_ungrounded(entities: DataFrame, pages: DataFrame, key: str = "canonical_name", fuzzy: bool = True) -> DataFrame:
    """Entities with kept: at least one source's evidence is in that source's page. All keep all their sources;
    conflicts_or_uncertainties names the urls of sources that aren't grounded."""
    sources = entities.select(F.col(key).alias("__k"), F.posexplode("sources").alias("place", "s")).select("__k", "place", "s.*")
    pages = pages.groupBy("source_url").agg(F.max_by("page_markdown", "path").alias("page_markdown"))
    pages = pages.select("source_url", fold_spaces(F.col("page_markdown")).alias("page_markdown"))
    tested = grounded(sources.join(pages, "source_url", "left"), fuzzy=fuzzy, folded=True)
    found = tested.groupBy("__k").agg(
        F.max("is_grounded").alias("kept"),
        F.array_sort(F.collect_list(F.when(~F.col("is_grounded") & (F.coalesce("source_url", F.lit("")) != ""), F.struct("place", "source_url")))).alias("bad")
    )
    bad = F.transform("bad", lambda s: s["source_url"])
    out = entities.join(found, entities[key] == F.col("__k"), "left").withColumn("kept", F.coalesce("kept", F.lit(False)))
    note = F.concat(F.lit("Ungrounded sources: "), F.array_join(bad, ", "))
    old = F.coalesce(F.col("conflicts_or_uncertainties"), F.array().cast("array<string>"))
    return out.withColumn("conflicts_or_uncertainties", F.when(F.size("bad") > 0, F.array_append(old, note)).otherwise(old)).drop("__k", "bad")
