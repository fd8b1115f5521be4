"""Flat exports of entity profiles."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.records import as_text, temporal_note
from ..functions.text import slug, strip
from ..vocabulary import ENTITY_COLUMNS, ENTITY_JSON, SOURCE_COLUMNS, WHAT_QUESTION, WHERE_ANSWER, WHERE_QUESTION


def json_cell(column: Column, kind: T.DataType) -> Column:
    """JSON with nulls kept; whatever is empty, zero, false or null becomes ``[]``. Structure, not spacing, is what counts."""
    if isinstance(kind, (T.ArrayType, T.MapType)):
        return F.when(F.coalesce(F.size(column), F.lit(0)) <= 0, "[]").otherwise(F.to_json(column, {"ignoreNullFields": "false"}))
    if isinstance(kind, T.StructType):
        return F.when(column.isNull(), "[]").otherwise(F.to_json(column, {"ignoreNullFields": "false"}))
    wrapped = F.to_json(F.struct(column.alias("v")))
    bare = F.substr(wrapped, F.lit(6), F.length(wrapped) - 6)  # without {"v": and }
    return F.when(column.isNull() | bare.isin('""', "0", "0.0", "-0.0", "false"), "[]").otherwise(bare)


def source_count(entities: DataFrame) -> Column:
    """The stored number, or how many sources there are if that is null or 0."""
    sources = F.coalesce(F.size("sources"), F.lit(0)) if "sources" in entities.columns else F.lit(0)
    return F.coalesce(
        F.nullif(F.col("source_count").cast("int"), F.lit(0)), F.greatest(sources, F.lit(0))
    ) if "source_count" in entities.columns else F.greatest(sources, F.lit(0))


def first_entities(entities: DataFrame, limit: int = 0, order: str = "_ord") -> DataFrame:
    """The first entities by order, or all for 0: exports of entities count their limit before anything is exploded."""
    return entities.orderBy(order).limit(limit) if limit else entities


def final_wiki(entities: DataFrame, limit: int = 0) -> DataFrame:
    """The wide table: every column, lists as JSON, missing ones empty. A limit counts entities in order."""
    entities = first_entities(entities, limit)

    def cell(name: str) -> Column:
        if name == "source_count":
            return source_count(entities)
        if name not in entities.columns:
            return F.lit("[]" if name in ENTITY_JSON else "")
        if name in ENTITY_JSON:
            return json_cell(F.col(name), entities.schema[name].dataType)
        return as_text(F.col(name))

    return entities.select(*[cell(c).alias(c) for c in ENTITY_COLUMNS])


def sources(entities: DataFrame, limit: int = 0) -> DataFrame:
    """One row for each source of each entity; what is missing is empty. The limit, if any, counts exploded rows in order."""
    rows = entities.select("_ord", "canonical_name", "claim_status", F.posexplode("sources").alias("place", "s"))
    out = rows.select("_ord", "place", *[as_text(F.col(c) if c in ("canonical_name", "claim_status") else F.col(f"s.{c}")).alias(c) for c in SOURCE_COLUMNS])
    return out.orderBy("_ord", "place").limit(limit) if limit else out


def ungrounded_urls(rows: DataFrame, key: str = "canonical_name") -> DataFrame:
    """For each entity its ungrounded urls in order, blanks left out, comma-separated."""
    bad = rows.where(~F.col("is_grounded") & (F.coalesce("source_url", F.lit("")) != ""))
    return bad.groupBy(key).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "source_url"))), lambda s: s["source_url"]), ", ").alias("urls")
    )


def finetuning(entities: DataFrame, limit: int = 0) -> DataFrame:
    """No, one or two examples for each entity: what it does, and where, if it has locations. Both end with the first source. A limit counts entities in order."""
    entities = first_entities(entities, limit)
    urls = F.filter(F.transform(F.coalesce("sources", F.expr("array()")), lambda s: s["source_url"]), lambda u: F.coalesce(u, F.lit("")) != "")
    rows = entities.withColumns({"u": urls, "o": strip(as_text(F.col("overview")))}).where(
        (F.coalesce("canonical_name", F.lit("")) != "") & (F.col("o") != "") & (F.size("u") > 0)
    )
    ending = F.concat(temporal_note(F.col("publication_date_range"), F.col("currency")), F.lit(" Source: "), F.get("u", F.lit(0)))
    name = F.col("canonical_name")
    filled = lambda template, **values: _filled(template, {"name": name, **values})
    what = F.struct(F.lit(0).alias("k"), filled(WHAT_QUESTION).alias("instruction"), F.lit("").alias("input"), F.concat("o", ending).alias("output"))
    place = F.concat(filled(WHERE_ANSWER, places=F.array_join("locations", ", ")), ending)
    where = F.struct(F.lit(1).alias("k"), filled(WHERE_QUESTION).alias("instruction"), F.lit("").alias("input"), place.alias("output"))
    examples = F.array_compact(F.array(what, F.when(F.size("locations") > 0, where)))
    return rows.select("_ord", F.explode(examples).alias("e")).select("_ord", "e.*")


def _filled(template: str, values: dict[str, Column]) -> Column:
    """The template's text with ``{name}`` and the like replaced; the values' own braces stay as they are."""
    parts = re.split(r"[{](\w+)[}]", template)
    return F.concat(*[values[part] if k % 2 else F.lit(part) for k, part in enumerate(parts)])


def wiki_lines(entities: DataFrame) -> DataFrame:
    """The line of each entity in a listing from A to Z: link, county and the overview up to its first period."""
    blurb = F.split_part(as_text(F.col("overview")), F.lit("."), F.lit(1))
    county = F.when(as_text(F.col("county")) == "", "").otherwise(F.concat(F.lit(" _("), F.col("county"), F.lit(")_")))
    return entities.select(
        "canonical_name", "category", "county",
        F.concat(F.lit("- [["), slug(F.col("canonical_name")), F.lit("|"), F.col("canonical_name"), F.lit("]]"), county, F.lit(" — "), blurb).alias("line")
    ).orderBy(F.lower("canonical_name"), "canonical_name")


def wiki_pages(entities: DataFrame) -> DataFrame:
    """(file_name, part, name, line) of the index, of a page for each category and of one for each county; a page's lines are in order of part and name.

    ``entities`` has canonical_name, category, county (empty: none), overview, facilities (how many) and source_urls. Part 0 is a page's totals; the index then
    links to the categories, the counties and all entities, the other pages to their entities. Lines stay rows, so no page is ever put together in one task.
    """
    title = lambda c: F.initcap(F.replace(c, F.lit("_"), F.lit(" ")))
    link = lambda page, name: F.concat(F.lit("- [["), page, F.lit("|"), name, F.lit("]]"))
    county_page = F.concat(F.lit("county-"), slug(F.col("county")))
    concept_page = F.replace(F.col("category"), F.lit("_"), F.lit("-"))
    line = lambda rows, file, part, name, text: rows.select(F.concat(file, F.lit(".md")).alias("file_name"), F.lit(part).alias("part"), name.alias("name"), text.alias("line"))
    placed = entities.where(F.coalesce("county", F.lit("")) != "")
    sources = entities.select(F.explode("source_urls").alias("u")).agg(F.count_distinct("u").alias("sources"))
    # Two frames of one row each.
    totals = entities.agg(F.count("*").alias("n"), F.coalesce(F.sum("facilities"), F.lit(0)).alias("f")).crossJoin(F.broadcast(sources))
    concepts = entities.groupBy("category").agg(F.count("*").alias("n"), F.coalesce(F.sum("facilities"), F.lit(0)).alias("f"))
    counties = placed.groupBy("county").agg(F.count("*").alias("n"))
    said = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])
    name, kind = F.col("canonical_name"), title(F.col("category"))
    index, concept, county = F.lit("index"), F.concat(F.lit("concepts/"), concept_page), F.concat(F.lit("geography/"), county_page)
    entity = said(link(slug(name), name), " — ", kind)
    listed = wiki_lines(entities).select("canonical_name", "category", "line")
    parts = [
        line(totals, index, 0, F.lit(""), said("*Auto-generated catalog. ", F.col("n"), " entities · ", F.col("f"), " facilities · ", F.col("sources"), " unique sources.*")),
        line(concepts, index, 1, kind, said(link(concept_page, kind), " — ", F.col("n"), " entities")),
        line(counties, index, 2, F.col("county"), said(link(county_page, F.col("county")), " — ", F.col("n"), " entities")),
        line(entities, index, 3, name, entity),
        line(concepts, concept, 0, F.lit(""), said("Supply-chain segment covering **", F.col("n"), " entities** and **", F.col("f"), " facilities** in the Georgia EV corpus.")),
        line(listed, concept, 1, name, F.col("line")),
        line(counties, county, 0, F.lit(""), said("Georgia county with **", F.col("n"), " EV supply-chain entities** in the corpus.")),
        line(placed, county, 1, name, entity),
    ]
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return out
