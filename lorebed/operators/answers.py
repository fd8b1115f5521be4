"""Whole answers of a language model as records: JSON parsed leniently into variants, each field coerced to its type, what can't be read kept with a reason."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.records import as_list, as_text, confidence
from ..functions.text import strip
from ..vocabulary import RECORD_LISTS, RECORD_SECTIONS, RECORD_TEXTS

#: A block that an answer may wrap its JSON in.
_FENCE = r"(?s)\A```[a-zA-Z]*\s*\n(.*?)\n?```\s*\z"


def _field(v: Column, name: str, kind: str) -> Column:
    return F.try_variant_get(v, f"$.{name}", kind)


def text_field(v: Column, name: str) -> Column:
    """Numbers and flags become text, null and what is missing the empty text; a list or an object becomes its JSON."""
    return as_text(_field(v, name, "string"))


def list_field(v: Column, name: str) -> Column:
    """A list without nulls, its members as texts; a single value is a list of itself; null, the empty text and what is missing are an empty list."""
    many = F.array_compact(_field(v, name, "array<string>"))
    return F.coalesce(many, as_list(_field(v, name, "string")))


def section_field(v: Column, name: str) -> Column:
    """A list of objects with the section's fields; a single object is a list of itself, anything else an empty list."""
    fields = RECORD_SECTIONS[name]
    shaped = lambda o: F.struct(*[(list_field(o, f) if kind == "list" else text_field(o, f)).alias(f) for f, kind in fields.items()])
    one = _field(v, name, "variant")
    objects = F.filter(F.coalesce(_field(v, name, "array<variant>"), F.array(one)), lambda o: F.coalesce(F.startswith(F.schema_of_variant(o), F.lit("OBJECT")), F.lit(False)))
    return F.transform(objects, shaped)


def records(answers: DataFrame, column: str = "answer") -> DataFrame:
    """The answers' columns with ``place``, the record's fields and ``reason``; a row for each record, and one for each answer that can't be read.

    An answer is JSON, also within a fenced block: an object with ``records``, or a list of them. Without ``records`` it has none, and so no row.
    ``reason`` is null for a record; else ``malformed_json`` (also for null), ``not_an_answer`` for JSON of another kind, ``records_not_a_list`` or ``record_not_an_object``,
    with empty fields. Input columns with the names of fields are replaced.
    """
    made = ["place", "reason", *RECORD_TEXTS, *RECORD_LISTS, *RECORD_SECTIONS, "confidence_score"]
    kept = [c for c in answers.columns if c not in made]
    body = strip(F.coalesce(F.col(column), F.lit("")))
    whole = F.try_parse_json(F.when(body.rlike(_FENCE), F.regexp_extract(body, _FENCE, 1)).otherwise(body))
    rows = answers.select(*kept, whole.alias("__v")).withColumn("__kind", F.schema_of_variant("__v"))
    is_list, is_object = F.startswith("__kind", F.lit("ARRAY")), F.startswith("__kind", F.lit("OBJECT"))
    inner = F.try_variant_get("__v", "$.records", "variant")
    named = F.when(is_list, F.col("__v")).when(is_object, inner)
    rows = rows.withColumns({"__records": F.when(named.isNotNull(), F.try_variant_get(named, "$", "array<variant>")), "__named": named})
    said = F.coalesce(F.schema_of_variant("__named"), F.lit("VOID"))
    reason = F.when(F.col("__v").isNull(), "malformed_json").when(~is_list & ~is_object, "not_an_answer").when((said != "VOID") & F.col("__records").isNull(), "records_not_a_list")
    rows = rows.withColumn("reason", reason)
    nothing = F.array(F.lit(None).cast("variant"))
    each = F.when(F.col("reason").isNotNull(), nothing).otherwise(F.coalesce("__records", F.array().cast("array<variant>")))
    rows = rows.select(*kept, "reason", F.posexplode(each).alias("place", "__r"))
    odd = F.col("reason").isNull() & ~F.coalesce(F.startswith(F.schema_of_variant("__r"), F.lit("OBJECT")), F.lit(False))
    rows = rows.withColumn("reason", F.when(odd, "record_not_an_object").otherwise(F.col("reason")))
    r = F.when(F.col("reason").isNull(), F.col("__r"))
    return rows.select(
        *kept, F.when(F.coalesce(F.col("reason") == "record_not_an_object", F.col("reason").isNull()), F.col("place")).alias("place"), "reason",
        *[text_field(r, c).alias(c) for c in RECORD_TEXTS], *[F.coalesce(list_field(r, c), F.array().cast("array<string>")).alias(c) for c in RECORD_LISTS],
        *[section_field(r, c).alias(c) for c in RECORD_SECTIONS], confidence(_field(r, "confidence_score", "string")).alias("confidence_score"),
    )
