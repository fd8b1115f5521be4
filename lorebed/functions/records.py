"""Lenient coercions and derived values of knowledge records."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..vocabulary import FRESH_MONTHS, LEGAL_FORMS, STALE_MONTHS
from .text import strip


def as_text(c: Column) -> Column:
    """Numbers become text, null the empty text."""
    return F.coalesce(c.cast("string"), F.lit(""))


def as_list(c: Column) -> Column:
    """A text becomes a list of itself; null or the empty text an empty list."""
    return F.when(F.coalesce(c, F.lit("")) == "", F.array().cast("array<string>")).otherwise(F.array(c))


def confidence(c: Column) -> Column:
    """A number from 0 to 1, whatever the input: what isn't a number is 0."""
    number = c.cast("string").try_cast("double")
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.when(number.isNull() | F.isnan(number), 0.0).otherwise(number)))


def wiki_id(url: Column, name: Column, evidence: Column) -> Column:
    """Sixteen characters that the three texts determine; which hash is a choice of this library."""
    return F.substring(F.sha2(F.concat_ws("\u0001", as_text(url), as_text(name), as_text(evidence)), 256), 1, 16)


def published(text: Column) -> Column:
    """The date of YYYY-MM-DD, or the first of the month of YYYY-MM; else null."""
    return F.coalesce(
        F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date(text)),
        F.when(text.rlike(r"^\d{4}-\d{2}$"), F.try_to_date(F.concat(text, F.lit("-01"))))
    )


def date_precision(text: Column) -> Column:
    return F.when(published(text).isNull(), "none").when(F.length(text) == 7, "month").otherwise("day")


def age_months(date: Column, as_of: Column) -> Column:
    """Whole calendar months from the date to as_of."""
    return (F.year(as_of) - F.year(date)) * 12 + F.month(as_of) - F.month(date) - F.when(F.dayofmonth(as_of) < F.dayofmonth(date), 1).otherwise(0)


def currency(date: Column, as_of: Column) -> Column:
    age = age_months(date, as_of)
    return F.when(date.isNull(), "undated").when(age < FRESH_MONTHS, "fresh").when(age < STALE_MONTHS, "aging").otherwise("stale")


def normalize_name(c: Column) -> Column:
    """Lower case without punctuation and without legal forms at the end."""
    plain = F.trim(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), r"[^\p{L}\p{N}]+", " "))
    return F.regexp_replace(plain, rf"( ({'|'.join(LEGAL_FORMS)}))+$", "")


def temporal_note(date_range: Column, bucket: Column) -> Column:
    """`` (as of ...; currency: ...)``, without what is empty or fresh."""
    span, kind = strip(as_text(date_range)), strip(as_text(bucket))
    bits = F.array_compact(
        F.array(F.when(span != "", F.concat(F.lit("as of "), span)), F.when((kind != "") & (kind != "fresh"), F.concat(F.lit("currency: "), kind)))
    )
    return F.when(F.size(bits) > 0, F.concat(F.lit(" ("), F.array_join(bits, "; "), F.lit(")"))).otherwise("")
