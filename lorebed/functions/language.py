"""The language of a text by its commonest words, natively."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Very common words, of which few are shared between these languages.
COMMON = {
    "de": ["der", "die", "und", "das", "ist", "nicht", "mit", "von", "den", "für"],
    "en": ["the", "and", "of", "to", "is", "that", "for", "with", "this", "was"],
    "es": ["el", "los", "las", "que", "por", "del", "con", "una", "para", "como"],
    "fr": ["le", "les", "des", "et", "est", "dans", "une", "pour", "qui", "sur"],
}


def detect_language(c: Column, length: int | None = 2000) -> Column:
    """The language with most common words among the first ``length`` characters (None: all); ``unknown`` without any. Ties go to the first by name."""
    text = F.coalesce(c, F.lit(""))
    words = F.split(F.lower(F.substring(text, 1, length) if length else text), r"[^\p{L}]+")
    counts = F.array(*[F.struct(_count(words, COMMON[k]).alias("n"), F.lit(-i).alias("i"), F.lit(k).alias("lang")) for i, k in enumerate(sorted(COMMON))])
    best = F.array_max(counts)
    return F.when(best["n"] > 0, best["lang"]).otherwise("unknown")


def _count(words: Column, wanted: list[str]) -> Column:
    return F.size(F.filter(words, lambda w: w.isin(wanted)))
