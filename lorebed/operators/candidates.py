"""URL candidates: normalisation, classes, priorities, domain summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.urls import get_domain, get_host, normalize_url
from ..vocabulary import PRIORITY_ORDER, PRIORITY_RULES


def normalized(rows: DataFrame) -> DataFrame:
    """normalized_url and domain anew, with ``changed`` for rows in which either differs."""
    rows = rows.withColumns({"__url": normalize_url(F.col("url")), "__domain": get_domain(F.col("url"))})
    changed = ~(F.col("normalized_url").eqNullSafe(F.col("__url")) & F.col("domain").eqNullSafe(F.col("__domain")))
    return rows.withColumn("changed", changed).withColumns({"normalized_url": F.col("__url"), "domain": F.col("__domain")}).drop("__url", "__domain")


def classify(url_or_host: Column, rules: dict[str, list[str]] | None = None) -> Column:
    """skip, high, medium or low by the first list with a pattern that the host contains; else medium.

    A value with ``/`` or ``.`` is a url; any other is matched as it stands.
    """
    rules = rules or PRIORITY_RULES
    value = F.coalesce(url_or_host, F.lit(""))
    host = F.when(F.contains(value, F.lit("/")) | F.contains(value, F.lit(".")), get_host(value)).otherwise(value)
    out = F.lit("medium")
    for name in reversed(["skip", "high", "medium", "low"]):
        fits = F.lit(False)
        for pattern in rules.get(name, []):
            fits = fits | F.contains(host, F.lit(pattern))
        out = F.when(fits, name).otherwise(out)
    return out


def priority_rank(priority: Column) -> Column:
    """high before medium before low before skip; anything else counts as medium."""
    out = F.lit(1)
    for k, name in enumerate(PRIORITY_ORDER):
        out = F.when(priority == name, k).otherwise(out)
    return out


def prioritized(rows: DataFrame, order: str, rules: dict[str, list[str]] | None = None) -> DataFrame:
    """With priority, sorted by it and then by the rows' order."""
    return rows.withColumn("priority", classify(F.coalesce(F.col("normalized_url"), F.col("url")), rules)).orderBy(priority_rank(F.col("priority")), order)


def domain_summary(rows: DataFrame, order: str, rules: dict[str, list[str]] | None = None, titles: int = 3) -> DataFrame:
    """domain, url_count, priority (of the first row's url) and the first titles; most urls first, then first seen.

    The first titles are found by rank among the rows with one, which Spark limits before it shuffles, so no list of a whole domain is ever built.
    """
    from .dedupe import first_rank

    rows = rows.where(F.coalesce(F.col("domain"), F.lit("")) != "")
    counts = rows.groupBy("domain").agg(
        F.count("*").alias("url_count"),
        F.min_by(classify(F.coalesce(F.col("normalized_url"), F.col("domain")), rules), order).alias("priority"),
        F.min(order).alias("__first")
    )
    titled = rows.where(F.coalesce(F.col("title"), F.lit("")) != "").withColumn("__rank", first_rank(["domain"], order)).where(F.col("__rank") <= titles)
    samples = titled.groupBy("domain").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("__rank", "title"))), lambda s: s["title"]), " | ").alias("sample_titles")
    )
    out = counts.join(samples, "domain", "left").withColumn("sample_titles", F.coalesce("sample_titles", F.lit("")))
    return out.orderBy(F.desc("url_count"), "__first").select("domain", "url_count", "priority", "sample_titles")
