"""Counts, rollups and summaries."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import discard, stored


def most_common(rows: DataFrame, column: str, order: str, k: int = 0) -> DataFrame:
    """(value, n), most frequent first, ties by first appearance; the first k, or all."""
    counted = rows.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"), F.min(order).alias("__first")).orderBy(F.desc("n"), "__first")
    return (counted.limit(k) if k else counted).select("value", "n")


def value_counts(rows: DataFrame, column: str) -> DataFrame:
    """(value, n) without null, most frequent first."""
    return rows.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "value")


def pivot_counts(rows: DataFrame, by: str, column: str, values: list[str]) -> DataFrame:
    """How many rows each pair has, a column for each value; none is 0."""
    return rows.groupBy(by).pivot(column, values).count().na.fill(0, values)


def described(rows: DataFrame, columns: list[str], buckets: int = 1000) -> DataFrame:
    """One row for each column: count, mean, sample deviation, smallest, quartiles by interpolation, largest.

    The columns are stored as numbers. One pass gives all but the quartiles; these are found exactly by ``order_statistics``.
    """
    values = stored(rows.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(columns)]))
    first = values.agg(
        *[f(F.col(f"c{i}")).alias(f"{name}{i}") for i in range(len(columns)) for name, f in (("n", F.count), ("mean", F.avg), ("std", F.stddev_samp), ("min", F.min), ("max", F.max))]
    ).first()
    wanted = {}
    for i in range(len(columns)):
        for q in (0.25, 0.5, 0.75) if first[f"n{i}"] else ():
            wanted[i, q] = q * (first[f"n{i}"] - 1)
    ranks = {i: sorted({k for (j, _), at in wanted.items() if j == i for k in (math.floor(at), math.ceil(at))}) for i in range(len(columns))}
    found = order_statistics(values, {f"c{i}": (ranks[i], first[f"min{i}"], first[f"max{i}"]) for i in ranks if ranks[i]}, buckets)

    def quarter(i: int, q: float) -> float | None:
        if (i, q) not in wanted:
            return None
        at = wanted[i, q]
        low, high = found[f"c{i}", math.floor(at)], found[f"c{i}", math.ceil(at)]
        return low if low == high else (math.ceil(at) - at) * low + (at - math.floor(at)) * high

    out = [(c, first[f"n{i}"], first[f"mean{i}"], first[f"std{i}"], first[f"min{i}"], *(quarter(i, q) for q in (0.25, 0.5, 0.75)), first[f"max{i}"]) for i, c in enumerate(columns)]
    discard(values)
    return rows.sparkSession.createDataFrame(out, "column string, n long, mean double, std double, min double, q25 double, q50 double, q75 double, max double")


def order_statistics(values: DataFrame, wanted: dict[str, tuple[list[int], float, float]], buckets: int = 1000) -> dict[tuple[str, int], float]:
    """The values at some ranks, from 0, of columns of numbers: ``wanted`` has (ranks, smallest, largest) by column; nulls don't count.

    Each round counts the values of every open range in ``buckets`` equal parts, in one pass and with as many counts as there are parts, and goes on
    within the parts that hold the ranks, between their own smallest and largest values. A part of one value is found.
    """
    found: dict[tuple[str, int], float] = {}
    # (column, smallest, largest) -> [(rank within the range, rank)]
    open_ = {(c, low, high): [(r, r) for r in ranks] for c, (ranks, low, high) in wanted.items()}
    while open_:
        for (c, low, high), ranks in [*open_.items()]:
            if low == high:
                found |= {(c, rank): low for _, rank in ranks}
                del open_[c, low, high]
        if not open_:
            break
        ranges = list(open_)
        part = lambda c, low, high: F.least(F.floor((F.col(c) - low) / (high - low) * buckets), F.lit(buckets - 1))
        seen = F.array(*[F.when(F.col(c).between(low, high), F.struct(F.lit(k).alias("k"), part(c, low, high).alias("part"), F.col(c).alias("v"))) for k, (c, low, high) in enumerate(ranges)])
        counted = values.select(F.explode(F.array_compact(seen)).alias("s")).groupBy("s.k", "s.part").agg(F.count("*").alias("n"), F.min("s.v").alias("low"), F.max("s.v").alias("high"))
        parts = sorted(counted.collect(), key=lambda r: (r["k"], r["part"]))
        after: dict[tuple[str, float, float], list[tuple[int, int]]] = {}
        for k, own in enumerate(ranges):
            before = 0
            for r in (r for r in parts if r["k"] == k):
                inside = [(at - before, rank) for at, rank in open_[own] if before <= at < before + r["n"]]
                if inside:
                    after.setdefault((own[0], r["low"], r["high"]), []).extend(inside)
                before += r["n"]
        open_ = after
    return found


def exploded_counts(rows: DataFrame, column: str) -> DataFrame:
    """(value, n) of the members of a list column."""
    return value_counts(rows.select(F.explode(column).alias("value")), "value")


def crawl_report(crawled: DataFrame) -> DataFrame:
    """n by crawl status, duplicates among all pages, languages of successes and domains of failures, in long form: (part, value, n).

    Every row counts in up to four groups, which one aggregate takes apart by grouping sets: one scan, one shuffle of partial counts.
    """
    ok = F.col("crawl_status") == "success"
    rows = crawled.select(
        F.col("crawl_status").alias("status"), ok.alias("ok"), F.when(ok, F.col("language")).alias("language"), F.when(~ok, F.col("domain")).alias("failed_domain"),
        (F.col("is_duplicate_content") == "true").alias("duplicate"),
    )
    sets = [[F.col("status")], [F.col("ok"), F.col("language")], [F.col("ok"), F.col("failed_domain")], []]
    names = ["status", "ok", "language", "failed_domain"]
    counted = rows.groupingSets(sets, *[F.col(c) for c in names]).agg(F.count("*").alias("rows"), F.count_if("duplicate").alias("duplicates"), F.grouping_id().alias("g"))
    # The bits of g are set for the columns that a group leaves out.
    number = {part: sum(1 << (len(names) - 1 - names.index(c)) for c in names if c not in kept) for part, kept in (("status", ["status"]), ("language", ["ok", "language"]), ("failed_domain", ["ok", "failed_domain"]), ("duplicates", []))}
    part = F.create_map(*[F.lit(x) for p, g in number.items() for x in (g, p)])
    out = counted.withColumn("part", F.element_at(part, F.col("g").cast("int")))
    out = out.where((F.col("part") != "language") | F.col("ok")).where((F.col("part") != "failed_domain") | ~F.col("ok"))
    value = F.when(F.col("part") == "status", F.col("status")).when(F.col("part") == "language", F.col("language")).when(F.col("part") == "failed_domain", F.col("failed_domain")).otherwise("")
    return out.select("part", value.alias("value"), F.when(F.col("part") == "duplicates", F.col("duplicates")).otherwise(F.col("rows")).alias("n"))


def rollup_counts(entities: DataFrame) -> DataFrame:
    """By category and county, with totals: entities, facilities, different sources."""
    return entities.rollup("category", "county").agg(
        F.count("*").alias("entities"), F.sum("facilities").alias("facilities"), F.count_distinct("source_url").alias("sources")
    )
