"""Entities from names: blocking, similarity, clusters, profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.fuzzy import token_sort_ratio_udf
from ..functions.records import normalize_name
from ..sources.scratch import stored
from ..vocabulary import ENTITY_ALIASES, MERGE_THRESHOLD, REVIEW_THRESHOLD
from .graph import agglomerated


def aliases(spark: SparkSession, known: dict[str, list[str]] | None = None) -> DataFrame:
    """(alias, canonical), both normalised; a fixed handful of rows."""
    rows = [(a, c) for c, names in (known or ENTITY_ALIASES).items() for a in names]
    return spark.createDataFrame(rows, "a string, c string").select(normalize_name(F.col("a")).alias("alias"), normalize_name(F.col("c")).alias("canonical"))


def canonical(names: DataFrame, known: DataFrame, name: str = "name") -> DataFrame:
    """The normalised name, with aliases replaced."""
    rows = names.withColumn("__n", normalize_name(F.col(name)))
    return rows.join(known, F.col("__n") == F.col("alias"), "left").withColumn("canonical_name", F.coalesce("canonical", "__n")).drop("__n", "alias", "canonical")


def _tokens(text: Column, size: int) -> Column:
    """The substrings of a size, each with the number of its occurrence, so that a list of them is a set."""
    parts = F.transform(F.sequence(F.lit(1), F.greatest(F.length(text) - size + 1, F.lit(1))), lambda i: F.substr(text, i, F.lit(size)))
    # The list is bound to a name once; written out, it would be made anew for each of its members.
    number = lambda p: F.transform(p, lambda t, k: F.concat(t, F.size(F.filter(F.slice(p, F.lit(1), k), lambda u: u == t)).cast("string")))
    return F.when(F.length(text) >= size, F.get(F.transform(F.array(parts), number), F.lit(0))).otherwise(F.array().cast("array<string>"))


def _shared_characters(x: Column, y: Column, least: float) -> Column:
    """What a common subsequence of two names this alike has at least: ratio = 200 c / (x + y)."""
    return F.ceil(least * (x + y) / 200 - 1e-9).cast("int")


def _shared_bigrams(x: Column, y: Column, least: float) -> Column:
    """Bigrams that two names this alike share at least: each character that is only in one breaks two bigrams of it and one of the other."""
    c = _shared_characters(x, y, least)
    return F.greatest((x - 1) - 2 * (x - c) - (y - c), (y - 1) - 2 * (y - c) - (x - c)).cast("int")


def _rarest(rows: DataFrame, tokens: str, keep: Column) -> DataFrame:
    """(token, n) of the ``keep`` rarest tokens of each name, by how many names have each."""
    each = rows.select("n", keep.alias("__keep"), F.explode(tokens).alias("token"))
    often = each.groupBy("token").agg(F.count("*").alias("names"))
    ordered = each.join(often, "token").groupBy("n").agg(
        F.first("__keep").alias("__keep"), F.array_sort(F.collect_list(F.struct("names", "token"))).alias("all")
    )
    return ordered.select(
        "n", F.explode(F.slice("all", F.lit(1), F.greatest(F.col("__keep"), F.lit(0)))).alias("t")
    ).select(F.col("t.token").alias("token"), "n")


def candidate_pairs(names: DataFrame, least: float = REVIEW_THRESHOLD, name: str = "name") -> DataFrame:
    """(a, b) of different names that may have a token-sort ratio of ``least`` or more, and none of the others left out.

    Two names that share at least t of their tokens have one in common among all but t - 1 of each one's tokens, in any order; the rarest come first, so
    hot tokens hardly count. Tokens are bigrams, or characters for names too short for a bigram to be sure. Pairs that meet
    are then held against the numbers of characters and bigrams that they have to share.
    """
    rows = names.select(F.array_join(F.array_sort(F.split(F.trim(name), " +")), " ").alias("s"), F.col(name).alias("n")).where("s <> ''").distinct()
    rows = rows.withColumns({"len": F.length("s"), "chars": _tokens(F.col("s"), 1), "grams": _tokens(F.col("s"), 2)})
    low, high = (F.ceil(F.col("len") * least / (200 - least) - 1e-9).cast("int"), F.floor(F.col("len") * (200 - least) / least + 1e-9).cast("int"))
    partners = F.sequence(F.greatest(low, F.lit(1)), F.greatest(high, F.lit(1)))
    fewest = lambda shared: F.array_min(F.transform(partners, lambda y: shared(F.col("len"), y, least)))
    # Read five times from here on.
    rows = stored(rows.withColumns({"sure_chars": fewest(_shared_characters), "sure_grams": fewest(_shared_bigrams)}))
    by_gram = _rarest(rows.where("sure_grams >= 1"), "grams", F.size("grams") - F.col("sure_grams") + 1)
    by_char = _rarest(rows, "chars", F.size("chars") - F.greatest(F.col("sure_chars"), F.lit(1)) + 1)
    short = by_char.join(rows.where("sure_grams < 1").select("n"), "n", "left_semi")
    meet = lambda x, y: x.select("token", F.col("n").alias("x")).join(y.select("token", F.col("n").alias("y")), "token").where("x <> y").select(
        F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")
    )
    pairs = meet(by_gram, by_gram).where("a < b").unionByName(meet(short, by_char)).distinct()
    side = lambda c: rows.select(F.col("n").alias(c), *(F.col(k).alias(f"{k}_{c}") for k in ("len", "chars", "grams")))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    common = lambda k: F.size(F.array_intersect(f"{k}_a", f"{k}_b"))
    fine = (
        common("chars") >= _shared_characters(F.col("len_a"), F.col("len_b"), least)
    ) & (common("grams") >= _shared_bigrams(F.col("len_a"), F.col("len_b"), least))
    return both.where(fine).select("a", "b")


def similar_pairs(names: DataFrame, least: float = REVIEW_THRESHOLD, name: str = "name") -> DataFrame:
    """(a, b, score) of different names with a token-sort ratio of ``least`` or more, a before b."""
    return candidate_pairs(names, least, name).withColumn("score", token_sort_ratio_udf("a", "b")).where(F.col("score") >= least)


def cluster(names: DataFrame, merge: float = MERGE_THRESHOLD, review: float = REVIEW_THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """(name, cluster) of every name, and the pairs (a, b, score) to look at.

    ``names`` has name, _ord and location; a name's location is the first that isn't empty. Pairs of names at ``merge`` or more are taken one by one, the
    most alike first, and unite the clusters of both unless each has a location and these differ: so no cluster has two locations, also
    not over names that have none. A cluster's name is that of its first row. Pairs from ``review`` up whose names are in different clusters are flagged.
    """
    place = F.min_by(F.nullif("location", F.lit("")), F.when(F.coalesce("location", F.lit("")) != "", F.col("_ord")))
    rows = stored(names.groupBy("name").agg(F.min("_ord").alias("_ord"), place.alias("mark")))
    pairs = stored(similar_pairs(rows, review))
    groups = agglomerated(pairs.where(F.col("score") >= merge), rows.select(F.col("name").alias("node"), "mark"))
    found = rows.join(groups, rows.name == groups.node, "left").withColumn("root", F.coalesce("root", "name"))
    heads = found.groupBy("root").agg(F.min_by("name", "_ord").alias("cluster"))
    clusters = stored(found.join(heads, "root").select("name", "cluster"))
    side = lambda c: clusters.select(F.col("name").alias(c), F.col("cluster").alias(f"cluster_{c}"))
    apart = pairs.join(side("a"), "a").join(side("b"), "b").where("cluster_a <> cluster_b")
    return clusters, apart.select("a", "b", "score")


def with_dates(records: DataFrame, dates: DataFrame, key: str = "page_id") -> DataFrame:
    """Records with the publication date of a side table (key and publication_date) where they have none of their own; unknown dates are empty."""
    found = dates.groupBy(key).agg(F.min(F.nullif("publication_date", F.lit(""))).alias("__date"))
    own = F.nullif(F.col("publication_date"), F.lit("")) if "publication_date" in records.columns else F.lit(None).cast("string")
    return records.join(found, key, "left").withColumn("publication_date", F.coalesce(own, F.col("__date"), F.lit(""))).drop("__date")


def profiles(records: DataFrame, cluster_of: DataFrame) -> DataFrame:
    """One profile for each cluster of validated records: its names, types, places, facts, sources, dates and best confidence.

    Values that hold for a whole cluster are kept as sets, in alphabetical order; the overview is the longest one, of equally long ones the first by text.
    """
    rows = records.join(cluster_of.withColumnRenamed("name", "entity_name"), "entity_name")
    facts = F.array_sort(F.array_distinct(F.flatten(F.collect_set("key_facts"))))
    more = []
    if "locations" in records.columns:
        more.append(F.array_sort(F.array_distinct(F.flatten(F.collect_set("locations")))).alias("locations"))
    if "overview" in records.columns:
        longest = F.min(F.struct(-F.char_length(F.coalesce("overview", F.lit(""))), F.coalesce("overview", F.lit("")).alias("overview")))
        more.append(longest["overview"].alias("overview"))
    return rows.groupBy(F.col("cluster").alias("canonical_name")).agg(
        F.array_sort(F.collect_set("entity_name")).alias("aliases"), F.min_by("entity_type", "_ord").alias("entity_type"),
        F.array_sort(F.collect_set("supply_chain_category")).alias("supply_chain_categories"), facts.alias("key_facts"),
        F.array_sort(F.collect_set(F.struct("source_url", "evidence_text"))).alias("sources"), F.max("confidence_score").alias("confidence_score"),
        F.concat_ws(" to ", F.array_distinct(F.array_compact(F.array(F.min(F.nullif("publication_date", F.lit(""))), F.max(F.nullif("publication_date", F.lit(""))))))).alias("publication_date_range"),
        *more,
    )


def profile_sizes(records: DataFrame, cluster_of: DataFrame) -> DataFrame:
    """Of each cluster's profile its names and type, and how many sources and facts it has, without the lists of these: what a cluster with most of a corpus's
    records has of them doesn't fit in a task. Sources and facts are told apart by sha256, each in a row of its own."""
    rows = records.join(cluster_of.withColumnRenamed("name", "entity_name"), "entity_name").withColumnRenamed("cluster", "canonical_name")
    # With its length in front, so that texts side by side, empty ones and nulls stay apart.
    part = lambda c: F.concat_ws(":", F.char_length(c).cast("string"), c)
    told = lambda kind, *texts: F.struct(F.lit(kind).alias("kind"), F.unhex(F.sha2(F.concat_ws("|", *map(part, texts)), 256)).alias("what"))
    facts = F.transform(F.coalesce("key_facts", F.array().cast("array<string>")), lambda f: told(1, f))
    each = F.explode(F.concat(F.array(told(0, F.col("source_url"), F.col("evidence_text"))), facts)).alias("t")
    sizes = rows.select("canonical_name", each).select("canonical_name", "t.*").distinct().groupBy("canonical_name").agg(
        F.count_if(F.col("kind") == 0).alias("n_sources"), F.count_if(F.col("kind") == 1).alias("n_facts")
    )
    heads = rows.groupBy("canonical_name").agg(F.array_sort(F.collect_set("entity_name")).alias("aliases"), F.min_by("entity_type", "_ord").alias("entity_type"))
    return heads.join(sizes, "canonical_name")
