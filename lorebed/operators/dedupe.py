"""First-seen-wins deduplication that labels rows and never deletes them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import casefold, fold_spaces, strip
from ..sources.scratch import stored


def first_rank(keys: list[str], order: str) -> Column:
    return F.row_number().over(Window.partitionBy(*keys).orderBy(order))


def _with_first(rows: DataFrame, keys: list[str], order: str, how: str) -> DataFrame:
    """The rows beside ``__first``, which is set for the first of each key. ``order`` is different in all rows of a key.

    The rows are stored, so that keys are made once and their source is read once. The first orders come from a hash aggregate, which shrinks a hot
    key before the shuffle; the rows meet them by key and order, which no two rows share.
    """
    rows = stored(rows)
    firsts = rows.groupBy(*keys).agg(F.min(order).alias(order)).withColumn("__first", F.lit(True))
    return rows.join(firsts, [*keys, order], how)


def label_duplicates(rows: DataFrame, key: str, order: str, status: str = "status") -> DataFrame:
    """The first row of a key wins: a winner that says ``duplicate`` becomes ``new``, a loser becomes ``duplicate``.

    Rows with an empty key stay as they are.
    """
    columns = rows.columns
    # Every row without a key is the first of its own.
    rows = rows.withColumn(
        "__key",
        F.when(F.coalesce(F.col(key), F.lit("")) == "", F.concat(F.lit("-"), F.col(order).cast("string"))).otherwise(F.concat(F.lit("+"), F.col(key)))
    )
    found = _with_first(rows, ["__key"], order, "left")
    label = F.when(F.startswith("__key", F.lit("-")), F.col(status)).when(F.col("__first").isNull(), "duplicate").when(F.col(status) == "duplicate", "new").otherwise(F.col(status))
    return found.withColumn(status, label).select(*columns)


def first_of(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """One whole row for each key, the first; ``order`` is different in all rows of a key."""
    known = rows.withColumns({f"__k{k}": F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for k, c in enumerate(keys)})
    return _with_first(known, [f"__k{k}" for k in range(len(keys))], order, "left_semi").select(*rows.columns)


def with_fact_key(records: DataFrame) -> DataFrame:
    """Source as it is, name without case, evidence without case and white space."""
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    return records.withColumns(
        {"k_url": strip(text("source_url")), "k_name": casefold(strip(text("entity_name"))), "k_evidence": fold_spaces(F.col("evidence_text"))}
    )


def dedupe_facts(records: DataFrame, order: str) -> tuple[DataFrame, DataFrame]:
    """(kept, dropped): of records with one fact key the first is kept; others fail with ``duplicate_record`` as a further reason."""
    keys = ["k_url", "k_name", "k_evidence"]
    ranked = _with_first(with_fact_key(records), keys, order, "left").select(*records.columns, "__first")
    kept = ranked.where("__first").drop("__first")
    reasons = F.array_append(F.coalesce(F.col("rejection_reasons"), F.array().cast("array<string>")), F.lit("duplicate_record"))
    return kept, ranked.where("__first IS NULL").drop("__first").withColumns({"validation_status": F.lit("failed"), "rejection_reasons": reasons})
