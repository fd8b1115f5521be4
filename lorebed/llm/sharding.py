"""Shards that all have the corpus's mixture of sources, by interleaving the sources in proportion. Built-in functions alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .job import stored

#: What a row takes beside the bytes of its text.
ROW_BYTES = 16
#: Slices of a source's order, and of the whole order: each is ranked by itself, so that no source is in one task.
SLICE_DIGITS = 3
_SLICES = 16**SLICE_DIGITS


def text_crc32(text: Column) -> Column:
    """The CRC-32 of a text's bytes, from 0 to 2 ** 32 - 1; that of a null text is 0."""
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary"))


def _fraction(hexadecimal: Column) -> Column:
    """The first 32 bits of a hash as a number from 0 to below 1."""
    return F.conv(F.substring(hexadecimal, 1, 8), 16, 10).cast("double") / float(1 << 32)


def _before(counts: DataFrame, slice_: str, by: list[str]) -> DataFrame:
    """The rows of earlier slices (``before``) and of all (``total``) beside each slice's own, by group; a group has _SLICES of them at most."""
    group = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    earlier = group.orderBy(slice_).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumns({"before": F.coalesce(F.sum("rows").over(earlier), F.lit(0).cast("long")), "total": F.sum("rows").over(group)})


def interleave(rows: DataFrame, shards: int = 40, stratum: str = "source", id_col: str = "doc_id", then: str | None = None, seed: int = 1) -> DataFrame:
    """The rows with ``shard``, from 0, and ``slot``, their place in it, without a gap from 0; the numbers of rows of any two shards differ by one at most.

    The rows of each stratum are shuffled by a hash of seed and id and ranked; a rank r of n stands at (r - u) / n, where u from 0 to 1 is the
    stratum's own. All rows in order of these fractions are cut into shards of equal size. A stratum so has its share of every shard, to within a
    row or two, and strata too small for every shard fall on different ones.

    A null stratum is one of its own, and so is the empty one. Rows with one id are told apart by ``then`` (say, a digest of the text); if they are equal in
    that too, they may change places. Columns named ``shard`` and ``slot`` are replaced. No rows give no rows.

    A stratum's order and the whole order are cut into 4,096 slices by value; slices are counted, each is ranked by itself, and what comes before it is
    added. Every row crosses two exchanges, with all columns that it has; counts have one row for each slice of a stratum. The ranked rows are stored between.
    """
    kept = [c for c in rows.columns if c not in ("shard", "slot")]
    own = rows.select(*[F.col(f"`{c}`").alias(f"__own_{i}") for i, c in enumerate(kept)])
    at = {c: F.col(f"__own_{i}") for i, c in enumerate(kept)}
    name = F.coalesce(F.concat(F.lit("+"), at[stratum].cast("string")), F.lit("-"))
    shuffled = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(at[id_col].cast("string"), F.lit(""))))
    own = own.withColumns({"stratum": name, "order": shuffled, "then": at[then] if then else F.lit(0)}).withColumn("slice", F.substring("order", 1, SLICE_DIGITS))

    places = _before(own.groupBy("stratum", "slice").agg(F.count("*").alias("rows")), "slice", ["stratum"]).drop("rows")
    own = own.withColumn("rank", F.row_number().over(Window.partitionBy("stratum", "slice").orderBy("order", "then")).cast("long"))
    own = own.join(places.hint("merge"), ["stratum", "slice"])
    offset = _fraction(F.md5(F.concat(F.lit(f"{seed}:"), F.col("stratum"))))
    fraction = (F.col("before") + F.col("rank") - offset) / F.col("total")
    own = own.select(*[c for c in own.columns if c.startswith("__own_")], "stratum", fraction.alias("fraction"), "order", "then")
    ranked = stored(own.withColumn("part", F.floor(F.col("fraction") * _SLICES)))

    # As many rows as there are slices, whatever the input.
    parts = _before(ranked.groupBy("part").agg(F.count("*").alias("rows")), "part", []).drop("rows")
    in_part = Window.partitionBy("part").orderBy("fraction", "stratum", "order", "then")
    placed = ranked.withColumn("rank", F.row_number().over(in_part).cast("long")).join(F.broadcast(parts), "part")
    position, total = F.col("before") + F.col("rank") - 1, F.col("total")
    placed = placed.withColumn("position", position).withColumn("shard", F.expr(f"position * {shards} div total"))
    return placed.select(
        *[F.col(f"__own_{i}").alias(c) for i, c in enumerate(kept)], F.col("shard").cast("int").alias("shard"),
        (F.col("position") - F.expr(f"(shard * total + {shards - 1}) div {shards}")).alias("slot")
    )


def shard_documents(docs: DataFrame, shards: int = 40, stratum: str = "source", id_col: str = "doc_id", text_col: str = "text", seed: int = 1) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard of every document; texts don't move.

    The law is ``rows``: shards differ by one row at most, and not by bytes; equal texts may be in different shards, as one group of them may hold more
    rows than a shard does. A shard count more moves most rows, so ``grown_shard`` is null.
    """
    narrow = docs.select(
        F.col(id_col).alias("doc_id"), F.col(stratum).alias("stratum"), (F.coalesce(F.octet_length(text_col), F.lit(0)) + ROW_BYTES).cast("long").alias("size"),
        text_crc32(F.col(text_col)).alias("text_crc32"), F.md5(F.coalesce(F.col(text_col), F.lit(""))).alias("digest"),
    )
    found = interleave(narrow, shards, "stratum", "doc_id", "digest", seed)
    return found.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def write_shards(docs: DataFrame, path: str, shards: int = 40, stratum: str = "source", id_col: str = "doc_id", seed: int = 1, files: int = 1) -> None:
    """The documents as Parquet, in a folder for each shard, with their columns and ``slot``.

    A shard is cut into ``files`` files of consecutive slots, each in order, so that a shard of any size isn't one task's work.
    """
    docs = docs.drop("shard", "slot")
    placed = interleave(docs.withColumn("__order", F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])), shards, stratum, id_col, "__order", seed).drop("__order")
    ranges = placed.repartitionByRange(shards * files, "shard", "slot")
    ranges.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def duckdb_sql(shards: int = 40, seed: int = 1) -> str:
    """The query in DuckDB, with one window over each source and one over all; CRC-32 byte by byte with a table that is built from its polynomial."""
    table = "list_transform(range(256), lambda x: list_reduce(list_prepend(x, range(8)), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END))"
    return f"""
WITH t AS (SELECT {table} AS crc),
d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS bytes, coalesce('+' || source, '-') AS stratum, md5('{seed}:' || coalesce(doc_id::VARCHAR, '')) AS o, md5(coalesce(text, '')) AS digest
  FROM documents
),
r AS (
  SELECT *, (row_number() OVER (PARTITION BY stratum ORDER BY o, digest)
    - ('0x' || substr(md5('{seed}:' || stratum), 1, 8))::BIGINT::DOUBLE / 4294967296.0::DOUBLE) / count(*) OVER (PARTITION BY stratum) AS fraction
  FROM d
),
p AS (SELECT *, row_number() OVER (ORDER BY fraction, stratum, o, digest) - 1 AS pos, count(*) OVER () AS total FROM r),
s AS (SELECT *, (pos * {shards}) // total AS shard FROM p)
SELECT doc_id, (len(bytes) // 2 + {ROW_BYTES})::BIGINT AS size,
  xor(list_reduce(list_prepend(4294967295, list_transform(regexp_extract_all(bytes, '..'), lambda b: ('0x' || b)::BIGINT)),
    lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1])), 4294967295)::BIGINT AS text_crc32,
  'rows' AS law, shard::INT AS shard, (pos - (shard * total + {shards - 1}) // {shards})::BIGINT AS slot, NULL::INT AS grown_shard
FROM s, t
"""
