"""CSV, JSON lines, Markdown and blob tables, with the semantics of row files: all text, order kept, empty not null."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import slug


def exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)


#: As many blocks of files as a broadcast table of a few MB describes; beyond it, Spark joins them as it sees fit.
MOST_BLOCKS = 50_000
#: Spark's own name of a part: its number, and the id of the write that it belongs to.
_PART = re.compile(r"part-(\d+)-(.+?)(?:[-.]c\d+)?(?:\..*)?")


def with_order(rows: DataFrame, name: str = "_ord") -> DataFrame:
    """Numbers the rows of files from 0: files in order, rows by their place in them. ``rows`` is as ``spark.read`` returns it, before any filter.

    Parts of one write are in order of their numbers, and writes in order of their time, so that appended rows come last; other files come first, by path.
    Two passes: one counts the rows of each block of a file, the other adds what comes before its block to each row's place in it. Tables that
    aren't from files are numbered by partition and place.
    """
    try:
        located = rows.select("*", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_block_start").alias("__block"), F.col("_metadata.file_modification_time").alias("__time"))
    except AnalysisException:
        return rows.withColumn(name, F.monotonically_increasing_id())
    # Within a partition ids go up one by one, and a block's rows are together in one.
    located = located.withColumn("__id", F.monotonically_increasing_id())
    blocks = located.groupBy("__file", "__block").agg(F.max("__time").alias("time"), F.min("__id").alias("first"), F.count("*").alias("rows")).collect()
    offsets, total = [], 0
    for b in _in_order(blocks):
        offsets.append((b["__file"], b["__block"], total - b["first"]))
        total += b["rows"]
    table = rows.sparkSession.createDataFrame(offsets, "__file string, __block long, __offset long")
    numbered = located.join(F.broadcast(table) if len(offsets) <= MOST_BLOCKS else table, ["__file", "__block"])
    return numbered.select(*rows.columns, (F.col("__id") + F.col("__offset")).alias(name))


def _in_order(blocks: list) -> list:
    """Blocks (__file, __block, time) in the order of their rows; the driver's own list of files is as long."""
    part = {b["__file"]: _PART.fullmatch(b["__file"].rsplit("/", 1)[-1]) for b in blocks}
    written: dict[str, object] = {}
    for b in blocks:
        if found := part[b["__file"]]:
            written[found[2]] = min(written.get(found[2], b["time"]), b["time"])

    def key(b):
        found = part[b["__file"]]
        folder = b["__file"].rsplit("/", 1)[0]
        place = (1, written[found[2]], found[2], folder, int(found[1])) if found else (0,)
        return (*place, b["__file"], b["__block"]) if found else (0, b["__file"], b["__block"])

    return sorted([b for b in blocks if not part[b["__file"]]], key=key) + sorted([b for b in blocks if part[b["__file"]]], key=key)


def text_schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def read_csv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """All columns as text, empty cells as the empty text; a missing file is an empty table."""
    schema = text_schema(columns)
    if not exists(spark, path):
        return with_order(spark.createDataFrame([], schema))
    rows = with_order(spark.read.csv(path, header=True, multiLine=True, escape='"', inferSchema=False, enforceSchema=False), "__ord")
    found = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c) if c in rows.columns else F.lit("").alias(c) for c in columns]
    return rows.select(*found, F.col("__ord").alias("_ord"))


def projected(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Exactly these columns: unknown ones go, missing ones are empty."""
    return rows.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) if c in rows.columns else F.lit("").alias(c) for c in columns])


def ordered(rows: DataFrame, order: str = "_ord") -> DataFrame:
    """By the order column, if there is one, in ranges: parts of a table are then read back in this order."""
    return rows.orderBy(order) if order in rows.columns else rows


def write_csv(rows: DataFrame, path: str, columns: list[str], mode: str = "overwrite", order: str | None = "_ord") -> None:
    """A folder of CSV parts with a header each, in order if the rows have one; the committer makes the write all or nothing."""
    projected(ordered(rows, order) if order else rows, columns).write.mode(mode).csv(path, header=True, escape='"', emptyValue="")


def _swap_in(rows: DataFrame, path: str, write) -> None:
    """Writes one part beside the target and renames it over the target, so that a reader sees the old file or the new one whole."""
    spark = rows.sparkSession
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    target = hadoop.Path(path)
    beside = hadoop.Path(target.getParent(), f".{target.getName()}-{uuid.uuid4().hex}")
    system = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    try:
        write(rows.coalesce(1), beside.toString())
        (part,) = [s.getPath() for s in system.globStatus(hadoop.Path(beside, "part-*"))]
        _rename_over(spark, system, part, target)
    finally:
        system.delete(beside, True)


def _rename_over(spark: SparkSession, system, part, target) -> None:
    """One rename that replaces the target; where the store can't do that in one step, it is an error and the old file stays."""
    jvm = spark.sparkContext._jvm
    if system.getUri().getScheme() == "file":
        files, paths, option = jvm.java.nio.file.Files, jvm.java.nio.file.Paths, jvm.java.nio.file.StandardCopyOption
        local = lambda p: paths.get(p.toUri().getPath(), spark.sparkContext._gateway.new_array(jvm.java.lang.String, 0))
        # The checksum beside a local file is of its old bytes.
        system.getRawFileSystem().delete(system.getChecksumFile(target), False)
        options = spark.sparkContext._gateway.new_array(jvm.java.nio.file.CopyOption, 2)
        options[0], options[1] = option.ATOMIC_MOVE, option.REPLACE_EXISTING
        files.move(local(part), local(target), options)
        return
    overwrite = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 1)
    overwrite[0] = getattr(jvm.org.apache.hadoop.fs, "Options$Rename").OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark.sparkContext._jsc.hadoopConfiguration()).rename(part, target, overwrite)


def write_csv_file(rows: DataFrame, path: str, columns: list[str], order: str | None = None) -> None:
    """One CSV file with a header and CRLF line ends, put in place at once: for tables that people open. All rows pass one task, so big tables go to ``write_csv``."""
    rows = rows.orderBy(order) if order else rows
    one = projected(rows, columns)
    empty = one.isEmpty()

    def write(part: DataFrame, folder: str) -> None:
        # Spark's own writer ends lines with one character; a text table takes any separator.
        cell = lambda c: F.when(
            F.col(c).rlike('[",\\r\\n]'), F.concat(F.lit('"'), F.replace(F.col(c), F.lit('"'), F.lit('""')), F.lit('"'))
        ).otherwise(F.col(c))
        header = part.sparkSession.createDataFrame([(",".join(columns),)], "value string").coalesce(1)
        lines = header if empty else header.unionByName(part.select(F.concat_ws(",", *[cell(c) for c in columns]).alias("value")))
        lines.coalesce(1).write.option("lineSep", "\r\n").text(folder)

    _swap_in(one, path, write)


def write_jsonl_file(rows: DataFrame, path: str, order: str | None = None) -> None:
    """One JSON lines file, put in place at once; nulls are kept, and text as it is."""
    _swap_in(rows.orderBy(order) if order else rows, path, lambda part, folder: part.write.option("ignoreNullFields", "false").json(folder))


def read_csv_typed(spark: SparkSession, path: str) -> DataFrame:
    """With inferred types and null for empty cells, for looking at results; pipelines read text."""
    return spark.read.csv(path, header=True, multiLine=True, escape='"', inferSchema=True)


def read_jsonl_typed(spark: SparkSession, path: str) -> DataFrame:
    """With the schema that the rows show."""
    return spark.read.option("mode", "FAILFAST").json(path)


def head(rows: DataFrame, n: int = 5, order: str = "_ord") -> DataFrame:
    """The first rows by order."""
    return rows.orderBy(order).limit(n)


def append_csv(rows: DataFrame, path: str, columns: list[str]) -> None:
    """No rows, no files."""
    if not rows.isEmpty():
        write_csv(rows, path, columns, "append")


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Blank lines are skipped, a malformed one is an error; a missing file is an empty table. ``with_order`` numbers the rows."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def observed(rows: DataFrame, write: Callable[[DataFrame], None], /, **counts: Column) -> dict[str, int]:
    """What ``counts`` (aggregates) come to over the rows that ``write`` writes, counted while they are written.

    Rows that the write would sort are sorted before, as sampling for the sort would count them twice.
    """
    seen = Observation()
    write(ordered(rows).observe(seen, *[c.alias(k) for k, c in counts.items()]))
    return seen.get


def write_jsonl(rows: DataFrame, path: str, mode: str = "overwrite", order: str | None = "_ord") -> None:
    """A folder of JSON lines, in order if the rows have one."""
    (ordered(rows, order) if order else rows).write.mode(mode).option("ignoreNullFields", "false").json(path)


def read_page_inputs(spark: SparkSession, pattern: str) -> DataFrame:
    """page_id (the file's stem), source_url, page_markdown and path of JSON files with one page each."""
    rows = spark.read.schema("source_url string, page_markdown string").option("multiLine", True).json(pattern)
    return rows.select(
        F.regexp_extract(F.col("_metadata.file_name"), r"^(.*?)(?:\.json)?$", 1).alias("page_id"), "source_url", "page_markdown",
        F.col("_metadata.file_path").alias("path")
    )


def markdown_by_url(pages: DataFrame) -> DataFrame:
    """One text for each url: that of the last path, whatever order files come in."""
    return pages.groupBy("source_url").agg(F.max_by("page_markdown", "path").alias("page_markdown"))


_FRONT = ["title", "entity_type", "supply_chain_category", "page_id", "publication_date", "source_url", "generated_from"]


def read_markdown(spark: SparkSession, path: str) -> DataFrame:
    return parse_markdown(spark.read.text(path, wholetext=True).select("value", F.col("_metadata.file_name").alias("file_name")))


def parse_markdown(rows: DataFrame, text: str = "value") -> DataFrame:
    """The front matter's seven fields and the facts and links of a page, by section: source titles may go over lines."""
    front = F.regexp_extract(F.col(text), r"(?s)\A---\r?\n(.*?)\r?\n---", 1)
    field = lambda k: F.regexp_replace(F.trim(F.regexp_extract(front, rf"(?m)^{k}:[ \t]*(.*?)[ \t]*$", 1)), '^"|"$', "")
    section = lambda k: F.regexp_extract(F.col(text), rf"(?s)(?:\A|\n)## {k}[ \t]*\r?\n(.*?)(?=\n## |\z)", 1)
    bullets = lambda c: F.transform(F.filter(F.split(c, r"\r?\n"), lambda x: F.startswith(x, F.lit("- "))), lambda x: F.substr(x, F.lit(3)))
    return rows.select(
        *[c for c in rows.columns if c != text], *[field(k).alias(k) for k in _FRONT], bullets(section("Facts")).alias("facts"),
        bullets(section("Links")).alias("links")
    )


def render_markdown(rows: DataFrame) -> DataFrame:
    """file_name and value of each page, from the fields that parse_markdown returns."""
    front = F.concat_ws(
        "\n", F.lit("---"),
        *[F.concat(F.lit(f"{k}: "), F.concat(F.lit('"'), F.col(k), F.lit('"')) if k == "title" else F.col(k)) for k in _FRONT], F.lit("---")
    )
    lines = lambda c: F.array_join(F.transform(c, lambda x: F.concat(F.lit("- "), x)), "\n")
    when = F.when(F.col("publication_date") == "", "?").otherwise(F.col("publication_date"))
    body = [
        F.concat(F.lit("# "), F.col("title")),
        F.concat(F.lit("**Type:** "), F.col("entity_type"), F.lit(" · **Role:** "), F.col("supply_chain_category"), F.lit(" · **Published:** "), when),
        F.concat(F.lit("**Source:** ["), F.col("title"), F.lit("]("), F.col("source_url"), F.lit(") · `"), F.col("page_id"), F.lit("`")),
        F.concat(F.lit("## Facts\n"), lines("facts")),
        F.when(F.size("links") > 0, F.concat(F.lit("## Links\n"), lines("links"))),
    ]
    return rows.select(
        F.concat("page_id", F.lit("__"), slug(F.col("title")), F.lit(".md")).alias("file_name"),
        F.concat(F.concat_ws("\n\n", front, *body), F.lit("\n")).alias("value")
    )


def saved_pages(rows: DataFrame) -> DataFrame:
    """Pages with the relative paths of their blobs, which are columns of a Parquet table here."""
    return rows.withColumns(
        {"markdown_path": F.concat(F.lit("markdown/"), "page_id", F.lit(".md")), "html_path": F.when(F.col("html").isNull(), "").otherwise(F.concat(F.lit("html/"), "page_id", F.lit(".html")))}
    )


def union_shards(shards: list[DataFrame]) -> DataFrame:
    """Outputs of several workers as one table; columns that some lack are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), shards)


def shard_of(key, n: int):
    """The worker, from 0, that a key belongs to: by the first 32 bits of the md5 of its text."""
    return (F.conv(F.substring(F.md5((F.col(key) if isinstance(key, str) else key).cast("string")), 1, 8), 16, 10).cast("long") % n).cast("int")


def halves(pages: DataFrame, listed: DataFrame, key: str = "page_id") -> tuple[DataFrame, DataFrame]:
    """Pages on a list and the others: two runs with outputs of their own."""
    ids = listed.select(key).distinct()
    return pages.join(ids, key, "left_semi"), pages.join(ids, key, "left_anti")
