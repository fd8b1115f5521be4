"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .job import set_apart, ship, stored
from .textblocks import text_blocks

UNDETERMINED = "und"
#: Languages whose matrix is broadcast at once, of half a megabyte each.
LANGUAGES_AT_ONCE = 64
_TABLED = 0x33480


@cache
def _letters() -> np.ndarray:
    """For each code point: itself in lower case if it is a letter, else a space."""
    table = np.full(_TABLED, 32, dtype=np.uint32)
    for i in range(_TABLED):
        c = chr(i)
        if c.isalpha():
            low = c.lower()
            table[i] = ord(low) if len(low) == 1 else i
    return table


def char_grams(data: np.ndarray, offsets: np.ndarray, n: int, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed n-grams of letters, where each run of other characters is one space.

    Returns the buckets, the first gram of each text with their number at the end, and whether each text has a letter.
    """
    try:
        points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), dtype=np.uint32)
        at = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]
    except UnicodeDecodeError:
        texts = [data[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(offsets[:-1], offsets[1:])]
        points = np.frombuffer("".join(texts).encode("utf-32-le"), dtype=np.uint32)
        at = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    letters = np.where(points < _TABLED, _letters()[np.minimum(points, _TABLED - 1)], np.uint32(32))
    blank = letters == 32
    keep = np.ones(len(letters), dtype=bool)
    keep[1:] = ~(blank[1:] & blank[:-1])
    keep[at[:-1][at[:-1] < len(letters)]] = True
    with_letter = np.diff(np.concatenate([[0], np.cumsum(~blank)])[at]) > 0
    at = np.concatenate([[0], np.cumsum(keep)])[at]
    letters = letters[keep]
    mixed = np.zeros(max(0, len(letters) - n + 1), dtype=np.uint32)
    for k in range(n):
        mixed = (mixed + letters[k : k + len(mixed)]) * np.uint32(0x9E3779B1)
        mixed ^= mixed >> np.uint32(15)
    buckets = (mixed >> np.uint32(32 - bits)).astype(np.int32)
    count = np.maximum(np.diff(at) - n + 1, 0)
    first = np.concatenate([[0], np.cumsum(count)])
    return buckets[np.arange(first[-1]) - np.repeat(first[:-1] - at[:-1], count)], first, with_letter


class LanguageBlock:
    """log P(gram | language) and log P(language) of some languages, in order."""

    def __init__(self, languages: list[str], log_grams: np.ndarray, log_prior: np.ndarray, n: int, bits: int, evidence: int):
        self.languages, self.log_grams, self.log_prior = languages, log_grams, log_prior
        self.n, self.bits, self.evidence = n, bits, evidence

    def score(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
        """For each text the place of its likeliest language, that one's log probability, the same tempered, all these languages' tempered mass in
        units of it, and whether the text has a letter.

        The language is chosen by all grams. For the score alone the likelihood of a long text is tempered to that of ``evidence`` grams
        with the same mean, so that it tells how clear the text is and not how long. Ties go to the first language.
        """
        buckets, first, with_letter = char_grams(data, offsets, self.n, self.bits)
        count = np.diff(first)
        total = np.zeros((len(count), len(self.languages)))
        some = np.flatnonzero(count)
        for k in range(len(self.languages)):
            if len(some):
                total[some, k] = np.add.reduceat(self.log_grams[k][buckets], first[:-1][some])
        cooled = total * np.minimum(1.0, self.evidence / np.maximum(count, 1))[:, None] + self.log_prior
        total += self.log_prior
        best = total.argmax(axis=1)
        row = np.arange(len(best))
        cool = cooled[row, best]
        return best, total[row, best], cool, np.exp(cooled - cool[:, None]).sum(axis=1), with_letter


class LanguageModel:
    """Every language's gram counts, as a stored table with one row for each language; the driver knows the names and the numbers of documents."""

    def __init__(self, table: DataFrame, languages: list[str], docs: np.ndarray, n: int, bits: int, alpha: float, evidence: int):
        self.table, self.languages, self.log_prior = table, languages, np.log(docs / docs.sum())
        self.n, self.bits, self.alpha, self.evidence = n, bits, alpha, evidence

    def blocks(self, size: int) -> Iterator[LanguageBlock]:
        """The matrices of ``size`` languages after the other, so that what is broadcast at once is bounded however many there are."""
        for at in range(0, len(self.languages), size):
            names = self.languages[at : at + size]
            found = {r["lang"]: np.frombuffer(r["grams"], dtype=np.int64) for r in self.table.where(F.col("lang").isin(names)).collect()}
            counts = np.stack([found[name] for name in names]) + self.alpha
            yield LanguageBlock(names, np.log(counts / counts.sum(axis=1, keepdims=True)), self.log_prior[at : at + size], self.n, self.bits, self.evidence)


def fit(
    labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", n: int = 3, bits: int = 16, alpha: float = 0.1, evidence: int = 100
) -> LanguageModel | None:
    """Counts the grams of every labelled text, in the tasks and then by (language, bucket); any number of languages.

    Rows without text or language don't count. None if no row is left.
    """
    spark = labelled.sparkSession
    ship(spark)
    rows = labelled.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")).where("text IS NOT NULL AND lang IS NOT NULL")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables: dict[str, np.ndarray] = {}
        docs: dict[str, int] = {}

        def told() -> Iterator[pa.RecordBatch]:
            for name, table in tables.items():
                found = np.flatnonzero(table)
                columns = [
                    pa.array([name] * (len(found) + 1)), pa.array(np.append(found, -1).astype(np.int32)),
                    pa.array(np.append(table[found], docs[name]).astype(np.int64))
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["lang", "bucket", "n"])
            tables.clear()
            docs.clear()

        for batch in batches:
            lang = np.array(batch.column(1).to_pylist(), dtype=object)
            for first, last, data, offsets in text_blocks(batch.column(0), 1 << 20):
                buckets, at, _ = char_grams(data, offsets, n, bits)
                own = lang[first:last]
                for name in set(own):
                    docs[name] = docs.get(name, 0) + int((own == name).sum())
                    chosen = buckets[np.repeat(own == name, np.diff(at))]
                    tables[name] = tables.get(name, 0) + np.bincount(chosen, minlength=1 << bits)
                    if len(tables) >= LANGUAGES_AT_ONCE:
                        yield from told()
        yield from told()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One row for a language: at most a number for each bucket comes in."""
        table, docs, name = np.zeros(1 << bits, dtype=np.int64), 0, None
        for batch in batches:
            name = batch.column(0)[0].as_py()
            bucket, number = np.asarray(batch.column(1)), np.asarray(batch.column(2))
            table[bucket[bucket >= 0]] = number[bucket >= 0]
            docs += int(number[bucket < 0].sum())
        yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([docs]), pa.array([table.tobytes()], pa.binary())], names=["lang", "docs", "grams"])

    counts = rows.mapInArrow(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    table = stored(counts.groupBy("lang").applyInArrow(pack, "lang string, docs long, grams binary"))
    docs = {r["lang"]: r["docs"] for r in table.select("lang", "docs").collect()}
    languages = sorted(docs)
    if not languages:
        return None
    return LanguageModel(table, languages, np.array([docs[name] for name in languages], dtype=float), n, bits, alpha, evidence)


def predict(docs: DataFrame, model: LanguageModel | None, text_col: str = "text", at_once: int = LANGUAGES_AT_ONCE) -> DataFrame:
    """The rows with lang_pred and score; input columns of those names are replaced, others keep theirs.

    A null text, one without a letter, or a missing model gives ``und`` and 0. Each pass over the texts compares ``at_once`` languages.
    """
    spark: SparkSession = docs.sparkSession
    docs = docs.drop("lang_pred", "score")
    if model is None:
        return docs.withColumns({"lang_pred": F.lit(UNDETERMINED), "score": F.lit(0.0)})
    ship(spark)
    apart = set_apart(docs, {text_col})
    numbers = ("__top", "__cool", "__mass")
    rows = apart.withColumns({"__lang": F.lit(UNDETERMINED), **{c: F.lit(None).cast("double") for c in numbers}})
    at = rows.columns.index(text_col)
    schema = T.StructType([*apart.schema.fields, T.StructField("__lang", T.StringType()), *(T.StructField(c, T.DoubleType()) for c in numbers)])
    for k, block in enumerate(model.blocks(at_once)):
        shared = spark.sparkContext.broadcast(block)
        rows = (stored(rows) if k else rows).mapInArrow(lambda batches, shared=shared: _compared(batches, shared.value, at), schema)
    score = F.when(F.col("__top").isNull(), 0.0).otherwise(1 / F.col("__mass"))
    return rows.select(*apart.columns, "__lang", score).toDF(*docs.columns, "lang_pred", "score")


def _compared(batches: Iterator[pa.RecordBatch], block: LanguageBlock, at: int) -> Iterator[pa.RecordBatch]:
    """The rows with the likeliest language so far, its log probability, the same tempered, and the tempered mass of all so far in units of it."""
    names = np.array(block.languages, dtype=object)
    for batch in batches:
        found = [block.score(data, offsets) for _, _, data, offsets in text_blocks(batch.column(at), 1 << 20)]
        best, top, cool, mass, letter = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, int), *(np.zeros(0),) * 3, np.zeros(0, bool))
        lang = np.array(batch.column(batch.num_columns - 4).to_pylist(), dtype=object)
        old_top, old_cool, old_mass = (batch.column(batch.num_columns - k).to_numpy(zero_copy_only=False).astype(float) for k in (3, 2, 1))
        first = np.isnan(old_top)
        better = first | (top > old_top)
        # The choice by all grams and the tempered one differ by the prior at most, so nothing overflows.
        now = np.where(better, cool, old_cool)
        new = [
            pa.array(np.where(letter, np.where(better, names[best], lang), UNDETERMINED), pa.string()),
            pa.array(np.where(better, top, old_top), mask=~letter),
            pa.array(now, mask=~letter),
            pa.array(mass * np.exp(cool - now) + np.where(first, 0.0, old_mass * np.exp(np.where(first, 0.0, old_cool - now))), mask=~letter),
        ]
        yield pa.RecordBatch.from_arrays([*batch.columns[:-4], *new], names=batch.schema.names)


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", folds: int = 5) -> DataFrame:
    """id, held_out, lang_pred and score of every row, learnt from the rows that aren't held out.

    A row is held out if the crc32 of its id as text is a multiple of ``folds``; a row with a null id isn't,
    and isn't learnt from either. Equal texts get equal predictions.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds
    model = fit(rows.where(fold != 0))
    kept = rows.select("doc_id", F.coalesce(fold == 0, F.lit(False)).alias("held_out"), "text")
    return predict(kept, model).drop("text")
