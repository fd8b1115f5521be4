"""Languages by ranked n-gram profiles: a text's commonest trigrams in order, held against those of each language by how far out of place they are."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import stored

#: As many languages as a broadcast table of a few MB holds the profiles of.
MOST_LANGUAGES = 500
#: Letters in a row; longer rows are cut, so that a text without a space costs no more than another.
_LETTERS = r"(\p{L}{1,40})"


def _words(text: str) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(F.col(text), F.lit(""))), F.lit(_LETTERS), F.lit(1))


def _ranked(rows: DataFrame, key: str, text: str, size: int) -> DataFrame:
    """(key, gram, rank) of each key's ``size`` commonest trigrams, with a space on either side of a word; equally common ones by themselves.

    Words are counted first, so a key's grams are made once for each different word.
    """
    words = rows.select(key, F.explode(_words(text)).alias("word"))
    counted = words.groupBy(key, "word").agg(F.count("*").alias("n")).withColumn("word", F.concat(F.lit(" "), "word", F.lit(" ")))
    grams = F.transform(F.sequence(F.lit(1), F.length("word") - 2), lambda i: F.substr("word", i, F.lit(3)))
    each = counted.select(key, F.explode(grams).alias("gram"), "n").groupBy(key, "gram").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(Window.partitionBy(key).orderBy(F.desc("n"), "gram"))
    return each.withColumn("rank", rank).where(F.col("rank") <= size).select(key, "gram", "rank")


def _commonest(words: str, size: int) -> str:
    """The ``size`` commonest trigrams of words with one space between them, one a line; equally common ones in the order of their code points."""
    p = np.frombuffer(f" {words} ".encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
    # Three characters of 21 bits are in the same order as the number they make. A gram has a letter in its middle.
    grams, n = np.unique(((p[:-2] << 42) | (p[1:-1] << 21) | p[2:])[p[1:-1] != 32], return_counts=True)
    first = grams[np.argsort(-n, kind="stable")[:size]]
    lines = np.stack([first >> 42, first >> 21 & 0x1FFFFF, first & 0x1FFFFF, np.full(len(first), 10)], axis=1).astype("<u4")
    return lines.tobytes().decode("utf-32-le")[:-1]


def _ranked_alone(docs: DataFrame, key: str, text: str, size: int) -> DataFrame:
    """``_ranked`` of rows with different keys: each text's grams are counted where it lies, so neither words nor grams are shuffled."""
    commonest = F.pandas_udf(lambda words: pd.Series([_commonest(w, size) for w in words], dtype=object), "string")
    lines = docs.select(key, F.array_join(_words(text), " ").alias("words")).select(key, commonest("words").alias("lines"))
    return lines.select(key, F.posexplode(F.split("lines", "\n")).alias("place", "gram")).select(key, "gram", (F.col("place") + 1).alias("rank"))


def profiles(labelled: DataFrame, text: str = "text", language: str = "lang", size: int = 300) -> DataFrame:
    """(language, gram, rank), stored: the ``size`` commonest trigrams of each language's texts. Rows without text or language don't count."""
    rows = labelled.where(F.col(language).isNotNull()).select(F.col(language).alias("language"), F.col(text).alias("text"))
    return stored(_ranked(rows, "language", "text", size))


def detect(docs: DataFrame, known: DataFrame, key: str = "doc_id", text: str = "text", size: int = 300) -> DataFrame:
    """(key, language) of every text; ``unknown`` if it has no letter, or no gram of any language's profile. Keys are different in all rows.

    A gram of the text that a language has too is as far out of place as their ranks differ; one that it hasn't, as ``size``. The language with the smallest sum
    is taken, of equal ones the first by name.
    """
    own = _ranked_alone(docs, key, text, size).withColumnRenamed("rank", "own")
    few = known.select("language").distinct().limit(MOST_LANGUAGES + 1).count() <= MOST_LANGUAGES
    met = own.join(F.broadcast(known) if few else known, "gram")
    # What no gram of a language meets adds the same to all of them.
    sums = met.groupBy(key, "language").agg(F.sum(F.abs(F.col("own") - F.col("rank")) - size).alias("distance"))
    best = sums.groupBy(key).agg(F.min(F.struct("distance", "language"))["language"].alias("language"))
    return docs.select(key).join(best, key, "left").withColumn("language", F.coalesce("language", F.lit("unknown")))
