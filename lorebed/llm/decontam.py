"""Benchmark decontamination: suffix arrays of the training texts, searched for every benchmark suffix.

Each task builds the suffix array of its texts, one shard of about ``textblocks.BLOCK_BYTES`` at a time, and finds each
window of the benchmark in it by binary search. Windows that match one after the other make a longer match, so the longest
verbatim match of each text and its place come out too. A word that no benchmark item has ends every match;
suffixes that meet one before the shortest window is full are left out of the array, as they can't match.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .job import set_apart, ship, stored
from .textblocks import LETTERED, LOWER, U64, hash_spans, same_spans, text_blocks, word_spans

#: Bytes of benchmark text that are searched for, and so broadcast, in one pass.
PASS_BYTES = 32 << 20


class SuffixArray:
    """The suffixes of a shard in order of their first ``depth`` words, as packed word numbers."""

    def __init__(self, words: np.ndarray, room: np.ndarray, least: int, depth: int, bits: int):
        self.starts = np.flatnonzero(room >= least)
        self.columns = pack(words, self.starts, room[self.starts], depth, bits)
        order = np.lexsort(self.columns[::-1])
        self.starts = self.starts[order]
        self.columns = [c[order] for c in self.columns]

    def find(self, low: list[np.ndarray], high: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Where the suffixes between each low and high prefix begin and end in the array."""
        return self._bound(low, False), self._bound(high, True)

    def _bound(self, key: list[np.ndarray], after: bool) -> np.ndarray:
        a = np.zeros(len(key[0]), dtype=np.int64)
        b = np.full(len(key[0]), len(self.starts), dtype=np.int64)
        while True:
            live = np.flatnonzero(a < b)
            if not len(live):
                return a
            mid = (a[live] + b[live]) >> 1
            less = np.zeros(len(live), dtype=bool)
            same = np.ones(len(live), dtype=bool)
            for column, k in zip(self.columns, key):
                x, y = column[mid], k[live]
                less |= same & (x < y)
                same &= x == y
            if after:
                less |= same
            a[live[less]] = mid[less] + 1
            b[live[~less]] = mid[~less]


def pack(words: np.ndarray, starts: np.ndarray, room: np.ndarray, depth: int, bits: int, fill: int = 0) -> list[np.ndarray]:
    """The next ``depth`` words from each start in as few 64-bit columns as possible; ``fill`` where there is no room."""
    each = 64 // bits
    columns = []
    for first in range(0, depth, each):
        column = np.zeros(len(starts), dtype=U64)
        for k in range(first, min(depth, first + each)):
            inside = k < room
            word = np.full(len(starts), fill, dtype=U64)
            word[inside] = words[starts[inside] + k]
            column = (column << U64(bits)) | word
        columns.append(column)
    return columns


class Windows:
    """The distinct windows of some benchmark items, and which items have them where."""

    def __init__(self, ids: list[str], texts: list[str | None], window: int):
        self.ids, self.window = ids, window
        blocks = []
        for _, _, data, offsets in text_blocks(pa.array(texts, pa.large_string())):
            data = LOWER[data]
            blocks.append((data, *word_spans(data, offsets, LETTERED)))
        length = np.concatenate([np.diff(at) for *_, at in blocks]) if blocks else np.zeros(0, np.int64)
        shift = np.cumsum([0, *(len(data) for data, *_ in blocks)])
        data = np.concatenate([x[0] for x in blocks]) if blocks else np.zeros(0, np.uint8)
        begin, end = (np.concatenate([x[k] + d for x, d in zip(blocks, shift)]) if blocks else np.zeros(0, np.int64) for k in (1, 2))
        self.key = 0
        while True:
            self.vocabulary, first, number = np.unique(hash_spans(data, begin, end, self.key), return_index=True, return_inverse=True)
            if same_spans(data, begin, end, data, begin[first][number], end[first][number]).all():
                break
            self.key += 1  # Under this key every word of the benchmark has a hash of its own.
        size = end[first] - begin[first]
        self.word_at = np.concatenate([[0], np.cumsum(size)])
        self.word_bytes = data[np.arange(size.sum()) - np.repeat(self.word_at[:-1] - begin[first], size)]
        number = number.astype(np.int64) + 1
        self.bits = max(1, int(len(self.vocabulary) + 1).bit_length())
        size = np.minimum(length, window)
        count = np.where(length > 0, length - size + 1, 0)
        item = np.repeat(np.arange(len(length)), count)
        first = np.cumsum(count) - count
        place = np.arange(count.sum()) - first[item]
        start = place + (np.cumsum(length) - length)[item]
        own = size[item]
        key = np.stack([own.astype(U64), *pack(number, start, own, window, self.bits)], axis=1)
        unique, which = np.unique(key, axis=0, return_inverse=True) if len(key) else (key, np.zeros(0, np.int64))
        which = which.reshape(-1)
        self.sizes = unique[:, 0].astype(np.int64) if len(key) else np.zeros(0, np.int64)
        self.low = [np.ascontiguousarray(unique[:, 1 + k]) for k in range(key.shape[1] - 1)]
        order = np.argsort(which, kind="stable")
        a = np.zeros(len(unique), dtype=np.int64)
        a[which] = start
        self.high = pack(number, a, self.sizes, window, self.bits, (1 << self.bits) - 1)
        self.item_at = np.searchsorted(which[order], np.arange(len(unique) + 1))
        self.items, self.places = item[order], place[order]
        self.least = int(self.sizes.min()) if len(key) else 0

    def match(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(first word of each text, its number at the end; for each occurrence its text, its word in the text and its window).

        Words are looked up by their hashes; those of an occurrence are then compared byte by byte, so that an occurrence is verbatim.
        """
        data = LOWER[data]
        begin, end, at = word_spans(data, offsets, LETTERED)
        none = np.zeros(0, np.int64)
        if not len(self.sizes):
            return at, none, none, none
        h = hash_spans(data, begin, end, self.key)
        number = np.minimum(np.searchsorted(self.vocabulary, h), len(self.vocabulary) - 1)
        number = np.where(self.vocabulary[number] == h, number + 1, 0)
        stop = np.full(len(number) + 1, len(number), dtype=np.int64)
        breaks = np.flatnonzero(number == 0)
        stop[breaks] = breaks
        room_to = np.minimum.accumulate(stop[::-1])[::-1][:-1]
        room = np.minimum(room_to, np.repeat(at[1:], np.diff(at))) - np.arange(len(number))
        array = SuffixArray(number, room, self.least, self.window, self.bits)
        if not len(array.starts):
            return at, none, none, none
        a, b = array.find(self.low, self.high)
        count = b - a
        window = np.repeat(np.arange(len(count)), count)
        place = array.starts[np.arange(len(window)) - np.repeat(np.cumsum(count) - count - a, count)]
        cover = np.zeros(len(number) + 1, dtype=np.int64)
        np.add.at(cover, place, 1)
        np.add.at(cover, place + self.sizes[window], -1)
        met = np.flatnonzero(np.cumsum(cover)[:-1])
        other = number[met] - 1
        alike = same_spans(data, begin[met], end[met], self.word_bytes, self.word_at[other], self.word_at[other + 1])
        wrong = np.zeros(len(number) + 1, dtype=np.int64)
        wrong[met[~alike] + 1] = 1
        wrong = np.cumsum(wrong)
        real = wrong[place + self.sizes[window]] == wrong[place]
        place, window = place[real], window[real]
        text = np.searchsorted(at, place, "right") - 1
        return at, text, place - at[text], window


def _longest(ids: list[str], items: np.ndarray, diagonal: np.ndarray, places: np.ndarray, sizes: np.ndarray) -> tuple[int, str, int]:
    """The longest run of windows that follow each other in one item: (words, item's id, first word in the text); of equally long ones the smallest id's, then the first."""
    order = np.lexsort((places, diagonal, items))
    items, diagonal, places, sizes = items[order], diagonal[order], places[order], sizes[order]
    fresh = np.ones(len(items), dtype=bool)
    fresh[1:] = (items[1:] != items[:-1]) | (diagonal[1:] != diagonal[:-1]) | (places[1:] != places[:-1] + 1)
    first = np.flatnonzero(fresh)
    last = np.append(first[1:], len(items)) - 1
    length = places[last] - places[first] + sizes[last]
    which, at = min((ids[items[k]], int(places[k])) for k in first[length == length.max()].tolist())
    return int(length.max()), which, at


_FOUND = [
    T.StructField("n_words", T.LongType()),
    T.StructField("spans", T.ArrayType(T.LongType())),
    T.StructField("items", T.ArrayType(T.StringType())),
    T.StructField("longest", T.LongType()),
    T.StructField("longest_item", T.StringType()),
    T.StructField("longest_at", T.LongType()),
]


def _search(rows: DataFrame, text_col: str, windows: Windows) -> DataFrame:
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast(windows)
    names = rows.columns
    at_text, at_old = names.index(text_col), [names.index(f.name) for f in _FOUND]
    kept = [i for i in range(len(names)) if i not in at_old]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query = shared.value
        for batch in batches:
            _, spans, items, longest, longest_item, longest_at = ([*batch.column(i).to_pylist()] for i in at_old)
            n_words: list[int] = []
            for first, last, data, offsets in text_blocks(batch.column(at_text)):
                at, text, place, window = query.match(data, offsets)
                n_words.extend(np.diff(at).tolist())
                order = np.argsort(text, kind="stable")
                text, place, window = text[order], place[order], window[order]
                cuts = np.flatnonzero(np.diff(text)) + 1
                for own in np.split(np.arange(len(text)), cuts) if len(text) else []:
                    i = first + int(text[own[0]])
                    p, w = place[own], window[own]
                    size = query.sizes[w]
                    old = np.array(spans[i], dtype=np.int64).reshape(-1, 2)
                    spans[i] = _joined(np.concatenate([old[:, 0], p]), np.concatenate([old[:, 1], p + size]))
                    count = query.item_at[w + 1] - query.item_at[w]
                    take = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count - query.item_at[w], count)
                    item = query.items[take]
                    items[i] = sorted({*items[i], *(query.ids[k] for k in np.unique(item))})
                    long, which, where = _longest(query.ids, item, np.repeat(p, count) - query.places[take], np.repeat(p, count), np.repeat(size, count))
                    if long > longest[i] or long == longest[i] and (which, where) < (longest_item[i], longest_at[i]):
                        longest[i], longest_item[i], longest_at[i] = long, which, where
            new = [
                pa.array(v, t) for v,
                t in zip((n_words, spans, items, longest, longest_item, longest_at), (pa.int64(), pa.list_(pa.int64()), pa.list_(pa.string()), pa.int64(), pa.string(), pa.int64()))
            ]
            columns = {names[i]: batch.column(i) for i in kept} | {f.name: c for f, c in zip(_FOUND, new)}
            yield pa.RecordBatch.from_arrays([columns[n] for n in names], names=names)

    return rows.mapInArrow(run, rows.schema)


def _joined(begin: np.ndarray, end: np.ndarray) -> list[int]:
    """Spans that overlap or touch become one: begin, end, begin, end, ..."""
    order = np.argsort(begin, kind="stable")
    begin, end = begin[order], np.maximum.accumulate(end[order])
    fresh = np.ones(len(begin), dtype=bool)
    fresh[1:] = begin[1:] > end[:-1]
    first = np.flatnonzero(fresh)
    return np.stack([begin[first], end[np.append(first[1:], len(begin)) - 1]], axis=1).reshape(-1).tolist()


def matches(
    docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = 13,
    pass_bytes: int = PASS_BYTES
) -> DataFrame:
    """The documents with what the benchmark's windows hit in them.

    n_words; spans (first word and the word after the last, of each stretch of hit words, in turn); items (ids as text, sorted);
    longest, longest_item and longest_at (words of the longest match with one item, and where it begins; of equally long ones that
    of the smallest id, then the first). Input columns of these
    names are replaced. An item with fewer words than ``window`` is one window, one without words has none. A null text has no words
    and a null item id counts as the empty text. Items are searched for in passes of about ``pass_bytes``, so what is broadcast is bounded
    however large the benchmark; each pass reads the documents once and shuffles nothing.
    """
    spark = docs.sparkSession
    ship(spark)
    found = {f.name for f in _FOUND}
    rows = docs.drop(*found).withColumns(
        {
            "n_words": F.lit(None).cast("long"),
            "spans": F.array().cast("array<long>"),
            "items": F.array().cast("array<string>"),
            "longest": F.lit(0).cast("long"),
            "longest_item": F.lit(None).cast("string"),
            "longest_at": F.lit(None).cast("long"),
        }
    )
    items = items.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("id"), F.col(item_text).alias("text")).distinct()
    total = items.agg(F.coalesce(F.sum(F.octet_length("text") + F.octet_length("id") + 16), F.lit(0))).first()[0] or 0
    passes = max(1, -(-total // pass_bytes))
    for k in range(passes):
        own = items.where(F.pmod(F.xxhash64("id", "text"), F.lit(passes)) == k).orderBy("id", "text").toPandas()
        rows = _search(rows, text_col, Windows(own["id"].tolist(), own["text"].tolist(), window))
        if k + 1 < passes:
            rows = stored(rows)
    return rows


def verdicts(docs: DataFrame, items: DataFrame, window: int = 13, least_share: int = 20, **names: str) -> DataFrame:
    """``matches`` with n_hit, n_items, items_sha256 and contaminated: at least one word of ``least_share`` is hit."""
    rows = matches(docs, items, window=window, **names)
    signed = F.transform("spans", lambda x, k: F.when(k % 2 == 1, x).otherwise(-x))
    rows = rows.withColumn("n_hit", F.aggregate(signed, F.lit(0).cast("long"), lambda s, x: s + x))
    return rows.withColumns(
        {"n_items": F.size("items").cast("long"), "items_sha256": F.sha2(F.array_join("items", ","), 256), "contaminated": (F.col("n_hit") > 0) & (least_share * F.col("n_hit") >= F.col("n_words"))}
    )


def decontaminate(docs: DataFrame, items: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The documents that the benchmark doesn't contaminate, with their own columns, whatever their names."""
    apart = set_apart(docs, {text_col})
    return verdicts(apart, items, text_col=text_col, **options).where(~F.col("contaminated")).select(*apart.columns).toDF(*docs.columns)
