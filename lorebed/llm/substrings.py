"""Substring dedup: repeated windows of words, found exactly behind a count-min prefilter.

Equal windows have the same smallest gram of ``gram`` words, so a window occurs at most as often as runs of windows with that smallest
gram do. Each task counts its runs in its own count-min sketch; the sketches are merged block by block, and can only overestimate. A run's two cells lie
in one block, so the runs go to the blocks once, where those that aren't estimated repeated drop out in passing. A second
pass looks at the others alone: it first groups whole runs, then the single windows of runs that differ but
share their smallest gram. Groups are told apart by 128 bits of hashes under a key that is drawn anew each time, so that no text can be written to collide.
"""

from __future__ import annotations

import hashlib
import secrets
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .job import discard, keyed, ship, spread_join, stored, text_or_empty
from .textblocks import SPACED, U64, grams, hash_spans, mix, text_blocks, word_spans

_BLOCK_BITS = 16
_FLUSH = 1 << 21
#: Tasks that a block of cells goes to, by the hash of a run's key: one run may be a third of all.
_SALTS = 4
RUN = "h long, ctx long, key binary, start int, n int, twice boolean"


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` consecutive values."""
    size = 1
    while size * 2 <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    return np.minimum(values[: len(values) - (width - size)], values[width - size :]) if width > size else values


class Runs:
    """The windows of a block of texts, and their runs: neighbours in one text with the same smallest gram."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, window: int, gram: int, key: int = 0):
        self.begin, self.end, self.at = word_spans(data, offsets, SPACED)
        self.window = window
        empty = np.zeros(0, np.int64)
        self.text = self.start = self.n = empty
        self.h = self.ctx = self.hashes = np.zeros(0, U64)
        self.twice = np.zeros(0, bool)
        count = np.maximum(np.diff(self.at) - window + 1, 0)
        if not count.any():
            return
        words = hash_spans(data, self.begin, self.end, key)
        one = np.array([0, len(words)])
        small, whole = grams(words, one, gram)[0], grams(words, one, window)[0]
        first = np.cumsum(count) - count
        text = np.repeat(np.arange(len(count)), count)
        place = np.arange(len(text)) - first[text]
        index = place + self.at[:-1][text]
        h, self.hashes = _least(small, window - gram + 1)[index], whole[index]
        fresh = np.ones(len(h), dtype=bool)
        fresh[1:] = (h[1:] != h[:-1]) | (text[1:] != text[:-1])
        self.first = np.flatnonzero(fresh)
        self.n = np.diff(np.append(self.first, len(h)))
        self.text, self.start, self.h = text[self.first], place[self.first], h[self.first]
        total = np.concatenate([[U64(0)], np.cumsum(self.hashes * (U64(2) * (np.arange(len(h)) - np.repeat(self.first, self.n)).astype(U64) + U64(0x9E3779B97F4A7C15)))])
        self.ctx = mix(total[self.first + self.n] - total[self.first] + self.n.astype(U64))
        self.twice = np.zeros(len(self.first), dtype=bool)
        ordered = np.sort(self.hashes)
        again = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
        if len(again):
            near = np.minimum(np.searchsorted(again, self.hashes), len(again) - 1)
            found = np.flatnonzero(again[near] == self.hashes)
            run = np.searchsorted(self.first, found, "right") - 1
            pair, seen = np.unique(np.stack([run.astype(U64), self.hashes[found]], axis=1), axis=0, return_counts=True)
            self.twice[pair[seen > 1, 0].astype(np.int64)] = True


def _sketches(window: int, gram: int, key: int, block_bits: int):
    """(block, cells, counts) of each task's runs: a block has two rows of cells, laid end to end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[np.ndarray] = []

        def flush() -> pa.RecordBatch:
            h = np.concatenate(kept) if kept else np.zeros(0, U64)
            kept.clear()
            block = _block(h, block_bits)
            place, n = np.unique(np.concatenate([block << (_BLOCK_BITS + 1) | c for c in _cells(h)]), return_counts=True)
            n = np.minimum(n, 2).astype(np.uint8)
            own = place >> (_BLOCK_BITS + 1)
            first = np.flatnonzero(np.diff(own, prepend=-1))
            cells = (place & ((2 << _BLOCK_BITS) - 1)).astype(np.uint32)
            cut = list(zip(first, np.append(first[1:], len(own))))
            return pa.RecordBatch.from_arrays([pa.array(own[first]), pa.array([cells[a:b].tobytes() for a, b in cut], pa.binary()), pa.array([n[a:b].tobytes() for a, b in cut], pa.binary())], names=["block", "cells", "counts"])

        for batch in batches:
            for _, _, data, offsets in text_blocks(batch.column(0)):
                runs = Runs(data, offsets, window, gram, key)
                kept.append(np.concatenate([runs.h, runs.h[runs.twice]]))
                if sum(map(len, kept)) >= _FLUSH:
                    yield flush()
        yield flush()

    return run


def _block(h: np.ndarray, block_bits: int) -> np.ndarray:
    return (h & U64((1 << block_bits) - 1)).astype(np.int64)


def _cells(h: np.ndarray) -> list[np.ndarray]:
    """A run's cells in its block, one in each row."""
    return [(h >> U64(64 - _BLOCK_BITS)).astype(np.int64), (mix(h ^ U64(0x5851F42D4C957F2D)) >> U64(64 - _BLOCK_BITS)).astype(np.int64) + (1 << _BLOCK_BITS)]


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The cells of one block that all sketches together count twice or more, as bits; counters stop at 2."""
    total = np.zeros(2 << _BLOCK_BITS, dtype=np.uint8)
    block = 0
    for batch in batches:
        for b, cells, counts in zip(*(c.to_pylist() for c in batch.columns)):
            block, cells = b, np.frombuffer(cells, dtype=np.uint32)
            total[cells] = np.minimum(total[cells] + np.frombuffer(counts, dtype=np.uint8), 2)
    yield pa.RecordBatch.from_arrays([pa.array([block]), pa.array([np.packbits(total >= 2).tobytes()], pa.binary())], names=["block", "busy"])


def _estimated_repeated(batches: Iterator[pa.RecordBatch], block_bits: int) -> Iterator[pa.RecordBatch]:
    """Of runs sorted by block, after rows of no windows that hold the block's busy cells as their key: the runs whose cells are all busy."""
    block, busy = -1, np.zeros(0, bool)
    for batch in batches:
        h, n = np.asarray(batch.column(0)).view(U64), np.asarray(batch.column(4))
        own = _block(h, block_bits)
        keep = np.zeros(len(own), dtype=bool)
        cuts = np.flatnonzero(np.diff(own)) + 1
        for a, b in zip(np.append(0, cuts), np.append(cuts, len(own))):
            told = int((n[a:b] == 0).sum())
            if told:
                block, busy = int(own[a]), np.unpackbits(np.frombuffer(batch.column(2)[int(a)].as_py(), dtype=np.uint8)).astype(bool)
                a += told
            if a < b and block == own[b - 1]:
                low, high = _cells(h[a:b])
                keep[a:b] = busy[low] & busy[high]
        yield batch.filter(pa.array(keep))


def repeated_spans(rows: DataFrame, window: int = 35, gram: int = 12) -> DataFrame:
    """(key, start, n): n windows of the text from word ``start`` on occur elsewhere too. ``rows`` has key and text, not null."""
    spark = rows.sparkSession
    ship(spark)
    secret = secrets.randbits(60)
    texts = rows.select("text")
    total = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    # Some ten cells of each row for each run, however many there are.
    block_bits = max(0, int(total // 8).bit_length() - _BLOCK_BITS)
    sketches = texts.mapInArrow(_sketches(window, gram, secret, block_bits), "block long, cells binary, counts binary")
    busy = stored(sketches.groupBy("block").applyInArrow(_merged, "block long, busy binary"))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, _, data, offsets in text_blocks(batch.column(1)):
                r = Runs(data, offsets, window, gram, secret)
                columns = [pa.array(r.h.view(np.int64)), pa.array(r.ctx.view(np.int64)), batch.column(0).take(pa.array(first + r.text)), pa.array(r.start.astype(np.int32)), pa.array(r.n.astype(np.int32)), pa.array(r.twice)]
                yield pa.RecordBatch.from_arrays(columns, names=["h", "ctx", "key", "start", "n", "twice"])

    runs = rows.select("key", "text").mapInArrow(find, RUN)
    # A block's cells go to each of its tasks, in the shape of a run.
    salts = F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))).alias("start")
    cells = busy.select(F.col("block").alias("h"), F.lit(0).cast("long").alias("ctx"), F.col("busy").alias("key"), salts).select("*", F.lit(0).alias("n"), F.lit(False).alias("twice"))
    block = F.col("h").bitwiseAND(F.lit((1 << block_bits) - 1).cast("long"))
    salt = F.when(F.col("n") == 0, F.col("start").cast("long")).otherwise(F.pmod(F.xxhash64("key"), F.lit(_SALTS)))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    both = runs.unionByName(cells).repartition(parts, block, salt).sortWithinPartitions(block, F.col("n") > 0)
    runs = stored(both.mapInArrow(lambda batches: _estimated_repeated(batches, block_bits), RUN))
    discard(busy)
    # Whole runs first: alike in all their windows.
    alike = stored(runs.groupBy("h", "ctx").agg(F.count("*").alias("seen"), F.max("twice").alias("twice"), F.min(F.struct("key", "start", "n")).alias("one")))
    twins = spread_join(runs, alike.where("seen > 1").select("h", "ctx"), ["h", "ctx"], salts=_SALTS).select("key", "start", "n")
    # Then the windows of runs that differ and share their smallest gram, or that repeat themselves: one run of each kind stands for all.
    shared = alike.groupBy("h").agg(F.count("*").alias("kinds"), F.max("twice").alias("any_twice")).where("kinds > 1 OR any_twice").select("h")
    open_ = alike.join(shared, "h").select("h", F.least("seen", F.lit(2)).cast("int").alias("weight"), "one.*")
    wanted = open_.groupBy("key").agg(F.collect_list(F.struct("h", "weight", "start", "n")).alias("runs"))
    with_runs = rows.select("key", "text").join(wanted.hint("merge"), "key")

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            for first, last, data, offsets in text_blocks(batch.column(1)):
                r = Runs(data, offsets, window, gram, secret)
                part = lists.slice(first, last - first)
                flat, size = part.flatten(), np.asarray(part.value_lengths()).astype(np.int64)
                h, weight, start, n = (np.asarray(flat.field(k)).astype(np.int64) for k in range(4))
                text = np.repeat(np.arange(last - first), size)
                count = np.maximum(np.diff(r.at) - window + 1, 0)
                begin = (np.cumsum(count) - count)[text] + start
                run = np.repeat(np.arange(len(h)), n)
                step = np.arange(len(run)) - np.repeat(np.cumsum(n) - n, n)
                columns = [pa.array(h[run]), pa.array(r.hashes[begin[run] + step].view(np.int64)), pa.array(weight[run].astype(np.int32)), batch.column(0).take(pa.array(first + text[run])), pa.array((start[run] + step).astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, names=["h", "w", "weight", "key", "start"])

    windows = stored(with_runs.mapInArrow(explode, "h long, w long, weight int, key binary, start int"))
    often = windows.groupBy("h", "w").agg(F.sum("weight").alias("seen")).where("seen > 1").select("h", "w")
    found = spread_join(windows.where("weight = 1"), often, ["h", "w"], salts=_SALTS).select("key", "start", F.lit(1).alias("n"))
    spans = stored(twins.unionByName(found).distinct())
    discard(runs, alike, windows)
    return spans


def _without(data: np.ndarray, offsets: np.ndarray, starts: pa.Array, sizes: pa.Array, window: int) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """(words, removed words, what is left) of each text."""
    begin, end, at = word_spans(data, offsets, SPACED)
    cover = np.zeros(len(begin) + 1, dtype=np.int64)
    size = np.asarray(pa.compute.fill_null(starts.value_lengths(), 0)).astype(np.int64)
    first = np.repeat(at[:-1], size) + np.asarray(starts.flatten()).astype(np.int64)
    np.add.at(cover, first, 1)
    np.add.at(cover, first + np.asarray(sizes.flatten()).astype(np.int64) + window - 1, -1)
    stays = np.cumsum(cover)[:-1] == 0
    kept = np.concatenate([[0], np.cumsum(stays)])[at]
    b, e = begin[stays], end[stays]
    long = e - b + 1
    place = np.concatenate([[0], np.cumsum(long)])
    out = np.append(data, np.uint8(32))[np.minimum(np.arange(place[-1]) - np.repeat(place[:-1] - b, long), len(data))]
    out[place[1:] - 1] = 32
    raw = out.tobytes()
    left = [raw[place[i] : max(place[i], place[j] - 1)] for i, j in zip(kept[:-1], kept[1:])]
    return np.diff(at), np.diff(at) - np.diff(kept), left


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 35, gram: int = 12, digest: bool = False) -> DataFrame:
    """Every text without the words of repeated windows: id, n_words, n_removed and text, or with ``digest`` kept_sha256.

    Words are what white space parts; the words that are left are joined by one space. A window is ``window`` consecutive words of one text, and is
    repeated if the same words start anywhere else, in the same text too. Windows are judged on the input. A null text has no words.
    Rows alike in id and text are repeats of each other.
    """
    if not 1 <= gram <= window:
        raise ValueError("a gram is at most as long as a window")
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(keyed(id_col, text_col).alias("key"), F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    spans = repeated_spans(rows, window, gram).groupBy("key").agg(F.collect_list(F.struct("start", "n")).alias("spans"))
    spans = spans.select("key", F.transform("spans", lambda s: s["start"]).alias("starts"), F.transform("spans", lambda s: s["n"]).alias("sizes"))
    joined = rows.join(spans.hint("merge"), "key", "left").select("doc_id", "text", "starts", "sizes")
    last = "kept_sha256" if digest else "text"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, offsets in text_blocks(batch.column(1)):
                part = batch.slice(first, end - first)
                n, removed, left = _without(data, offsets, part.column(2), part.column(3), window)
                out = [hashlib.sha256(x).hexdigest() for x in left] if digest else [x.decode("utf-8", "replace") for x in left]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n), pa.array(removed), pa.array(out, pa.string())], names=["doc_id", "n_words", "n_removed", last])

    return joined.mapInArrow(run, f"doc_id {docs.schema[id_col].dataType.simpleString()}, n_words long, n_removed long, {last} string")
