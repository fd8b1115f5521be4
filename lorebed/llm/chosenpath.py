"""N-gram Jaccard join by chosen paths.

Each distinct text is a set of word shingles, embedded as ``size`` MinHash tokens. In one run the texts start in one bucket; a bucket chooses
a few token places at random, and splits into the texts that share a token at a chosen place, again and again until it is small. Small buckets are
compared by brute force on short sketches; what is still large after the last split is compared pair of blocks by pair of blocks. A pair at the threshold stays together to depth d with a known probability, and the number of runs is the
smallest that finds it with ``recall``. What the sketches connect is then compared exactly, text by text in blocks, so that the links
of a text are counted in full and nothing but linked groups is ever put side by side.
"""

from __future__ import annotations

import math
import secrets
from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .job import discard, keyed, set_apart, ship, spread_join, stored, text_or_empty
from .minhash import MinHash
from .textblocks import U64, give_back, mix, text_blocks


class ChosenPath:
    """The random choices of the join, which every task makes alike."""

    def __init__(self, threshold: float = 0.8, size: int = 128, shingle: int = 5, depth: int = 3, recall: float = 0.99, bucket: int = 256, slack: float = 0.12, seed: int = 7):
        self.threshold, self.size, self.depth, self.bucket = Fraction(threshold).limit_denominator(1000), size, depth, bucket
        self.minhash = MinHash(size, shingle, seed)
        self.runs = self._runs(threshold, depth, recall)
        #: Sketches of one byte for each place; pairs count as candidates well below the threshold.
        least = max(0.0, threshold - slack)
        self.least_equal = math.floor(size * (least + (1 - least) / 256))
        #: Texts this like the pivot of a large bucket leave with it: whatever is like them is like enough to the pivot to be linked to it,
        #: as distances add up. Both bounds have two standard errors on their safe side, so one text in 40 at most is misjudged by either.
        far = 1 - float(self.threshold)
        sure = lambda likeness, errors: max(0.0, min(1.0, likeness + errors * math.sqrt(likeness * (1 - likeness) / size)))
        self.leave_equal = math.ceil(size * sure(1 - 0.5 * far, 2))
        self.pivot_equal = math.floor(size * sure(max(0.0, 1 - 1.5 * far), -2))
        self._limit = U64(int((1 << 64) / (float(self.threshold) * size)))

    @staticmethod
    def _runs(threshold: float, depth: int, recall: float) -> int:
        together = 1.0
        for _ in range(depth):
            together = 1 - math.exp(-together)  # a Poisson number of shared children with mean 1
        return math.ceil(math.log(1 - recall) / math.log(1 - together))

    def roots(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(row, path) of each of n rows in each run."""
        return np.repeat(np.arange(n), self.runs), np.tile(mix(np.arange(1, self.runs + 1, dtype=U64) * U64(0x9E3779B97F4A7C15)), n)

    def children(self, row: np.ndarray, path: np.ndarray, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, path) one level down; tokens: one row of ``size`` values for each text."""
        rows, paths = [], []  # ``row`` says which row of tokens each path is of
        for i in range(self.size):
            chosen = np.flatnonzero(mix(path + U64((2 * i + 1) * 0xC2B2AE3D27D4EB4F & 0xFFFFFFFFFFFFFFFF)) < self._limit)
            rows.append(row[chosen])
            paths.append(mix(path[chosen] * U64(0xA0761D6478BD642F) + (tokens[row[chosen], i].astype(U64) << U64(8)) + U64(i + 1)))
        return np.concatenate(rows), np.concatenate(paths)


def _binary(rows: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes() for r in rows], pa.binary())


def _matrix(column: pa.Array, kind: type) -> np.ndarray:
    raw = b"".join(column.to_pylist())
    return np.frombuffer(raw, dtype=kind).reshape(len(column), -1) if len(column) else np.zeros((0, 1), kind)


def grouped(batches: Iterator[pa.RecordBatch], column: int, each: Callable[[pa.RecordBatch], pa.RecordBatch | None]) -> Iterator[pa.RecordBatch]:
    """Calls ``each`` on the rows of one group after the other; rows come sorted by the group's column, whose groups are small."""
    left: list[pa.RecordBatch] = []
    for batch in batches:
        ids = np.asarray(batch.column(column))
        cuts = [0, *(np.flatnonzero(ids[1:] != ids[:-1]) + 1).tolist(), len(ids)]
        for a, b in zip(cuts[:-1], cuts[1:]):
            part = batch.slice(a, b - a)
            if left and left[-1].column(column)[0].as_py() != part.column(column)[0].as_py():
                out = each(pa.concat_batches(left))
                left = []
                if out is not None:
                    yield out
            if b > a:
                left.append(part)
    if left:
        out = each(pa.concat_batches(left))
        if out is not None:
            yield out
    give_back()


def forest(linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what a symmetric matrix of links connects, fewer than it has rows."""
    n = len(linked)
    open_ = np.ones(n, dtype=bool)
    a, b = [], []
    for start in range(n):
        if not open_[start]:
            continue
        open_[start] = False
        todo = [start]
        while todo:
            i = todo.pop()
            new = np.flatnonzero(linked[i] & open_)
            open_[new] = False
            a.extend([i] * len(new))
            b.extend(new.tolist())
            todo.extend(new.tolist())
    return np.array(a, dtype=np.int64), np.array(b, dtype=np.int64)


def candidate_links(reps: DataFrame, path: ChosenPath) -> DataFrame:
    """(a, b): links between numbered texts that connect all candidate pairs. ``reps`` has rep, tokens and sketch."""

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, bucket = path.children(*path.roots(batch.num_rows), _matrix(batch.column(1), np.uint32))
            yield pa.RecordBatch.from_arrays([pa.array(bucket.view(np.int64)), batch.column(0).take(pa.array(row))], names=["bucket", "rep"])

    schema = "bucket long, rep long"
    paths = reps.select("rep", "tokens").mapInArrow(first, schema)
    small: list[DataFrame] = []
    links: list[DataFrame] = []
    tables: list[DataFrame] = []
    for level in range(1, path.depth + 1):
        sizes = paths.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
        held = stored(spread_join(paths, sizes, ["bucket"], by="rep"))
        tables.append(held)
        small.append(held.where(F.col("size") <= path.bucket).select("bucket", "rep"))
        big = held.where(F.col("size") > path.bucket)
        if big.isEmpty():
            break
        left = shed(big, reps, path, split=level < path.depth)
        tables.append(left)
        links.append(linked_to_pivot(left))
        paths = staying(left)
    else:
        small.append(in_blocks(paths, path))
    rows = small[0]
    for more in small[1:]:
        rows = rows.unionByName(more)
    found = bucket_links(rows, reps, path)
    for more in links:
        found = found.unionByName(more)
    found = stored(found.distinct())
    discard(*tables)
    return found


def linked_to_pivot(left: DataFrame) -> DataFrame:
    return left.where("pivot IS NOT NULL").select(F.col("rep").alias("a"), F.col("pivot").alias("b"))


def staying(left: DataFrame) -> DataFrame:
    return left.where("pivot IS NULL").select("bucket", "rep")


def shed(big: DataFrame, reps: DataFrame, path: ChosenPath, split: bool) -> DataFrame:
    """Takes the texts like its pivot out of each large bucket. Returns a stored table (bucket, rep, pivot): with a pivot, a text linked to it; without,
    one that stays, in the buckets one level down if ``split``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens, rep, pivot = _matrix(batch.column(1), np.uint32), np.asarray(batch.column(0)), np.asarray(batch.column(3))
            equal = ((tokens & 0xFF).astype(np.uint8) == _matrix(batch.column(4), np.uint8)).sum(axis=1)
            linked = np.flatnonzero((equal >= path.pivot_equal) & (rep != pivot))
            row = np.flatnonzero(equal < path.leave_equal)
            bucket = np.asarray(batch.column(2))[row].view(U64)
            if split and len(row):
                row, bucket = path.children(row, bucket, tokens)
            buckets = pa.array(np.concatenate([bucket.view(np.int64), np.zeros(len(linked), np.int64)]))
            pivots = pa.concat_arrays([pa.nulls(len(row), pa.int64()), pa.array(pivot[linked])])
            yield pa.RecordBatch.from_arrays([buckets, pa.array(rep[np.concatenate([row, linked])]), pivots], names=["bucket", "rep", "pivot"])

    heads = big.groupBy("bucket").agg(F.min_by("rep", F.xxhash64("bucket", "rep")).alias("pivot"))
    heads = heads.join(reps.select(F.col("rep").alias("pivot"), F.col("sketch").alias("pivot_sketch")), "pivot")
    rows = spread_join(big.select("bucket", "rep"), heads, ["bucket"], by="rep").join(reps.select("rep", "tokens"), "rep").select("rep", "tokens", "bucket", "pivot", "pivot_sketch")
    return stored(rows.mapInArrow(run, "bucket long, rep long, pivot long"))


def in_blocks(rows: DataFrame, path: ChosenPath) -> DataFrame:
    """Large buckets (bucket, rep) as pairs of blocks of about ``path.bucket`` texts, so that every two texts of a bucket share one of the small buckets made."""
    sizes = rows.groupBy("bucket").agg(F.ceil(F.count("*") / path.bucket).cast("int").alias("blocks"))
    own = spread_join(rows, sizes, ["bucket"], by="rep").withColumn("own", F.pmod(F.xxhash64("bucket", "rep"), F.col("blocks")).cast("int"))
    each = own.select("bucket", "rep", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    return each.select(F.xxhash64("bucket", F.least("own", "other"), F.greatest("own", "other")).alias("bucket"), "rep")


def bucket_links(rows: DataFrame, reps: DataFrame, path: ChosenPath) -> DataFrame:
    """(a, b): links that connect the texts of each bucket whose sketches are alike; ``rows`` has bucket and rep, in small buckets."""

    def compare(rows: pa.RecordBatch) -> pa.RecordBatch | None:
        sketch = _matrix(rows.column(2), np.uint8)
        a, b = forest(np.stack([(sketch == own).sum(axis=1) for own in sketch]) >= path.least_equal)
        if not len(a):
            return None
        rep = np.asarray(rows.column(1))
        return pa.RecordBatch.from_arrays([pa.array(rep[a]), pa.array(rep[b])], names=["a", "b"])

    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.join(reps.select("rep", "sketch"), "rep").select("bucket", "rep", "sketch").repartition(parts, "bucket").sortWithinPartitions("bucket")
    return rows.mapInArrow(lambda batches: grouped(batches, 0, compare), "a long, b long")


def _intersections(sets: list[np.ndarray]) -> np.ndarray:
    """How many values each two of the sorted sets share, by matrix products over the values that are in more than one."""
    values = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    fresh = np.ones(len(values), dtype=bool)
    fresh[1:] = values[1:] != values[:-1]
    number = np.cumsum(fresh) - 1
    shared = np.bincount(number)[number] > 1
    owner, number = owner[shared], number[shared]
    _, number = np.unique(number, return_inverse=True)
    total = np.zeros((len(sets), len(sets)), dtype=np.float64)
    width = 4096
    for first in range(0, int(number[-1]) + 1 if len(number) else 0, width):
        a, b = np.searchsorted(number, [first, first + width])
        has = np.zeros((len(sets), width), dtype=np.float32)
        has[owner[a:b], number[a:b] - first] = 1
        total += has @ has.T
    return total.astype(np.int64)


def verified(groups: DataFrame, texts: DataFrame, path: ChosenPath, block: int = 256, block_bytes: int = 8 << 20) -> DataFrame:
    """(a, b, texts, docs) of the texts in groups: with b, a link that connects; without, how many texts and documents a part of the work links to a.

    ``groups`` has node, root and bytes; ``texts`` has rep, text and copies. Every two texts of a group are compared by their whole
    shingle sets. A group beyond ``block`` texts or ``block_bytes`` is dealt out as pairs of blocks, so no task holds more than two blocks.
    Shingles are hashed under a key that is drawn anew each time, so that no texts can be written to collide.
    """
    spark = groups.sparkSession
    key = secrets.randbits(60)
    sizes = groups.groupBy("root").agg(F.ceil(F.greatest(F.count("*") / block, F.sum("bytes") / block_bytes)).cast("int").alias("blocks"))
    rows = spread_join(groups, sizes, ["root"], by="node").select(F.col("node").alias("rep"), "root", "blocks", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("own"))
    rows = rows.join(texts, "rep")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    rows = rows.select("rep", "root", "own", "copies", "text", other.alias("other"))
    rows = rows.select(F.xxhash64("root", F.least("own", "other"), F.greatest("own", "other")).alias("part"), "rep", "root", "own", F.greatest("own", "other").alias("high"), F.least("own", "other").alias("low"), "copies", "text")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(parts, "part").sortWithinPartitions("part")
    up, down = path.threshold.numerator, path.threshold.denominator

    def compare(rows: pa.RecordBatch) -> pa.RecordBatch | None:
        sets = []
        for _, _, data, offsets in text_blocks(rows.column(7)):
            hashes, at = path.minhash.shingles(data, offsets, key)
            sets.extend(np.unique(hashes[a:b]) for a, b in zip(at[:-1], at[1:]))
        common = _intersections(sets)
        size = np.array([len(s) for s in sets])
        linked = (common > 0) & (down * common >= up * (size[:, None] + size[None, :] - common))
        np.fill_diagonal(linked, False)
        root, own, high, low = (np.asarray(rows.column(k)) for k in (2, 3, 4, 5))
        # Two groups could share a part by chance, and blocks of one part are only compared with each other.
        linked &= root[:, None] == root[None, :]
        linked &= (own[:, None] != own[None, :]) | ((high == low)[:, None] & (high == low)[None, :])
        copies, rep = np.asarray(rows.column(6)), np.asarray(rows.column(1))
        a, b = forest(linked)
        n = len(rep)
        nothing = pa.nulls(n, pa.int64())
        some = linked.any(axis=1)
        counts = [pa.array(rep), nothing, pa.array(linked.sum(axis=1)), pa.array(linked @ copies)]
        edges = [pa.array(rep[a]), pa.array(rep[b]), pa.array(np.zeros(len(a), np.int64)), pa.array(np.zeros(len(a), np.int64))]
        keep = pa.array(np.concatenate([some, np.ones(len(a), bool)]))
        return pa.RecordBatch.from_arrays([pa.concat_arrays([x, y]) for x, y in zip(counts, edges)], names=["a", "b", "texts", "docs"]).filter(keep)

    return rows.mapInArrow(lambda batches: grouped(batches, 0, compare), "a long, b long, texts long, docs long")


def near_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: ChosenPath | None = None, candidates: Callable[[DataFrame, ChosenPath], DataFrame] = candidate_links) -> DataFrame:
    """key, doc_id, class_id, n_links, n_text_links and first of every document.

    Two documents are linked if their texts are equal, or if the shingle sets of their texts have a Jaccard similarity of the threshold or more.
    class_id is the smallest id of the documents that links connect; n_links counts the documents that this one is linked with, n_text_links the
    other texts. ``first`` marks one document of each class, that with the smallest id (null before all), then the smallest key. A null text
    is empty; texts without words are linked if they are equal.
    """
    path = path or ChosenPath()
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(keyed(id_col, text_col).alias("key"), F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    rows = rows.withColumn("digest", F.unhex(F.md5("text")))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, offsets in text_blocks(batch.column(0)):
                hashes, at = path.minhash.shingles(data, offsets)
                tokens = path.minhash.signatures(hashes, at)
                some = pa.array(np.diff(at) > 0)
                columns = [batch.column(1).slice(first, last - first), _binary(tokens), _binary((tokens & 0xFF).astype(np.uint8)), pa.array(np.diff(offsets))]
                yield pa.RecordBatch.from_arrays(columns, names=["digest", "tokens", "sketch", "bytes"]).filter(some)

    members = rows.select("key", "doc_id", "digest")
    # One row stands for all with its text.
    numbered = members.groupBy("digest").agg(F.count("*").alias("copies"), F.min("key").alias("key")).withColumn("rep", F.monotonically_increasing_id())
    numbered = stored(numbered)
    signed = rows.select("text", "digest").mapInArrow(sign, "digest binary, tokens binary, sketch binary, bytes long").groupBy("digest").agg(*(F.min(c).alias(c) for c in ("tokens", "sketch", "bytes")))
    reps = stored(signed.join(numbered.select("digest", "rep"), "digest").select("rep", "tokens", "sketch", "bytes"))
    groups = components(candidates(reps, path))
    wanted = groups.join(numbered, groups.node == numbered.rep).join(reps.select("rep", "bytes"), "rep").select("key", "rep", "copies", "root", "bytes")
    wanted = stored(wanted)
    discard(reps, groups)
    # Rows alike in id and text share a key, and agree in everything that is read; they are in one task after the join.
    texts = rows.select("key", "text").join(wanted.select("key", "rep", "copies").hint("merge"), "key").dropDuplicates(["key"]).select("rep", "copies", "text")
    found = stored(verified(wanted.select(F.col("rep").alias("node"), "root", "bytes"), texts, path))
    discard(wanted)
    classes = components(found.where("b IS NOT NULL").select("a", "b"))
    counts = found.where("b IS NULL").groupBy(F.col("a").alias("rep")).agg(F.sum("texts").alias("texts"), F.sum("docs").alias("docs"))
    described = numbered.join(counts, "rep", "left").join(classes.withColumnRenamed("node", "rep"), "rep", "left")
    described = described.select("digest", F.coalesce("root", "rep").alias("root"), (F.col("copies") - 1 + F.coalesce("docs", F.lit(0))).alias("n_links"), F.coalesce("texts", F.lit(0)).cast("long").alias("n_text_links"))
    described = stored(spread_join(members, described, ["digest"]).drop("digest"))
    discard(numbered, found, classes)
    heads = described.groupBy("root").agg(F.min(F.struct("doc_id", "key")).alias("head"), F.min("doc_id").alias("class_id"))
    return spread_join(described, heads, ["root"]).select("key", "doc_id", "class_id", "n_links", "n_text_links", (F.col("key") == F.col("head.key")).alias("first"))


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: ChosenPath | None = None) -> DataFrame:
    """One document of each class, with its own columns, whatever their names; of rows alike in id and text one stays."""
    apart = set_apart(docs, {id_col, text_col})
    kept = near_classes(apart, id_col, text_col, path).where("first").select(F.col("key").alias("__key")).distinct()
    return apart.withColumn("__key", keyed(id_col, text_col)).join(kept.hint("merge"), "__key").dropDuplicates(["__key"]).drop("__key").toDF(*docs.columns)
