"""Toxicity: cumulative-link ordinal regression of a severity grade on the words of a text.

The features are marks: hashed words, and beginnings of words, that toxic texts have more often than chance explains. A text's score is the mean weight of its
marks, 0 if it has none, so that a long text isn't worse for its length. One weight for each mark and a threshold for each grade are fitted to grades that come
with the labels.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .job import discard, ship, stored
from .textblocks import LETTERED, LOWER, hash_spans, mix, text_blocks, word_spans

#: Labelled rows that a model is fitted on, at most: those whose ids have the smallest hashes.
SAMPLE_ROWS = 20_000


#: A word's first so many bytes are features too: insults take many endings.
PREFIXES = (4, 5, 6, 7, 8)


def _features(data: np.ndarray, offsets: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The hashed features of the words (letters and digits, A-Z in lower case) and of their beginnings, and the first feature of each text."""
    data = LOWER[data]
    begin, end, at = word_spans(data, offsets, LETTERED)
    hashes = np.stack([hash_spans(data, begin, end), *(mix(hash_spans(data, begin, np.minimum(end, begin + k)) + np.uint64(k)) for k in PREFIXES)], axis=1)
    real = np.stack([np.ones(len(begin), dtype=bool), *(end - begin > k for k in PREFIXES)], axis=1)
    first = np.concatenate([[0], np.cumsum(real.sum(axis=1))])[at]
    return (hashes[real] >> np.uint64(64 - bits)).astype(np.int32), first


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -500, 500)))


class OrdinalModel:
    """P(grade >= k) = sigmoid(w x - threshold_k): one weight vector for every threshold, which ascend."""

    def __init__(self, bits: int, place: np.ndarray, weights: np.ndarray, thresholds: np.ndarray):
        self.bits, self.place, self.weights, self.thresholds = bits, place, weights, thresholds

    def at_least(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """One row for each text: the probability of each grade from 1 on, or a higher one."""
        words, at = _features(data, offsets, self.bits)
        place = self.place[words]
        found = np.flatnonzero(place >= 0)
        text = np.searchsorted(at, found, "right") - 1
        pair = np.unique(text * len(self.weights) + place[found])
        text = pair // max(1, len(self.weights))
        total = np.bincount(text, weights=self.weights[pair % max(1, len(self.weights))], minlength=len(at) - 1)
        return _sigmoid((total / np.maximum(np.bincount(text, minlength=len(at) - 1), 1))[:, None] - self.thresholds)


def _select(n_docs: int, n_toxic: int, having: np.ndarray, toxic_having: np.ndarray, chance: float, least_rate: float) -> np.ndarray:
    """Features that toxic texts have several times more often, and more clearly so than chance would let ``chance`` of all the features be.

    By Chernoff's bound, of a feature that h texts have at random t or more are toxic with a probability of at most exp(-h KL(t / h, share of toxic texts)).
    """
    share, own = n_toxic / n_docs, toxic_having / having
    with np.errstate(divide="ignore", invalid="ignore"):
        apart = np.where(own > 0, own * np.log(own / share), 0) + np.where(own < 1, (1 - own) * np.log((1 - own) / (1 - share)), 0)
    # What toxic texts have a little more often tells their length and language, not their tone.
    rate = (toxic_having / n_toxic) / np.maximum((having - toxic_having) / (n_docs - n_toxic), 1e-9)
    return np.flatnonzero((rate >= least_rate) & (having * apart >= np.log(len(having) / chance)))


def _ordinal(x: list[np.ndarray], y: np.ndarray, n_features: int, grades: int, penalty: float, steps: int) -> tuple[np.ndarray, np.ndarray]:
    """Penalised maximum likelihood by Adam; x: the features that each row has, which weigh alike and sum to one."""
    rows = np.repeat(np.arange(len(x)), [len(f) for f in x])
    columns = np.concatenate(x) if len(x) else np.zeros(0, np.int64)
    value = np.array([1 / max(1, len(f)) for f in x])
    share = np.array([(y >= k).mean() for k in range(1, grades)]).clip(1e-4, 1 - 1e-4)
    start = np.log((1 - share) / share)
    params = np.concatenate([np.zeros(n_features), [start[0]], np.log(np.maximum(np.diff(start), 1e-2))])
    m, v = np.zeros_like(params), np.zeros_like(params)
    for t in range(1, steps + 1):
        w, gap = params[:n_features], np.exp(params[n_features + 1 :])
        theta = params[n_features] + np.concatenate([[0], np.cumsum(gap)])
        score = value * np.bincount(rows, weights=w[columns], minlength=len(x))
        cum = np.concatenate([np.ones((len(x), 1)), _sigmoid(score[:, None] - theta), np.zeros((len(x), 1))], axis=1)
        slope = cum * (1 - cum)
        own = np.maximum(cum[np.arange(len(x)), y] - cum[np.arange(len(x)), y + 1], 1e-12)
        by_score = (slope[np.arange(len(x)), y] - slope[np.arange(len(x)), y + 1]) / own
        by_theta = np.zeros(grades + 1)
        np.add.at(by_theta, y, -slope[np.arange(len(x)), y] / own)
        np.add.at(by_theta, y + 1, slope[np.arange(len(x)), y + 1] / own)
        by_theta = by_theta[1:grades]
        grad = np.concatenate(
            [np.bincount(columns, weights=(by_score * value)[rows], minlength=n_features) - penalty * w, [by_theta.sum()], np.cumsum(by_theta[::-1])[::-1][1:] * gap]
        ) / len(x)
        m, v = 0.9 * m + 0.1 * grad, 0.98 * v + 0.02 * grad**2
        params = params + 0.1 * (1 - (t - 1) / steps) * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.98**t)) + 1e-8)
    gap = np.exp(params[n_features + 1 :])
    return params[:n_features], params[n_features] + np.concatenate([[0], np.cumsum(gap)])


def fit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", grade_col: str = "grade",
    sample_rows: int = SAMPLE_ROWS, bits: int = 20, chance: float = 0.01, least_rate: float = 12.0, penalty: float = 0.01, steps: int = 800
) -> OrdinalModel | None:
    """Learns severity grades, 0 for harmless texts and up, from at most ``sample_rows`` labelled documents, a fixed choice by the hash of their ids.

    Of several labels of one id the largest counts, of several texts the one that sorts first; rows with a null id or grade don't count. The tasks get the
    sample's ids, the driver a count for each hashed feature and the marks of each text of the sample. Grades that the sample lacks have no threshold.
    None if there is no labelled text, or none of either kind.
    """
    spark = docs.sparkSession
    ship(spark)
    own = labels.where(F.col(grade_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.max(F.col(grade_col).cast("int")).alias("label"))
    own = own.orderBy(F.xxhash64("id"), "id").limit(sample_rows)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(own), "id")
    rows = stored(rows.groupBy("id").agg(F.min("text").alias("text"), F.first("label").alias("label")).select("text", "label"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        having, toxic_having = np.zeros(1 << bits, np.int64), np.zeros(1 << bits, np.int64)
        docs = np.zeros(2, np.int64)
        for batch in batches:
            label = np.asarray(batch.column(1)) > 0
            for first, last, data, offsets in text_blocks(batch.column(0)):
                feature, at = _features(data, offsets, bits)
                text = np.repeat(np.arange(last - first), np.diff(at))
                pair = np.unique(text << bits | feature)
                text, feature = pair >> bits, pair & ((1 << bits) - 1)
                having += np.bincount(feature, minlength=1 << bits)
                toxic_having += np.bincount(feature[label[first:last][text]], minlength=1 << bits)
                docs += [last - first, label[first:last].sum()]
        some = np.flatnonzero(having)
        columns = [np.append(some, -1).astype(np.int32), np.append(having[some], docs[0]), np.append(toxic_having[some], docs[1])]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["feature", "docs", "toxic"])

    counted = rows.mapInArrow(count, "feature int, docs long, toxic long").groupBy("feature").agg(F.sum("docs").alias("docs"), F.sum("toxic").alias("toxic")).toPandas()
    total = counted[counted["feature"] < 0]
    n_docs, n_toxic = (int(total["docs"].sum()), int(total["toxic"].sum()))
    if not 0 < n_toxic < n_docs:
        discard(rows)
        return None
    counted = counted[counted["feature"] >= 0].sort_values("feature")
    chosen = counted["feature"].to_numpy()[_select(n_docs, n_toxic, counted["docs"].to_numpy(float), counted["toxic"].to_numpy(float), chance, least_rate)]
    place = np.full(1 << bits, -1, dtype=np.int32)
    place[chosen] = np.arange(len(chosen))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label = np.asarray(batch.column(1))
            for first, last, data, offsets in text_blocks(batch.column(0)):
                feature, at = _features(data, offsets, bits)
                own = place[feature]
                out = [np.unique(own[a:b][own[a:b] >= 0]).tobytes() for a, b in zip(at[:-1], at[1:])]
                yield pa.RecordBatch.from_arrays([pa.array(label[first:last], pa.int32()), pa.array(out, pa.binary())], names=["label", "features"])

    found = rows.mapInArrow(find, "label int, features binary").toPandas().sort_values(["label", "features"])
    discard(rows)
    known = np.unique(np.maximum(found["label"].to_numpy(), 0))
    grade = np.searchsorted(known, np.maximum(found["label"].to_numpy(), 0))
    weights, thresholds = _ordinal([np.frombuffer(f, dtype=np.int32) for f in found["features"]], grade, len(chosen), len(known), penalty, steps)
    return OrdinalModel(bits, place, weights, thresholds)


def graded(labels: DataFrame, toxic_col: str = "toxic", quality_col: str = "quality") -> DataFrame:
    """The labels with a grade: 0 for texts that aren't toxic, 1 for toxic ones, 2 for toxic ones that are of bad quality as well; null if toxic is null."""
    worse = F.when(F.col(quality_col) == 0, 1).otherwise(0)
    return labels.drop("grade").withColumn("grade", F.when(F.col(toxic_col) > 0, 1 + worse).when(F.col(toxic_col).isNotNull(), 0))


def score(docs: DataFrame, model: OrdinalModel | None, text_col: str = "text", least: float = 0.5) -> DataFrame:
    """The rows with p_toxic (of a grade above 0), severity (the expected grade), grade (the likeliest) and toxic.

    Input columns of these names are replaced. A null text counts as empty. Without a model nothing is toxic.
    """
    spark = docs.sparkSession
    names = ["p_toxic", "severity", "grade", "toxic"]
    docs = docs.drop(*names)
    if model is None:
        return docs.withColumns({"p_toxic": F.lit(0.0), "severity": F.lit(0.0), "grade": F.lit(0), "toxic": F.lit(False)})
    ship(spark)
    shared = spark.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [shared.value.at_least(data, offsets) for _, _, data, offsets in text_blocks(batch.column(at))]
            p = np.concatenate(parts) if parts else np.zeros((0, len(model_shape)))
            each = np.concatenate([np.ones((len(p), 1)), p], axis=1) - np.concatenate([p, np.zeros((len(p), 1))], axis=1)
            new = [pa.array(p[:, 0]), pa.array(p.sum(axis=1)), pa.array(each.argmax(axis=1).astype(np.int32)), pa.array(p[:, 0] >= least)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], names=[*batch.schema.names, *names])

    model_shape = model.thresholds
    kinds = [T.DoubleType(), T.DoubleType(), T.IntegerType(), T.BooleanType()]
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *(T.StructField(n, k) for n, k in zip(names, kinds))]))
