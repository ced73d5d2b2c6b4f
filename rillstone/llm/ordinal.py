"""Quality classifier: ordinal cumulative-link regression of graded ratings on hashed text features.

P(grade <= k) = 1 / (1 + exp(weights . features - threshold_k)) with one weight vector for all grades
and ordered thresholds. From it follow the expected grade and the tail probability P(grade >= k) by
which documents are selected.

Features of a text: the share of its lower-cased words in each of ``2**BITS`` hash buckets, and the
bins of a few measures of its style (shares of capitals, symbols, digits and bars, repeated and
distinct words, word length, line length, number of words).

The fit uses at most ``train_rows`` rated rows, those with the smallest hashes of their ids, and
runs on the driver; their features are made in Spark. Everything else covers all rows. Null and
empty texts have only style bins and get a score like any other; rows with a null id are scored and
never learned from; without any rating all scores are those of a single grade. An id that is rated
twice counts with its lower grade.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillstone.llm import arrays
from rillstone.llm.common import read

BITS = 15
TRAIN_ROWS = 4000
#: A document is kept if P(grade >= 1) is at least this.
KEEP_FROM = 0.35

_UPPER = np.zeros(256, bool)
_UPPER[0x41:0x5B] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[0x30:0x3A] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[*b"!#$%&*+/<=>@\\^_`{|}~"]] = True
_BAR = np.zeros(256, bool)
_BAR[[*b"|"]] = True
_LINE = np.zeros(256, bool)
_LINE[0x0A] = True
#: Upper ends of the bins of each measure.
SHARES = np.array([0.0, 0.002, 0.01, 0.03, 0.06, 0.1, 0.2, 0.35, 0.5, 0.65, 0.8])
SIZES = np.array([0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 16, 32, 64, 128, 256, 512, 1024, 4096])
BINS = len(SIZES) + 1
MEASURES = 9
FEATURES = (1 << BITS) + MEASURES * BINS


def style_bins(raw: np.ndarray, offsets: np.ndarray, words: arrays.Words) -> np.ndarray:
    """Feature numbers of the style measures, one column per measure."""
    rows = len(offsets) - 1
    size = np.maximum(np.diff(offsets), 1)

    def share(kind: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(kind[raw])])
        return (sums[offsets[1:]] - sums[offsets[:-1]]) / size

    n = np.maximum(words.counts, 1)
    again = np.zeros(len(words.hash), bool)
    again[1:] = (words.hash[1:] == words.hash[:-1]) & (words.doc[1:] == words.doc[:-1])
    order = np.lexsort((words.hash, words.doc))
    h, doc = words.hash[order], words.doc[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    distinct = np.bincount(doc[new], minlength=rows) / n
    length = np.bincount(words.doc, weights=words.end - words.start, minlength=rows) / n
    lines = share(_LINE) * size + 1
    shares = [share(_UPPER), share(_SYMBOL), share(_DIGIT), share(_BAR), np.bincount(words.doc[again], minlength=rows) / n, 1 - distinct]
    columns = [np.searchsorted(SHARES, x) for x in shares]
    columns += [np.searchsorted(SIZES, x) for x in (length, words.counts, words.counts / lines)]
    return np.stack([(1 << BITS) + k * BINS + c for k, c in enumerate(columns)], 1)


def _features(texts: pa.Array) -> Iterator[tuple[arrays.Words, np.ndarray, np.ndarray]]:
    """Per chunk of rows: words, the bucket of each word, style features of each row."""
    offsets, data = arrays.text_buffer(texts)
    for a, b in arrays.row_chunks(offsets):
        raw, cuts = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        words = arrays.words_of(raw, cuts, lower=True)
        yield words, (words.hash >> np.uint64(64 - BITS)).astype(np.int64), style_bins(raw, cuts, words)


@dataclass
class CumulativeLink:
    weights: np.ndarray
    thresholds: np.ndarray

    def at_least(self, position: np.ndarray) -> np.ndarray:
        """P(grade >= k) of each row for k = 1 .. number of thresholds."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - position[:, None], -60, 60)))


def fit(row: np.ndarray, feature: np.ndarray, value: np.ndarray, grade: np.ndarray, features: int = FEATURES, steps: int = 150, rate: float = 0.1, ridge: float = 1e-4) -> CumulativeLink:
    """Maximum likelihood with a ridge, by Adam over all rows. Thresholds are kept ordered as a first
    one and logarithms of the gaps to the next."""
    rows, top = len(grade), int(grade.max(initial=0))
    if not rows or not top:
        return CumulativeLink(np.zeros(features), np.full(top, -60.0))
    share = np.clip([(grade >= k).mean() for k in range(1, top + 1)], 1e-3, 1 - 1e-3)
    first = np.log((1 - share) / share)
    gaps = np.log(np.maximum(np.diff(first), 1e-2))
    state = np.concatenate([np.zeros(features), first[:1], gaps])
    mean, square = np.zeros_like(state), np.zeros_like(state)
    for step in range(1, steps + 1):
        weights = state[:features]
        thresholds = state[features] + np.concatenate([[0], np.cumsum(np.exp(state[features + 1 :]))])
        position = np.bincount(row, weights=weights[feature] * value, minlength=rows)
        tail = np.concatenate([np.ones((rows, 1)), CumulativeLink(weights, thresholds).at_least(position), np.zeros((rows, 1))], 1)
        upper, lower = tail[np.arange(rows), grade], tail[np.arange(rows), grade + 1]
        p = np.maximum(upper - lower, 1e-12)
        slope_u, slope_l = upper * (1 - upper), lower * (1 - lower)
        pull = -(slope_u - slope_l) / p / rows
        at = np.zeros(top + 2)
        np.add.at(at, grade, slope_u / p / rows)
        np.add.at(at, grade + 1, -slope_l / p / rows)
        by_threshold = at[1 : top + 1]
        by_gap = np.cumsum(by_threshold[::-1])[::-1][1:] * np.exp(state[features + 1 :])
        gradient = np.concatenate([np.bincount(feature, weights=pull[row] * value, minlength=features) + ridge * weights, [by_threshold.sum()], by_gap])
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.999 * square + 0.001 * gradient**2
        state = state - rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    thresholds = state[features] + np.concatenate([[0], np.cumsum(np.exp(state[features + 1 :]))])
    return CumulativeLink(state[:features], thresholds)


def train(docs: DataFrame, ratings: DataFrame, grade_column: str, id_column: str = "doc_id", text_column: str = "text", train_rows: int = TRAIN_ROWS) -> CumulativeLink:
    """Fit on the rated rows with the ``train_rows`` smallest id hashes."""
    rated = ratings.select(ratings[id_column].alias("id"), ratings[grade_column].cast("int").alias("grade")).where("id IS NOT NULL AND grade >= 0")
    rated = rated.groupBy("id").agg(F.min("grade").alias("grade")).orderBy(F.xxhash64("id"), "id").limit(train_rows)
    sample = docs.select(docs[id_column].alias("id"), docs[text_column].cast("string").alias("text")).join(F.broadcast(rated), "id").select("grade", "text")

    def featurize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists, values, done = [], [], 0
            for words, bucket, style in _features(batch.column(1)):
                for k in range(len(style)):
                    own, count = np.unique(bucket[words.first[k] : words.first[k + 1]], return_counts=True)
                    lists.append(np.concatenate([own, style[k]]))
                    values.append(np.concatenate([_scaled(count, count.sum()), np.ones(style.shape[1])]))
                done += len(style)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lists, pa.list_(pa.int64())), pa.array(values, pa.list_(pa.float64()))], ["grade", "features", "amounts"])

    found = sample.mapInArrow(featurize, "grade int, features array<long>, amounts array<double>").toArrow().combine_chunks()
    if not found.num_rows:
        return fit(*(np.zeros(0, np.int64) for _ in range(4)))
    lists = found["features"].combine_chunks()
    row = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy())
    return fit(row, lists.flatten().to_numpy(), found["amounts"].combine_chunks().flatten().to_numpy(), found["grade"].to_numpy().astype(np.int64))


def _scaled(count, total):
    """Weight of a word bucket: its share of the text, as much as five style measures in all."""
    return 5.0 * count / np.maximum(total, 1)


def graded(docs: DataFrame, model: CumulativeLink, text_column: str = "text", keep_from: float = KEEP_FROM) -> DataFrame:
    """``row`` (all columns of docs), expected_grade, tail_probability (of grade 1 or more), accepted."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            expected, tail = [np.zeros(0)], [np.zeros(0)]
            for words, bucket, style in _features(batch.column(0).field(text_column)):
                sums = np.bincount(words.doc, weights=known.weights[bucket], minlength=len(style))
                position = _scaled(sums, words.counts) + known.weights[style].sum(1)
                at_least = known.at_least(position)
                expected.append(at_least.sum(1))
                tail.append(at_least[:, 0] if at_least.shape[1] else np.ones(len(style)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate(expected)), pa.array(np.concatenate(tail))], ["row", "expected_grade", "tail_probability"])

    found = docs.select(F.struct("*").alias("row")).mapInArrow(score, f"row {docs.schema.simpleString()}, expected_grade double, tail_probability double")
    return found.withColumn("accepted", F.col("tail_probability") >= keep_from)


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document: expected quality grade, probability of grade 1, whether it is accepted."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, read(spark, sf_dir, "labels"), "quality")
    return graded(docs, model).select("row.doc_id", "expected_grade", "tail_probability", "accepted")
