"""Toxicity by the nearest labelled examples: exact TF-IDF cosine over block-max inverted indexes.

Labelled examples (at most ``per_label`` of each label, those with the smallest hashes of their
ids) are the index. Terms are words and their beginnings of 4 to 8 bytes, so that inflected forms
share a term; among them all terms whose rate in toxic examples is ``LEAST_RATIO`` times that in the
others, and that pass a chi-square test, are kept. Both use rates within a label, weighted by the
label's share in all labels, so the balance of the examples does not matter; idf counts the
documents of the whole table. Neutral terms are no part of a vector: the cosine compares the
vocabulary of toxic texts. A text is a vector of sqrt(percent of its words) * idf over these terms and one
component for its background, which every text has, so that lone chance words weigh little.

Examples lie in blocks of similar ones. For each term a block has the largest weight of its
examples; their products with a text's weights bound the cosine of the whole block, and blocks
that cannot reach the ``NEIGHBOURS`` best so far are never opened: the neighbours are exact. Their
votes are weighted by distance, and a logistic curve fitted to the examples' own votes (each
without itself, weighted by the label's share in all labels) turns them into probabilities.

Labels, language, source and id are no inputs of a score. Null and empty texts are the background
alone. Without examples of both labels every score is the share of toxic labels (0 without any).
Rows with a null id are scored; labels without an id are not used; an id labelled twice counts as
toxic if either says so.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rillstone.llm import arrays
from rillstone.llm.common import crc_remainder, read

PER_LABEL = 2000
LEAST_CHI2 = 16.0
#: Least rate of a term in toxic examples, as a multiple of its rate in the others.
LEAST_RATIO = 3.0
PREFIXES = range(4, 9)
NEIGHBOURS = 15
BLOCK = 64
EVIDENCE = 3
PREDICT_FROM = 0.3
BACKGROUND = 1.5
#: Two cosines closer than this are ties, broken by the example's number.
TIE = 1e-9


def terms_of(words: arrays.Words) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(hash, row) of all words and of the beginnings of longer words."""
    yield words.hash, words.doc
    data = np.append(words.data, np.zeros(16, np.uint8))
    for size in PREFIXES:
        longer = np.flatnonzero((words.end - words.start > size) & ((data[words.start + size] & 0xC0) != 0x80))
        start = words.start[longer]
        yield arrays.segment_hashes(words.data, start, start + size) ^ np.uint64(size), words.doc[longer]


def _term_rows(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """Per chunk: first row, rows, hash and row of each term, and the words of each row."""
    for a, b, words in arrays.batch_words(texts, arrays.ALNUM, lower=True):
        found = list(terms_of(words))
        yield a, b - a, np.concatenate([h for h, _ in found]), np.concatenate([r for _, r in found]), words.counts


@dataclass
class Vectors:
    """Sparse rows of unit length: term numbers and weights; term 0 is the background."""

    first: np.ndarray
    term: np.ndarray
    weight: np.ndarray


def vectors(h: np.ndarray, row: np.ndarray, words: np.ndarray, vocabulary: np.ndarray, idf: np.ndarray) -> Vectors:
    rows = len(words)
    if len(vocabulary):
        at = np.minimum(np.searchsorted(vocabulary, h), len(vocabulary) - 1)
        keep = vocabulary[at] == h
        key, count = np.unique(row[keep] * len(vocabulary) + at[keep], return_counts=True)
        row, term = key // len(vocabulary), key % len(vocabulary) + 1
        weight = np.sqrt(100.0 * count / np.maximum(words[row], 1)) * idf[term - 1]
    else:
        row, term, weight = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    row, term, weight = np.concatenate([np.arange(rows), row]), np.concatenate([np.zeros(rows, np.int64), term]), np.concatenate([np.full(rows, BACKGROUND), weight])
    order = np.lexsort((term, row))
    row, term, weight = row[order], term[order], weight[order]
    weight = weight / np.sqrt(np.bincount(row, weights=weight**2, minlength=rows))[row]
    return Vectors(np.concatenate([[0], np.cumsum(np.bincount(row, minlength=rows))]), term, weight)


class BlockMax:
    """Inverted lists of the examples by term and block, with each block's largest weight."""

    def __init__(self, found: Vectors, terms: int):
        rows = len(found.first) - 1
        self.rows, self.blocks = rows, -(-rows // BLOCK)
        row = np.repeat(np.arange(rows), np.diff(found.first))
        order = np.lexsort((row, found.term))
        term, self.row, self.weight = found.term[order], row[order], found.weight[order]
        key = term * self.blocks + self.row // BLOCK
        self.first = np.searchsorted(key, np.arange(terms * self.blocks + 1)).reshape(-1)
        self.most = np.zeros(terms * self.blocks)
        np.maximum.at(self.most, key, self.weight)
        self.most = self.most.reshape(terms, self.blocks)

    def nearest(self, term: np.ndarray, weight: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The k examples of largest cosine, ties to the smaller number, and their cosines."""
        bound = weight @ self.most[term]
        order = np.argsort(-bound, kind="stable")
        bound = bound[order]
        scores = np.full(self.blocks * BLOCK, -1.0)
        k = min(k, self.rows)
        best, done, step = -1.0, 0, max(2, -(-k // BLOCK))
        while done < self.blocks and bound[done] >= best - TIE:
            upto = min(done + step, int(np.searchsorted(-bound, -(best - TIE), "right")))
            opened = order[done:upto]
            # The lists of all terms in all opened blocks, one after the other.
            at = (term[:, None] * self.blocks + opened[None, :]).ravel()
            lengths = self.first[at + 1] - self.first[at]
            places = arrays.ragged(self.first[at], lengths)
            part = np.repeat(np.tile(np.arange(len(opened)), len(term)), lengths)
            amount = self.weight[places] * np.repeat(np.repeat(weight, len(opened)), lengths)
            sums = np.bincount(part * BLOCK + self.row[places] % BLOCK, weights=amount, minlength=len(opened) * BLOCK)
            scores.reshape(-1, BLOCK)[opened] = sums.reshape(-1, BLOCK)
            done, step = upto, step * 2
            best = np.partition(scores[: self.rows], -k)[-k]
        near = _top(np.round(scores[: self.rows], 9), k)
        return near, scores[near]


def _top(scores: np.ndarray, k: int) -> np.ndarray:
    least = np.partition(scores, -k)[-k]
    some = np.flatnonzero(scores >= least)
    return some[np.lexsort((some, -scores[some]))][:k]


@dataclass
class Toxicity:
    vocabulary: np.ndarray
    idf: np.ndarray
    index: BlockMax | None
    toxic: np.ndarray
    ids: list[int]
    slope: float = 0.0
    middle: float = 0.0
    share: float = 0.0

    def vote(self, near: np.ndarray, cosine: np.ndarray) -> float:
        weight = 1 / (1.02 - cosine)
        return float((weight * self.toxic[near]).sum() / weight.sum())

    def calibrated(self, vote: np.ndarray) -> np.ndarray:
        if self.index is None:
            return np.full(len(vote), self.share)
        return 1 / (1 + np.exp(-self.slope * (vote - self.middle)))


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and middle of a weighted logistic curve, by Newton steps with a small ridge."""
    a, b = 4.0, -2.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -40, 40)))
        g = np.array([(weight * (p - y) * x).sum() + 1e-3 * a, (weight * (p - y)).sum()])
        v = weight * p * (1 - p)
        hessian = np.array([[(v * x * x).sum() + 1e-3, (v * x).sum()], [(v * x).sum(), v.sum() + 1e-6]])
        step = np.clip(np.linalg.solve(hessian, g), -2, 2)
        a, b = a - step[0], b - step[1]
    a = max(a, 1e-3)
    return a, -b / a


def chi_square(toxic_rate: Column, other_rate: Column, share: float, rows: int) -> Column:
    """Of a term and the label, in ``rows`` texts of which ``share`` are toxic."""
    rate = share * toxic_rate + (1 - share) * other_rate
    return rows * share * (1 - share) * (toxic_rate - other_rate) ** 2 / (rate * (1 - rate) + 1e-12)


def inverse_frequencies(texts: DataFrame, vocabulary: np.ndarray) -> np.ndarray:
    """idf of each term over all rows of ``texts`` (text). A task sends one row per term it met."""
    if not len(vocabulary):
        return np.zeros(0)
    shared = texts.sparkSession.sparkContext.broadcast(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, total, met = shared.value, 0, np.zeros(len(shared.value), np.int64)
        for batch in batches:
            total += batch.num_rows
            for _, _, h, row, _ in _term_rows(batch.column(0)):
                at = np.minimum(np.searchsorted(known, h), len(known) - 1)
                keep = known[at] == h
                met += np.bincount(np.unique(row[keep] * len(known) + at[keep]) % len(known), minlength=len(known))
        some = np.flatnonzero(met)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(some, -1)), pa.array(np.append(met[some], total))], ["term", "n"])

    found = {r["term"]: r["n"] for r in texts.mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()}
    return np.log((found[-1] + 1) / (np.array([found.get(k, 0) for k in range(len(vocabulary))], float) + 1)) + 1


def train(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "toxic", per_label: int = PER_LABEL) -> Toxicity:
    spark = docs.sparkSession
    known = labels.select(labels[id_column].alias("id"), labels[label_column].cast("int").alias("toxic")).where("id IS NOT NULL AND toxic IS NOT NULL").groupBy("id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    totals = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    share = totals.get(1, 0) / max(1, sum(totals.values()))
    if len(totals) < 2:
        return Toxicity(np.zeros(0, np.uint64), np.zeros(0), None, np.zeros(0), [], share=share)
    picked = [known.where(F.col("toxic") == k).orderBy(F.xxhash64("id"), "id").limit(per_label) for k in (0, 1)]
    sample = docs.select(docs[id_column].alias("id"), docs[text_column].cast("string").alias("text")).join(F.broadcast(picked[0].union(picked[1])), "id")

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic = batch.column(0).to_numpy()
            for a, rows, h, row, _ in _term_rows(batch.column(1)):
                order = np.lexsort((h, row))
                h, row = h[order], row[order]
                new = np.ones(len(h), bool)
                new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
                yield pa.RecordBatch.from_arrays([pa.array(h[new].view(np.int64)), pa.array(toxic[row[new] + a].astype(np.int64))], ["term", "toxic"])

    frequency = sample.select("toxic", "text").mapInArrow(spread, "term long, toxic long").groupBy("term").agg(F.count("*").alias("n"), F.sum("toxic").alias("t")).where("n >= 4")
    by_label = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    toxic_rows, rows = by_label.get(1, 0), sum(by_label.values())
    if not toxic_rows or toxic_rows == rows:
        return Toxicity(np.zeros(0, np.uint64), np.zeros(0), None, np.zeros(0), [], share=share)
    toxic_rate, other_rate = F.col("t") / toxic_rows, (F.col("n") - F.col("t")) / (rows - toxic_rows)
    best = frequency.where((toxic_rate >= LEAST_RATIO * other_rate) & (chi_square(toxic_rate, other_rate, share, rows) >= LEAST_CHI2)).select("term").collect()
    vocabulary = np.sort(np.array([r["term"] for r in best], np.int64).view(np.uint64))
    idf = inverse_frequencies(docs.select(docs[text_column].cast("string").alias("text")), vocabulary)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms, weights = [], []
            for _, n, h, row, words in _term_rows(batch.column(2)):
                v = vectors(h, row, words, vocabulary, idf)
                terms += [v.term[v.first[k] : v.first[k + 1]] for k in range(n)]
                weights += [v.weight[v.first[k] : v.first[k + 1]] for k in range(n)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(terms, pa.list_(pa.int64())), pa.array(weights, pa.list_(pa.float64()))], ["id", "toxic", "terms", "weights"])

    found = sample.select("id", "toxic", "text").mapInArrow(weigh, "id long, toxic int, terms array<long>, weights array<double>").collect()
    # Like with like in a block: by strongest term, then its weight.
    found.sort(key=lambda r: (r["toxic"], max(zip(r["weights"], r["terms"], strict=True))[1], max(r["weights"]), r["id"]))
    sizes = [len(r["terms"]) for r in found]
    examples = Vectors(np.concatenate([[0], np.cumsum(sizes)]), np.concatenate([r["terms"] for r in found]).astype(np.int64), np.concatenate([r["weights"] for r in found]))
    model = Toxicity(vocabulary, idf, BlockMax(examples, len(vocabulary) + 1), np.array([float(r["toxic"]) for r in found]), [r["id"] for r in found], share=share)
    votes = np.empty(len(found))
    for k in range(len(found)):
        own = slice(examples.first[k], examples.first[k + 1])
        near, cosine = model.index.nearest(examples.term[own], examples.weight[own], NEIGHBOURS + 1)
        other = near != k
        other[np.flatnonzero(other)[NEIGHBOURS:]] = False
        votes[k] = model.vote(near[other], cosine[other]) if other.any() else model.toxic.mean()
    y = model.toxic
    weight = np.where(y > 0, share / max(y.sum(), 1), (1 - share) / max((1 - y).sum(), 1)) * len(y)
    model.slope, model.middle = _logistic(votes, y, weight)
    return model


def scored(docs: DataFrame, model: Toxicity, text_column: str = "text") -> DataFrame:
    """``row`` (all columns of docs), score, and ``evidence``: the nearest examples."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = pa.struct([("example", pa.int64()), ("cosine", pa.float64()), ("toxic", pa.int32())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, seen = shared.value, {}
        for batch in batches:
            votes, evidence = [], []
            for _, n, h, row, words in _term_rows(batch.column(0).field(text_column)):
                v = vectors(h, row, words, known.vocabulary, known.idf)
                for k in range(n):
                    term, weight = v.term[v.first[k] : v.first[k + 1]], v.weight[v.first[k] : v.first[k + 1]]
                    if known.index is None:
                        result = 0.0, []
                    elif len(term) == 1 and "none" in seen:
                        result = seen["none"]
                    else:
                        near, cosine = known.index.nearest(term, weight, NEIGHBOURS)
                        result = known.vote(near, cosine), [{"example": known.ids[i], "cosine": c, "toxic": int(known.toxic[i])} for i, c in zip(near[:EVIDENCE].tolist(), cosine.tolist(), strict=False)]
                        if len(term) == 1:
                            seen["none"] = result
                    votes.append(result[0])
                    evidence.append(result[1])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(known.calibrated(np.array(votes, float))), pa.array(evidence, pa.list_(kind))], ["row", "score", "evidence"])

    rows = docs.select(F.struct("*").alias("row"))
    return rows.mapInArrow(score, f"row {docs.schema.simpleString()}, score double, evidence array<struct<example:bigint,cosine:double,toxic:int>>")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document: whether its label was held out, its toxicity and the label it predicts."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read(spark, sf_dir, "labels")
    model = train(docs, labels.where(crc_remainder("doc_id", 4) != 2))
    found = scored(docs, model).select("row.doc_id", "score", "evidence")
    return found.select(
        "doc_id",
        F.coalesce(crc_remainder("doc_id", 4) == 2, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= PREDICT_FROM).cast("int").alias("predicted"),
        "evidence",
    )
