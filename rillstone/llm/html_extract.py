"""HTML extraction: a linear-chain conditional random field over the leaf blocks of a page.

A page is cut into leaf blocks (:mod:`rillstone.llm.html_blocks`). Features of a block are its
ancestors' tags and the words of their ids and classes, hashed, and bins of text measures: length,
share of characters in links, punctuation, place on the page. The field has two labels, main text
and other, weights for label and feature, and for pairs of neighbouring labels; it is trained on
labelled pages (:mod:`rillstone.llm.html_training`) by gradient ascent on the likelihood, computed
by forward-backward, and pages are decoded by Viterbi. Training needs no table and takes a few
seconds on the driver; pages are decoded where they lie.

A null or empty page and a page without main text give an empty text. Any text is a page: what is
not mark-up is text. Repeated rows, null ids and urls are kept; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from rillstone.llm.common import read
from rillstone.llm.html_blocks import Block, leaf_blocks
from rillstone.llm.html_training import labelled_pages

FEATURES = 1 << 14
LABELS = ("other", "main")
SECTIONS = frozenset("article aside footer form header main nav".split())
_known: dict[str, int] = {}


def _number(name: str) -> int:
    """Bucket of a feature's name. The cache is emptied when pages with ever new names fill it."""
    found = _known.get(name)
    if found is None:
        if len(_known) > 200_000:
            _known.clear()
        found = _known[name] = zlib.crc32(name.encode()) % FEATURES
    return found


def _bin(x: float, ends: tuple[float, ...]) -> int:
    return sum(x > e for e in ends)


def block_features(blocks: list[Block]) -> list[list[int]]:
    longest = max((len(b.text) for b in blocks), default=0)
    rows = []
    paths: dict[tuple, list[int]] = {}
    for k, block in enumerate(blocks):
        own = paths.get(block.path)
        if own is None:
            tags = [t for t, _ in block.path]
            names = [f"tag {t}" for t in dict.fromkeys(tags)]
            names.append(f"last {tags[-1] if tags else ''}")
            for tag, words in block.path:
                names += [f"word {w}" for w in words]
                names += [f"named {tag} {w}" for w in words]
            # The region that speaks last: the nearest ancestors with a name or a section's tag.
            regions = [(t, w) for t, w in block.path if w or t in SECTIONS][-2:]
            for tag, words in regions:
                names += [f"near {tag}", *(f"near {w}" for w in words)]
            names += [f"inner {w}" for _, words in regions[-1:] for w in words]
            own = paths[block.path] = [_number(n) for n in dict.fromkeys(names)]
        size = len(block.text)
        rest = [
            "bias",
            f"size {_bin(size, (10, 25, 50, 100, 200, 400, 800))}",
            f"share {_bin(size / longest, (0.05, 0.2, 0.5, 0.9))}",
            f"linked {_bin(block.linked / size, (0.0, 0.3, 0.7, 0.95))}",
            f"stops {_bin(sum(map(block.text.count, '.,;:')) / size, (0.0, 0.01, 0.03, 0.06))}",
            f"copyright {'©' in block.text}",
            f"first {k == 0}",
            f"final {k == len(blocks) - 1}",
        ]
        rows.append(own + [_number(n) for n in rest])
    return rows


@dataclass
class Field:
    weights: np.ndarray  #: (FEATURES, 2)
    turns: np.ndarray  #: (2, 2) from a label to the next block's

    def scores(self, rows: list[list[int]]) -> np.ndarray:
        return np.array([self.weights[r].sum(0) for r in rows])

    def viterbi(self, scores: np.ndarray) -> np.ndarray:
        """The likeliest labels of a sequence of blocks."""
        best, back = scores[0], np.zeros(scores.shape, np.int64)
        for t in range(1, len(scores)):
            via = best[:, None] + self.turns
            back[t] = via.argmax(0)
            best = via.max(0) + scores[t]
        labels = np.empty(len(scores), np.int64)
        labels[-1] = best.argmax()
        for t in range(len(scores) - 1, 0, -1):
            labels[t - 1] = back[t, labels[t]]
        return labels

    def labels(self, blocks: list[Block]) -> np.ndarray:
        return self.viterbi(self.scores(block_features(blocks))) if blocks else np.zeros(0, np.int64)


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis)
    return top + np.log(np.exp(x - np.expand_dims(top, axis)).sum(axis))


def train(pages: list[tuple[str, list[str]]], epochs: int = 9, rate: float = 0.2, ridge: float = 1e-4) -> Field:
    """Adaptive gradient ascent, page by page, on the penalised log-likelihood; the weights after
    each later epoch are averaged."""
    sequences = []
    for page, labels in pages:
        blocks = leaf_blocks(page)
        if len(blocks) != len(labels):
            raise ValueError(f"{len(labels)} labels for {len(blocks)} blocks")
        if blocks:
            sequences.append((block_features(blocks), np.array([LABELS.index(x) for x in labels])))
    field = Field(np.zeros((FEATURES, 2)), np.zeros((2, 2)))
    square, turn_square = np.full((FEATURES, 2), 1e-2), np.full((2, 2), 1e-2)
    order, kept = np.random.default_rng(3), []
    for epoch in range(epochs):
        for place in order.permutation(len(sequences)):
            rows, gold = sequences[place]
            scores, n = field.scores(rows), len(rows)
            forward, backward = scores.copy(), np.zeros((n, 2))
            for t in range(1, n):
                forward[t] += _log_sum(forward[t - 1][:, None] + field.turns, 0)
            for t in range(n - 2, -1, -1):
                backward[t] = _log_sum(field.turns + (scores[t + 1] + backward[t + 1])[None, :], 1)
            total = _log_sum(forward[-1], 0)
            slope = -np.exp(forward + backward - total)
            slope[np.arange(n), gold] += 1
            turn = -ridge * field.turns
            for t in range(1, n):
                turn[gold[t - 1], gold[t]] += 1
                turn -= np.exp(forward[t - 1][:, None] + field.turns + (scores[t] + backward[t])[None, :] - total)
            flat = np.concatenate([np.array(r) for r in rows])
            places, inverse = np.unique(flat, return_inverse=True)
            gradient = np.zeros((len(places), 2))
            np.add.at(gradient, inverse, np.repeat(slope, [len(r) for r in rows], axis=0))
            gradient -= ridge * field.weights[places]
            square[places] += gradient**2
            field.weights[places] += rate * gradient / np.sqrt(square[places])
            turn_square += turn**2
            field.turns += rate * turn / np.sqrt(turn_square)
        if epoch >= epochs // 3:
            kept.append((field.weights.copy(), field.turns.copy()))
    return Field(sum(w for w, _ in kept) / len(kept), sum(t for _, t in kept) / len(kept))


def main_text(page: str | None, field: Field) -> str:
    blocks = leaf_blocks(page) if page else []
    return " ".join(b.text for b, label in zip(blocks, field.labels(blocks), strict=True) if label)


def extract(pages: DataFrame, field: Field, id_column: str = "page_id", url_column: str = "url", html_column: str = "html") -> DataFrame:
    """id, url, text of every page."""
    shared = pages.sparkSession.sparkContext.broadcast(field)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x.as_py(), shared.value) for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], ["id", "url", "text", "n_chars"])

    kind = pages.schema[id_column].dataType.simpleString()
    rows = pages.select(pages[id_column].alias("id"), pages[url_column].cast("string").alias("url"), pages[html_column].cast("string").alias("html"))
    return rows.mapInArrow(decode, f"id {kind}, url string, text string, n_chars long").withColumnsRenamed({"id": id_column, "url": url_column})


def op2_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return extract(read(spark, sf_dir, "pages"), train(labelled_pages()))
