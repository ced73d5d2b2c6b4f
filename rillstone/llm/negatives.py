"""Hard negatives of anchors, by exact integer inner products.

Vectors become whole numbers, floor(256 * x), and every anchor meets every row once in two rounds of
tiles: anchors by candidates. A tile's products come from Strassen's recursion on int64 matrices
(padded with a zero row or column where a side is odd), whose sums and differences are exact.
The first round keeps each anchor's best rows of its own label, the second the best rows of other
labels in a window below each of these.

Anchors form blocks of at most ``ANCHORS`` rows, candidates regions of at most ``REGION`` rows, dealt by
a hash of row and id. One task takes one region and one block, tile after tile, and keeps a bounded
heap for each anchor (and window): arrays of the best rows so far, which merge with those of the
next tile. The heaps of all regions merge in a limited window. So a task holds a block, a region and a tile;
hot labels are spread like all others.

Defined cases: rows with a null label, id or vector, or with a null or non-finite component, take no part.
Rows that agree in id, label and vector are one row; rows of one id that differ are rows of their own, and a
row of the anchor's own id is never its positive or negative. Shorter vectors count as filled up
with zeros. Scores are 64-bit integers: beyond them they wrap around, as the integers of a long do. No
anchor, no positive or no row in a window gives no row.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rillstone.llm.common import read, stored

ANCHORS = 4096
REGION = 65536
#: Rows of a tile on its two sides.
TILE = (512, 2048)
#: Strassen's recursion ends where a side is this short.
LEAF = 32
LOWEST = np.iinfo(np.int64).min

FOUND = "anchor_id long, anchor_twin long, slot int, other_id long, other_twin long, score long"


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """The product of two int64 matrices by seven products of quarters at every level."""
    (m, k), n = a.shape, b.shape[1]
    if min(m, k, n) <= leaf:
        return a @ b
    if m % 2 or k % 2 or n % 2:
        a = np.pad(a, ((0, m % 2), (0, k % 2)))
        b = np.pad(b, ((0, k % 2), (0, n % 2)))
    p, q, r = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:p, :q], a[:p, q:], a[p:, :q], a[p:, q:]
    b11, b12, b21, b22 = b[:q, :r], b[:q, r:], b[q:, :r], b[q:, r:]
    m1 = strassen(a11 + a22, b11 + b22, leaf)
    m2 = strassen(a21 + a22, b11, leaf)
    m3 = strassen(a11, b12 - b22, leaf)
    m4 = strassen(a22, b21 - b11, leaf)
    m5 = strassen(a11 + a12, b22, leaf)
    m6 = strassen(a21 - a11, b11 + b12, leaf)
    m7 = strassen(a12 - a22, b21 + b22, leaf)
    out = np.empty((2 * p, 2 * r), np.int64)
    out[:p, :r] = m1 + m4 - m5 + m7
    out[:p, r:] = m3 + m5
    out[p:, :r] = m2 + m4
    out[p:, r:] = m1 - m2 + m3 + m6
    return out[:m, :n]


def whole(vectors: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    """floor(256 * x) of every component as int64, shorter vectors filled up with zeros. Numbers
    beyond 64 bits become the nearest such integer."""
    flat = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    lengths = np.diff(flat.offsets.to_numpy())
    values = np.floor(256.0 * flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    top = float(1 << 63)
    numbers = np.where(values >= top, np.iinfo(np.int64).max, np.where(values < -top, LOWEST, values.clip(-top, np.nextafter(top, 0)).astype(np.int64)))
    out = np.zeros((len(lengths), width), np.int64)
    out[np.arange(width) < lengths[:, None]] = numbers
    return out


class Heaps:
    """The best ``most`` rows for each of a number of owners: highest score first, then least id.

    Rows come for owners in any number and order. The result does not depend on how they are divided over
    calls of ``add``, so heaps of different tiles and tasks can be merged too. Rows wait until they are as
    many as those kept, and are then merged at once.
    """

    def __init__(self, most: int) -> None:
        self.most = most
        self.kept = [np.zeros(0, np.int64)] * 4
        self.waiting: list[list[np.ndarray]] = []
        self.n_waiting = 0

    def add(self, owner: np.ndarray, score: np.ndarray, ids: np.ndarray, twins: np.ndarray) -> None:
        self.waiting.append([owner, score, ids, twins])
        self.n_waiting += len(owner)
        if self.n_waiting > max(65536, len(self.kept[0])):
            self.merge()

    def merge(self) -> None:
        owner, score, ids, twins = (np.concatenate(x) for x in zip(self.kept, *self.waiting, strict=True))
        # Descending order of the score without negating it: the least integer has no opposite.
        order = np.lexsort((twins, ids, ~score, owner))
        best = order[_place_in_group(owner[order]) < self.most]
        self.kept = [owner[best], score[best], ids[best], twins[best]]
        self.waiting, self.n_waiting = [], 0

    def rows(self) -> list[np.ndarray]:
        """Owners, scores, ids and twins, in order."""
        self.merge()
        return self.kept


def _place_in_group(groups: np.ndarray) -> np.ndarray:
    """0, 1, ... within each run of equal values."""
    at = np.arange(len(groups))
    begins = np.ones(len(groups), bool)
    begins[1:] = groups[1:] != groups[:-1]
    return at - np.maximum.accumulate(np.where(begins, at, 0)) if len(groups) else at


class Rows:
    """One side of a task: ids, twins, labels and vectors, sorted by id."""

    def __init__(self, table: pa.Table, width: int) -> None:
        order = np.lexsort((table["twin"].to_numpy(), table["vec_id"].to_numpy()))
        self.table = table.take(pa.array(order))
        self.id = self.table["vec_id"].to_numpy()
        self.twin = self.table["twin"].to_numpy()
        self.label = self.table["label"].to_numpy()
        self.width = width

    def __len__(self) -> int:
        return len(self.id)

    def matrix(self, rows: np.ndarray) -> np.ndarray:
        return whole(self.table["embedding"].take(pa.array(rows)), self.width)


def _tiles(anchors: Rows, candidates: Rows, a_rows: np.ndarray, c_rows: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(anchor rows, candidate rows, their products), tile after tile."""
    left = anchors.matrix(a_rows)
    for c in range(0, len(c_rows), TILE[1]):
        some = c_rows[c : c + TILE[1]]
        right = candidates.matrix(some).T
        for a in range(0, len(a_rows), TILE[0]):
            yield a_rows[a : a + TILE[0]], some, strassen(left[a : a + TILE[0]], right)


def _best_of_tile(scores: np.ndarray, allowed: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the best ``most`` allowed entries of every row; columns are in order of id."""
    ranked = np.argsort(np.where(allowed, ~scores, np.iinfo(np.int64).max), axis=1, kind="stable")[:, :most]
    rows = np.repeat(np.arange(len(scores)), ranked.shape[1])
    columns = ranked.ravel()
    fits = allowed[rows, columns]
    return rows[fits], columns[fits]


def own_label(anchors: Rows, candidates: Rows, most: int) -> Heaps:
    """Each anchor's best other rows of its label."""
    heaps = Heaps(most)
    for label in np.intersect1d(anchors.label, candidates.label):
        a_rows, c_rows = np.flatnonzero(anchors.label == label), np.flatnonzero(candidates.label == label)
        for mine, some, scores in _tiles(anchors, candidates, a_rows, c_rows):
            r, c = _best_of_tile(scores, anchors.id[mine][:, None] != candidates.id[some], most)
            heaps.add(mine[r], scores[r, c], candidates.id[some[c]], candidates.twin[some[c]])
    return heaps


def in_windows(anchors: Rows, candidates: Rows, low: np.ndarray, high: np.ndarray, most: int) -> Heaps:
    """The best rows of other labels with low <= score <= high, for each anchor and window.

    ``low`` and ``high`` have a row for each anchor and a column for each of its windows; an owner is
    anchor * columns + column. A tile is sorted once for all windows.
    """
    heaps, windows = Heaps(most), low.shape[1]
    rows = np.arange(len(anchors))
    for mine, some, scores in _tiles(anchors, candidates, rows, np.arange(len(candidates))):
        allowed = anchors.label[mine][:, None] != candidates.label[some]
        allowed &= anchors.id[mine][:, None] != candidates.id[some]
        ranked = np.argsort(np.where(allowed, ~scores, np.iinfo(np.int64).max), axis=1, kind="stable")
        sorted_scores = np.take_along_axis(scores, ranked, 1)
        sorted_allowed = np.take_along_axis(allowed, ranked, 1)
        for w in range(windows):
            first = (sorted_allowed & (sorted_scores > high[mine, w][:, None])).sum(1)
            at = first[:, None] + np.arange(most)
            inside = at < len(some)
            at = np.minimum(at, len(some) - 1)
            inside &= np.take_along_axis(sorted_allowed, at, 1)
            found = np.take_along_axis(sorted_scores, at, 1)
            inside &= (found >= low[mine, w][:, None]) & (found <= high[mine, w][:, None])
            r, k = np.nonzero(inside)
            c = some[ranked[r, at[r, k]]]
            heaps.add(mine[r] * windows + w, found[r, k], candidates.id[c], candidates.twin[c])
    return heaps


def windows_of(positive: np.ndarray, least: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Whole scores s with least * p <= 100 * s <= most * p, from low to high, without rounding.
    Exact for every 64-bit p: quotient and remainder are taken apart before they are multiplied."""
    q, r = np.divmod(positive, 100)
    return q * least - (-(r * least) // 100), q * most + (r * most) // 100


def prepared(vectors: DataFrame) -> DataFrame:
    """vec_id, label, embedding, twin of the rows that take part, each different row once."""
    whole_rows = "vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL"
    finite = "forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity'))"
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), "embedding").where(f"{whole_rows} AND {finite}")
    return rows.dropDuplicates().withColumn("twin", F.xxhash64("label", "embedding"))


def mine(vectors: DataFrame, is_anchor: str, positives: int = 5, negatives: int = 10, least: int = 30, most: int = 90) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``vectors`` has vec_id, label, embedding; ``is_anchor`` is a condition on vec_id. A negative's score lies
    between ``least`` and ``most`` hundredths of the positive's.
    """
    rows = stored(prepared(vectors), "vectors")
    total, width = rows.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("embedding")), F.lit(0))).first()
    anchors = rows.where(is_anchor)
    n_anchors = anchors.count()
    blocks = max(1, -(-n_anchors // ANCHORS))
    regions = max(1, -(-total // min(REGION, max(1024, 8 * math.isqrt(total)))))

    def spread(df: DataFrame, own: str, number: int, other: str, copies: int) -> DataFrame:
        dealt = df.withColumn(own, F.pmod(F.xxhash64("vec_id", "twin"), F.lit(number)).cast("int"))
        return dealt.withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))

    again = rows.select(*(F.col(c).alias(c) for c in rows.columns))
    candidates = spread(again, "region", regions, "ablock", blocks).groupBy("region", "ablock")

    def round_of(asking: DataFrame, per_task, limit: int, ranked: str) -> DataFrame:
        asked = spread(asking, "ablock", blocks, "region", regions).groupBy("region", "ablock")
        found = asked.cogroup(candidates).applyInArrow(per_task, FOUND)
        order = Window.partitionBy("anchor_id", "anchor_twin", "slot").orderBy(F.col("score").desc(), "other_id", "other_twin")
        return found.withColumn(ranked, F.row_number().over(order)).where(F.col(ranked) <= limit)

    def table_of(a: Rows, heaps: Heaps, windows: int) -> pa.Table:
        owner, score, ids, twins = heaps.rows()
        slot = pa.array(owner % windows, pa.int32())
        owner = owner // windows
        return pa.table(
            {"anchor_id": a.id[owner], "anchor_twin": a.twin[owner], "slot": slot, "other_id": ids, "other_twin": twins, "score": score}
        )

    def positive_heaps(left: pa.Table, right: pa.Table) -> pa.Table:
        a = Rows(left, width)
        return table_of(a, own_label(a, Rows(right, width), positives), 1)

    def window_heaps(left: pa.Table, right: pa.Table) -> pa.Table:
        a = Rows(left, width)
        scores = np.zeros((len(a), positives), np.int64)
        there = np.zeros((len(a), positives), bool)
        for k, own in enumerate(a.table["positive_scores"].to_pylist()):
            scores[k, : len(own)], there[k, : len(own)] = own, True
        low, high = windows_of(scores, least, most)
        low[~there], high[~there] = 1, 0
        return table_of(a, in_windows(a, Rows(right, width), low, high, negatives), positives)

    best = stored(round_of(anchors, positive_heaps, positives, "place"), "positives")
    per_anchor = best.groupBy(F.col("anchor_id").alias("vec_id"), F.col("anchor_twin").alias("twin")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("place", "score"))), lambda x: x.score).alias("positive_scores")
    )
    windowed = round_of(anchors.join(per_anchor, ["vec_id", "twin"]), window_heaps, negatives, "rank")
    named = best.select("anchor_id", "anchor_twin", (F.col("place") - 1).alias("slot"), F.col("other_id").alias("positive_id"), F.col("score").alias("positive_score"))
    pairs = windowed.withColumnsRenamed({"other_id": "negative_id", "score": "negative_score"}).join(named, ["anchor_id", "anchor_twin", "slot"])
    return pairs.select("anchor_id", "positive_id", F.col("rank").cast("int"), "negative_id", "positive_score", "negative_score")


def op11_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anchors: ids divisible by 100. Labels of ids divisible by 7 are moved on by one first."""
    vectors = read(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label"))
    return mine(vectors.withColumn("label", label), "vec_id % 100 = 0")


#: Products of whole numbers below 2**53 are exact in doubles.
OP11_SQL = """
WITH rows AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
    SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
           list_inner_product(a.v, c.v)::BIGINT AS score
    FROM rows a JOIN rows c ON a.vec_id <> c.vec_id WHERE a.vec_id % 100 = 0),
positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id,
       row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INT AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""
