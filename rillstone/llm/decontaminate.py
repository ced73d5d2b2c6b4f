"""Benchmark decontamination: verbatim runs of benchmark words in training texts, by suffix arrays.

Training texts are cut into shards (pieces of an Arrow batch). The suffixes of a shard, cut to a
window's length, are sorted into a suffix array, and every benchmark suffix is binary-searched in
it. The first and last place found enclose all its occurrences; occurrences at consecutive places
join into the longest verbatim match. Words outside the benchmark's vocabulary end a match, so
suffixes that no window can equal are left out of the array.

A window is ``window`` consecutive words of an item; an item of fewer words, but not none, is one
window. Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z.

The benchmark reaches the tasks by broadcast in blocks of at most :data:`BLOCK_BYTES`, one pass over
the texts per block, so its size is bounded whatever the benchmark's.

Null and empty texts have no words. Items that are null, empty or have a null id have no windows.
Repeated rows and rows with a null id are judged each by itself; an empty benchmark hits nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillstone.llm import arrays
from rillstone.llm.common import read

WINDOW = 10
#: Most bytes of benchmark text that are broadcast at once.
BLOCK_BYTES = 16 << 20
SHARD_BYTES = 2 << 20
MATCHES = "array<struct<item_id:string,item_word:int,doc_word:int,length:int>>"


@dataclass
class Suffixes:
    """Windows of benchmark items as packed word numbers, and the vocabulary."""

    vocabulary: np.ndarray  #: sorted word hashes; a word's number is its place + 1
    low: list[np.ndarray]  #: per packed column, the least key that begins with the window
    high: list[np.ndarray]  #: the greatest one
    item: np.ndarray
    start: np.ndarray
    length: np.ndarray
    item_ids: list[str]
    window: int

    @property
    def bits(self) -> int:
        return max(1, int(len(self.vocabulary)).bit_length())

    @property
    def shortest(self) -> int:
        return int(self.length.min()) if len(self.length) else 1

    def keys(self, numbers: np.ndarray, at: np.ndarray, fill: np.ndarray | None = None, length: np.ndarray | None = None) -> list[np.ndarray]:
        """The ``window`` word numbers from each place, packed into 64-bit columns."""
        per = 63 // self.bits
        padded = np.concatenate([numbers, np.zeros(self.window, numbers.dtype)]).astype(np.uint64)
        columns = []
        for first in range(0, self.window, per):
            key = np.zeros(len(at), np.uint64)
            for k in range(first, min(first + per, self.window)):
                word = padded[at + k]
                if length is not None:
                    word = np.where(k < length, word, fill)
                key = (key << np.uint64(self.bits)) | word
            columns.append(key)
        return columns


def suffixes_of(items: list[tuple[str, str]], window: int) -> Suffixes:
    ids = [i for i, _ in items]
    offsets, data = arrays.text_buffer(pa.array([t for _, t in items], pa.string()))
    words = arrays.words_of(data, offsets, arrays.ALNUM, lower=True)
    vocabulary = np.unique(words.hash)
    numbers = np.searchsorted(vocabulary, words.hash) + 1
    size = np.minimum(words.counts, window)
    windows = np.where(words.counts > 0, words.counts - size + 1, 0)
    item = np.repeat(np.arange(len(ids)), windows)
    at = arrays.ragged(words.first[:-1], windows)
    found = Suffixes(vocabulary, [], [], item, at - words.first[item], size[item], ids, window)
    ones = np.full(len(at), (1 << found.bits) - 1, np.uint64)
    found.low = found.keys(numbers, at, np.zeros(len(at), np.uint64), found.length)
    found.high = found.keys(numbers, at, ones, found.length)
    return found


def _bound(columns: list[np.ndarray], query: list[np.ndarray], right: bool) -> np.ndarray:
    """Binary search of every query in rows sorted by their columns."""
    low = np.zeros(len(query[0]), np.int64)
    high = np.full(len(query[0]), len(columns[0]), np.int64)
    while True:
        open_ = np.flatnonzero(low < high)
        if not len(open_):
            return low
        middle = (low[open_] + high[open_]) // 2
        before = np.zeros(len(open_), bool)
        equal = np.ones(len(open_), bool)
        for column, wanted in zip(columns, query, strict=True):
            have, want = column[middle], wanted[open_]
            before |= equal & (have < want)
            equal &= have == want
        if right:
            before |= equal
        low[open_] = np.where(before, middle + 1, low[open_])
        high[open_] = np.where(before, high[open_], middle)


def occurrences(words: arrays.Words, suffixes: Suffixes) -> tuple[np.ndarray, np.ndarray]:
    """(window, word) of every occurrence of a benchmark window in the texts of a shard."""
    none = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if not len(suffixes.vocabulary) or not len(words.hash):
        return none
    at = np.minimum(np.searchsorted(suffixes.vocabulary, words.hash), len(suffixes.vocabulary) - 1)
    numbers = np.where(suffixes.vocabulary[at] == words.hash, at + 1, 0)
    # A gap between texts: no window reaches over it.
    spread = np.zeros(len(numbers) + len(words.first), np.int64)
    place = np.arange(len(numbers)) + words.doc
    spread[place] = numbers
    known = np.concatenate([[0], np.cumsum(spread == 0)])
    shortest = suffixes.shortest
    fits = place + shortest < len(known)
    starts = place[fits]
    starts = starts[known[starts + shortest] == known[starts]]
    if not len(starts):
        return none
    columns = suffixes.keys(spread, starts)
    order = np.lexsort(columns[::-1])  # the shard's suffix array
    columns = [c[order] for c in columns]
    first, last = _bound(columns, suffixes.low, False), _bound(columns, suffixes.high, True)
    window = np.repeat(np.arange(len(first)), last - first)
    found = starts[order][arrays.ragged(first, last - first)]
    return window, np.searchsorted(place, found)


def longest_matches(words: arrays.Words, suffixes: Suffixes) -> list[np.ndarray]:
    """Columns row, item, item word, text word, length of the maximal runs of occurring windows."""
    window, word = occurrences(words, suffixes)
    item, start, row = suffixes.item[window], suffixes.start[window], words.doc[word]
    inside = word - words.first[row]
    order = np.lexsort((inside, inside - start, item, row))
    row, item, start, inside, size = (x[order] for x in (row, item, start, inside, suffixes.length[window]))
    same = (row[1:] == row[:-1]) & (item[1:] == item[:-1]) & (inside[1:] - start[1:] == inside[:-1] - start[:-1]) & (inside[1:] == inside[:-1] + 1)
    begins = np.concatenate([[True], ~same])[: len(row)]
    ends = np.concatenate([~same, [True]])[: len(row)]
    return [row[begins], item[begins], start[begins], inside[begins], inside[ends] - inside[begins] + size[ends]]


def benchmark_blocks(items: DataFrame, id_column: str, text_column: str, window: int, block_bytes: int = BLOCK_BYTES) -> Iterator[Suffixes]:
    """The benchmark in blocks of about ``block_bytes``; one block is in the driver at a time."""
    plain = items.select(items[id_column].cast("string").alias("id"), items[text_column].cast("string").alias("text")).where("id IS NOT NULL AND text IS NOT NULL")
    total = plain.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-2 * total // block_bytes)) if total > block_bytes else 1
    for k in range(n):
        block = plain.where(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == k)
        yield suffixes_of([tuple(r) for r in block.collect()], window)


def verbatim_matches(
    docs: DataFrame, items: DataFrame, text_column: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """``row`` (all columns of docs), n_words, n_hit and ``matches``: the longest verbatim matches with
    every item, where they begin in the item and in the text, and their lengths in words."""
    spark = docs.sparkSession
    row_kind = docs.schema.simpleString()
    rows = docs.select(F.struct("*").alias("row"), F.lit(None).cast("long").alias("n_words"), F.lit(None).cast("long").alias("n_hit"), F.array().cast(MATCHES).alias("matches"))
    for suffixes in benchmark_blocks(items, item_id, item_text, window, block_bytes):
        shared = spark.sparkContext.broadcast(suffixes)

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            kind = pa.struct([("item_id", pa.string()), ("item_word", pa.int32()), ("doc_word", pa.int32()), ("length", pa.int32())])
            known = shared.value
            for batch in batches:
                offsets, data = arrays.text_buffer(batch.column(0).field(text_column))
                n_words, n_hit, matches = [], [], []
                for a, b in arrays.row_chunks(offsets, SHARD_BYTES):
                    words = arrays.words_of(data[offsets[a] : offsets[b]], offsets[a : b + 1], arrays.ALNUM, lower=True)
                    row, item, item_word, doc_word, length = longest_matches(words, known)
                    old = batch.column(3).slice(a, b - a)
                    old_row = np.repeat(np.arange(b - a), old.value_lengths().to_numpy())
                    flat = old.flatten()
                    ids = [*flat.field("item_id").to_pylist(), *(known.item_ids[i] for i in item.tolist())]
                    all_row = np.concatenate([old_row, row])
                    columns = [np.concatenate([flat.field(n).to_numpy(zero_copy_only=False), x]).astype(np.int32) for n, x in (("item_word", item_word), ("doc_word", doc_word), ("length", length))]
                    order = np.lexsort((columns[0], columns[1], all_row))
                    edge = np.zeros(len(words.hash) + 1, np.int64)
                    begin = words.first[all_row] + columns[1]
                    np.add.at(edge, begin, 1)
                    np.add.at(edge, begin + columns[2], -1)
                    hit = np.cumsum(edge[:-1]) > 0
                    n_words.append(words.counts)
                    n_hit.append(np.bincount(words.doc[hit], minlength=b - a))
                    values = pa.StructArray.from_arrays([pa.array([ids[i] for i in order.tolist()], pa.string()), *(pa.array(c[order]) for c in columns)], fields=list(kind))
                    cuts = np.concatenate([[0], np.cumsum(np.bincount(all_row, minlength=b - a))]).astype(np.int32)
                    matches.append(pa.ListArray.from_arrays(pa.array(cuts), values))
                if matches:
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0), pa.array(np.concatenate(n_words).astype(np.int64)), pa.array(np.concatenate(n_hit).astype(np.int64)), pa.concat_arrays(matches)],
                        ["row", "n_words", "n_hit", "matches"],
                    )

        rows = rows.mapInArrow(search, f"row {row_kind}, n_words long, n_hit long, matches {MATCHES}")
    return rows


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document: its words, those inside benchmark windows, and the items they are from."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = verbatim_matches(docs, read(spark, sf_dir, "benchmark"))
    items = F.array_sort(F.array_distinct("matches.item_id"))
    return found.select(
        F.col("row.doc_id").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


#: Windows of items joined with the windows of the same length of documents.
OP7_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE item_id IS NOT NULL),
sized AS (SELECT item_id, w, least(10, len(w)) AS n FROM b WHERE len(w) > 0),
placed AS (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM sized),
windows AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS s FROM placed),
lengths AS (SELECT DISTINCT n FROM windows),
starts AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lengths WHERE len(w) >= n),
hits AS (
  SELECT doc_id, item_id, i, starts.n AS n FROM starts JOIN windows
  ON starts.n = windows.n AND array_to_string(starts.w[i:i + starts.n - 1], ' ') = windows.s),
hit_words AS (
  SELECT doc_id, count(DISTINCT k) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM hits) GROUP BY doc_id),
hit_items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
  FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""
