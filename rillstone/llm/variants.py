"""Spelling variants: words one edit apart, found in a trie of letter counts.

One inserted, deleted or replaced letter changes a word's letter counts by one letter too many, one too few, or
one of each. So words are arranged by the counts of successive letter groups: a node of the trie holds
the words that share the counts of the groups so far. A search goes down depth-first and pays for
every count that differs, with a budget of one for the surplus and one for the deficit over all groups; the
words of a leaf that it reaches are compared letter by letter. Many words search at once: each node
takes along those whose budget still holds.

The vocabulary is dealt by the trie's first levels: a word is indexed in the bucket of its own first counts
and searches the buckets of all first counts within the budget. The number of levels
grows with the vocabulary. First counts that many words share are cut into pieces, which all who reach them
search. Of two words, the one with the lesser first counts (or, at equal ones, the lesser
word) searches, so every pair is found once. A word has few near words (its letters times the
alphabet), so no list is long.

Counts above the largest that fits are taken as that one; they never differ by more than the true
ones, so no pair is lost. Words are any text of the code points 1 to 255; others raise ValueError. Rows with a null
or empty word are left out, repeated words are one with the sum of their counts. A null text has no words; a run
in a row with a null id is taken unchanged. Empty tables give empty results.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillstone.llm.arrays import mix, ragged
from rillstone.llm.common import read, stored

LOWER = "abcdefghijklmnopqrstuvwxyz"
#: Order of the trie's levels: common letters first, since their counts tell most words apart. The
#: last groups hold all other code points by their remainder.
LEVELS = "eniatrsoulcdmpghbfvqkwyjxz"
OTHER_GROUPS = 6
GROUPS = len(LEVELS) + OTHER_GROUPS
#: Largest count in the first levels' key, four bits each.
KEY_COUNT = 15
MOST_LEVELS = 12
#: Words indexed in one bucket, about; more under the same first counts are cut into pieces.
BUCKET = 16384
LEAF = 16
#: Letters compared in arrays; longer words are compared one by one.
WIDTH = 64

GROUP_OF = np.array([LEVELS.index(chr(c)) if chr(c) in LEVELS else len(LEVELS) + c % OTHER_GROUPS for c in range(256)])
NEAR = "word string, n long, other string, other_n long"


def letters(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All code points, one after the other, and where each word begins, with one more entry."""
    try:
        flat = np.frombuffer("".join(words).encode("latin-1"), np.uint8)
    except UnicodeEncodeError as error:
        raise ValueError("words must be made of the code points 1 to 255") from error
    return flat, np.cumsum([0, *map(len, words)])


def letter_counts(flat: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """How often each group occurs in each word, at most 255."""
    n = len(starts) - 1
    out = np.empty((n, GROUPS), np.uint8)
    for a in range(0, n, 8192):
        b = min(n, a + 8192)
        at = np.repeat(np.arange(b - a), np.diff(starts[a : b + 1])) * GROUPS + GROUP_OF[flat[starts[a] : starts[b]]]
        out[a:b] = np.bincount(at, minlength=(b - a) * GROUPS).reshape(-1, GROUPS).clip(max=255)
    return out


def trie_pairs(words: np.ndarray, queries: np.ndarray, leaf: int = LEAF) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(queries, words) whose counts differ by a surplus of one and a deficit of one at most.

    ``words`` are rows of counts in lexicographic order, so a node is a range of them.
    """
    if not len(words) or not len(queries):
        return
    nothing = np.zeros(len(queries), np.int8)
    stack = [(0, len(words), 0, np.arange(len(queries)), nothing, nothing)]
    while stack:
        low, high, level, asking, surplus, deficit = stack.pop()
        if high - low <= leaf or level == words.shape[1]:
            for a in range(0, len(asking), 65536):
                some = asking[a : a + 65536]
                apart = queries[some, None, level:].astype(np.int16) - words[low:high, level:]
                fits = surplus[a : a + 65536, None] + np.maximum(apart, 0).sum(2) <= 1
                fits &= deficit[a : a + 65536, None] - np.minimum(apart, 0).sum(2) <= 1
                q, w = np.nonzero(fits)
                yield some[q], low + w
            continue
        column = words[low:high, level]
        cuts = np.concatenate([[0], np.flatnonzero(column[1:] != column[:-1]) + 1, [high - low]])
        counts = queries[asking, level].astype(np.int16)
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            apart = counts - int(column[a])
            near = np.flatnonzero(np.abs(apart) <= 1)
            more, less = surplus[near] + (apart[near] > 0), deficit[near] + (apart[near] < 0)
            kept = (more <= 1) & (less <= 1)
            if kept.any():
                stack.append((low + int(a), low + int(b), level + 1, asking[near[kept]], more[kept], less[kept]))


def one_edit(a: str, b: str) -> bool:
    """Exactly one inserted, deleted or replaced letter apart."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    short, long = sorted((a, b), key=len)
    same = next((k for k, x in enumerate(short) if x != long[k]), len(short))
    return short[same + (len(a) == len(b)) :] == long[same + 1 :]


class Letters:
    """Words side by side from their first and from their last letter, to compare many pairs at once."""

    def __init__(self, words: list[str], flat: np.ndarray, starts: np.ndarray) -> None:
        self.words, self.lengths = words, np.diff(starts)
        self.first = np.zeros((len(words), WIDTH), np.uint8)
        self.last = np.zeros((len(words), WIDTH), np.uint8)
        taken = np.minimum(self.lengths, WIDTH)
        row = np.repeat(np.arange(len(words)), taken)
        place = ragged(np.zeros(len(words), np.int64), taken)
        self.first[row, place] = flat[np.repeat(starts[:-1], taken) + place]
        self.last[row, WIDTH - 1 - place] = flat[np.repeat(starts[1:], taken) - 1 - place]

    def near(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Which pairs of words are one edit apart."""
        out = np.zeros(len(a), bool)
        long = (self.lengths[a] > WIDTH) | (self.lengths[b] > WIDTH)
        for k in np.flatnonzero(long):
            out[k] = one_edit(self.words[a[k]], self.words[b[k]])
        apart = np.abs(self.lengths[a] - self.lengths[b])
        short = np.flatnonzero(~long & (apart <= 1))
        for k in range(0, len(short), 65536):
            at = short[k : k + 65536]
            head, tail = self.first[a[at]] != self.first[b[at]], self.last[a[at]] != self.last[b[at]]
            differ = head.any(1)
            shared = head.argmax(1) + tail[:, ::-1].argmax(1)
            need = np.minimum(self.lengths[a[at]], self.lengths[b[at]]) - (apart[at] == 0)
            out[at] = differ & (shared >= need)
        return out


class Deal:
    """Which buckets a word is indexed in and searches."""

    def __init__(self, levels: int, buckets: int, hot: dict[int, int] | None = None) -> None:
        self.levels, self.buckets = levels, buckets
        pieces = sorted((hot or {}).items())
        self.hot_keys = np.array([k for k, _ in pieces], np.int64)
        self.hot_pieces = np.array([p for _, p in pieces], np.int64)

    def keys(self, counts: np.ndarray) -> np.ndarray:
        """The first counts in one number, four bits each."""
        key = np.zeros(len(counts), np.int64)
        for level in range(self.levels):
            key = key << 4 | np.minimum(counts[:, level], KEY_COUNT)
        return key

    def pieces(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.hot_keys):
            return np.ones(len(keys), np.int64)
        at = np.minimum(np.searchsorted(self.hot_keys, keys), len(self.hot_keys) - 1)
        return np.where(self.hot_keys[at] == keys, self.hot_pieces[at], 1)

    def bucket(self, keys: np.ndarray, piece: np.ndarray) -> np.ndarray:
        spread = mix(keys.view(np.uint64) + np.uint64(1)) % np.uint64(self.buckets)
        return (spread.astype(np.int64) + piece) % self.buckets

    def reached(self, keys: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(rows, keys): every key not below a row's own within the budget, the own one first."""
        rows = np.arange(len(keys))
        yield rows, keys
        steps = [1 << 4 * (self.levels - 1 - level) for level in range(self.levels)]
        counts = [keys >> 4 * (self.levels - 1 - level) & KEY_COUNT for level in range(self.levels)]
        for up in range(self.levels):
            can = counts[up] < KEY_COUNT
            yield rows[can], keys[can] + steps[up]
            for down in range(up + 1, self.levels):  # a key grows if the earlier count does
                both = can & (counts[down] > 0)
                yield rows[both], keys[both] + steps[up] - steps[down]

    def rows(self, words: pa.Array, ns: pa.Array) -> pa.Table:
        """bucket, word, n, indexed: every word in all buckets it searches."""
        listed = words.to_pylist()
        flat, starts = letters(listed)
        keys = self.keys(letter_counts(flat, starts))
        own_piece = self.own_piece(flat, starts, keys)
        row, bucket = [], []
        for at, reached in self.reached(keys):
            many = self.pieces(reached)
            row.append(np.repeat(at, many))
            bucket.append(self.bucket(np.repeat(reached, many), ragged(np.zeros(len(many), np.int64), many)))
        asked = np.unique(np.concatenate(row) * self.buckets + np.concatenate(bucket))
        row, bucket = asked // self.buckets, asked % self.buckets
        return pa.table(
            {
                "bucket": pa.array(bucket, pa.int32()),
                "word": words.take(pa.array(row)),
                "n": ns.take(pa.array(row)),
                "indexed": pa.array(bucket == self.bucket(keys, own_piece)[row]),
            }
        )

    def own_piece(self, flat: np.ndarray, starts: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """A word's piece of its key, by a hash of its letters."""
        sums = np.zeros(len(flat) + 1, np.uint64)
        place = np.arange(len(flat)) - np.repeat(starts[:-1], np.diff(starts))
        np.cumsum(mix(flat + (place.astype(np.uint64) << np.uint64(8))), out=sums[1:])
        return (mix(sums[starts[1:]] - sums[starts[:-1]]) % self.pieces(keys).astype(np.uint64)).astype(np.int64)


def pairs_of_bucket(table: pa.Table, deal: Deal) -> pa.Table:
    """Near words of a bucket, each pair once."""
    words = table["word"].combine_chunks()
    listed = words.to_pylist()
    flat, starts = letters(listed)
    counts = letter_counts(flat, starts)
    indexed = np.flatnonzero(table["indexed"].to_numpy(zero_copy_only=False))
    order = indexed[np.lexsort(counts[indexed].T[::-1])]
    keys, text = deal.keys(counts), Letters(listed, flat, starts)
    asking, found = [], []
    for q, w in trie_pairs(counts[order], counts):
        w = order[w]
        ahead = keys[q] < keys[w]
        same = np.flatnonzero((keys[q] == keys[w]) & (q != w))
        ahead[same] = [listed[a] < listed[b] for a, b in zip(q[same], w[same], strict=True)]
        q, w = q[ahead], w[ahead]
        near = text.near(q, w)
        asking.append(q[near])
        found.append(w[near])
    a = pa.array(np.concatenate([np.zeros(0, np.int64), *asking]))
    b = pa.array(np.concatenate([np.zeros(0, np.int64), *found]))
    ns = table["n"].combine_chunks()
    return pa.table({"word": words.take(a), "n": ns.take(a), "other": words.take(b), "other_n": ns.take(b)})


def vocabulary(docs: DataFrame, every: int = 199, shortest: int = 6, least: int = 5) -> DataFrame:
    """word, n: maximal runs of letters, lower-cased in A-Z, that occur ``least`` times in all texts.

    A run loses one letter where ``every`` divides the checksum of id and run. Built-in functions only.
    Runs shorter than ``shortest`` make no word, so the pattern skips them. Each task counts before the
    shuffle: a common word sends one row a task.
    """
    pattern = f"[A-Za-zÀ-ÿ]{{{shortest},}}"
    runs = docs.select(F.col("doc_id").cast("string").alias("id"), F.explode(F.regexp_extract_all("text", F.lit(pattern), 0)).alias("run"))
    run = F.translate("run", LOWER.upper(), LOWER)
    checked = runs.select(run.alias("run"), F.crc32(F.concat("id", F.lit(":"), run).cast("binary")).alias("h"))
    place = (F.col("h") % F.char_length("run")).cast("int")
    cut = F.concat(F.substr("run", F.lit(1), place), F.substr("run", place + 2))
    word = F.when(F.col("h") % every == 0, cut).otherwise(F.col("run"))
    counts = checked.select(word.alias("word")).where(F.char_length("word") >= shortest).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counts.where(F.col("n") >= least)


def near_words(words: DataFrame) -> DataFrame:
    """word, n, other, other_n: each pair of different words one edit apart, once.

    ``words`` has word and n; each word once.
    """
    total = words.count()
    levels = min(MOST_LEVELS, max(1, math.ceil(math.log(max(1, total) / 4096, 4))))
    cores = words.sparkSession.sparkContext.defaultParallelism
    buckets = max(1, -(-total // BUCKET), min(2 * cores, -(-total // 1024)))
    plain = Deal(levels, buckets)

    def first_counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = plain.keys(letter_counts(*letters(batch["word"].to_pylist())))
            yield pa.record_batch({"key": keys})

    crowded = words.select("word").mapInArrow(first_counts, "key long").groupBy("key").count().where(F.col("count") > BUCKET)
    # At most one row for every BUCKET words of the vocabulary.
    deal = Deal(levels, buckets, {r["key"]: -(-r["count"] // BUCKET) for r in crowded.collect()})

    def dealt(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from deal.rows(batch["word"], batch["n"]).to_batches()

    rows = words.select("word", F.col("n").cast("long")).mapInArrow(dealt, "bucket int, word string, n long, indexed boolean")
    return rows.groupBy("bucket").applyInArrow(lambda table: pairs_of_bucket(table, deal), NEAR)


def spelling_groups(words: DataFrame, factor: int = 5) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word.

    ``form`` is the near word that occurs most often (the least of several), if that is ``factor`` times as
    often as the word; ``root`` follows forms to the last.
    """
    words = words.where("word <> ''").groupBy("word").agg(F.sum("n").alias("n"))
    words = stored(words, "words")
    pairs = stored(near_words(words), "near")
    ends = pairs.select("word", F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("other")).alias("to"))
    ends = ends.union(pairs.select("other", F.struct(-F.col("n"), F.col("word"))))
    best = ends.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min("to").alias("to"))
    known = words.join(best, "word", "left")
    has = -F.col("to.less") >= F.col("n") * factor
    chosen = known.select(
        "word",
        F.when(has, F.col("to.other")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(has, -F.col("to.less")).alias("form_n"),
    )
    chosen = stored(chosen, "forms")
    return chosen.join(roots(chosen.where("form IS NOT NULL")), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def roots(forms: DataFrame) -> DataFrame:
    """word, root of (word, form) steps: each round doubles the number of steps taken.

    Forms grow by a factor each step, so steps have no circle and a handful of rounds reach the end.
    """
    chain = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = chain.select(F.col("word").alias("root"), F.col("root").alias("further"))
        chain = stored(chain.join(onward, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        if not chain.where("moved").limit(1).count():
            return chain.select("word", "root")


def op13_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of six letters or more that occur five times or more in all documents."""
    return spelling_groups(vocabulary(read(spark, sf_dir, "documents")))
