"""Language-model scoring: a hashed maximum-entropy model with a class-factored softmax.

P(word | history) = P(class | history) * P(member | class, history) * P(word | member, history). A
class is the word's shape (case, ending, script). Its members are the class's most frequent words,
each alone, and one member for all others. That member's words, down to the rarest, are the leaves of a tree:
ordered by count, split into FAN branches of about equal mass, each again until every word is alone; at each
split a softmax over the branches. Words never seen in training share one more leaf per class. All
softmaxes start at the smoothed unigram model (their biases) and add weights of history features: the
hashed bigram of the last two words, the symbol of the last word (its frequent word or class) and of the word
before it (a skip feature); in the tree, the last word itself and the one before it, each hashed with the split.
Hashed features share a table of fixed size, so words may share weights, but none is without any.

A word's number (class by class, by falling count, then by hash) tells its count and its way down the
tree, given how many words of each class occur how often. Numbers come from all training texts in one packed
exchange: hash ranges count their words, ranges of equal counts follow each other, and each block of
texts gets the numbers of its words. The texts are stored as numbers. Weights are trained by
rounds of gradient updates: every task takes steps over its part of the round's documents, Spark
averages the tasks' changes slice by slice, and the next round starts there. The rounds use
different documents and together all of the training documents. Texts are scored batch by batch
with sparse lookups. The chances of classes are products of one factor of the bigram and one of the two
symbols, so exponentials are taken per factor, and those of members per different history, not per token.

Tokens are words ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z, then one end of text. Null and empty
texts are one end. Rows with a null id are scored and never learned from. Without training texts
every base probability is the smoothing's and scores equal it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rillstone.llm import arrays, exchange
from rillstone.llm.common import crc_remainder, read, released, releasing, stored

SMOOTHING = 0.1
#: Word shapes; class 0 is the end of text.
CLASSES = 49
#: Members of a class: its most frequent words and one for the others (member 0).
MEMBERS = 24
SYMBOLS = CLASSES * MEMBERS
BIGRAMS = 1 << 12
#: Hashed features of the softmax over a class's members: a history symbol with the class.
MEMBER_FEATURES = 1 << 13
#: Branches of a split among the words of member 0.
FAN = 8
#: Hashed features of the softmaxes over branches: the last word, or the one before it, with the split.
BRANCH_FEATURES = 1 << 16
#: Bytes of word numbers handled at once; a longer text is handled alone.
CHUNK_BYTES = 1 << 22
ROUNDS = 3
STEP_TOKENS = 16384
RATE = 0.25
#: What a hash range tells the blocks of a word: class, count, place among the range's words of this class and count.
FOUND = np.dtype([("class", "u1"), ("count", "<u8"), ("place", "<u4")])
CHANGES = "slice int, tokens double, change binary"
SLICES = 16


def shapes(words: arrays.Words) -> np.ndarray:
    """Class 1 .. CLASSES - 1 of each word: its last byte's kind, non-ASCII bytes, its first byte's kind."""
    last, first = words.data[words.end - 1], words.data[words.start]
    wide = np.concatenate([[0], np.cumsum(words.data >= 0x80)])
    wide = (wide[words.end] > wide[words.start]).astype(np.int64)
    ending = np.full(256, 7)
    ending[0x61:0x7B] = ending[0x80:] = 0
    for kind, some in enumerate((b".", b",", b"!?", b"*", b"&%$#", b"0123456789"), 1):
        ending[[*some]] = kind
    begin = np.full(256, 2)
    begin[0x61:0x7B] = begin[0x80:] = 0
    begin[0x30:0x3A] = 1
    return 1 + ending[last] * 6 + begin[first] * 2 + wide


@dataclass
class Unigrams:
    """What all training texts say about single words: how many words of each class occur how often.

    Numbers of words are dealt class by class, by falling count; a class's last one is for words never seen.
    """

    tokens: int  #: N
    distinct: int  #: V
    ends: int
    place: np.ndarray  #: first number of each run of words of one class and count
    count: np.ndarray  #: how often each word of a run occurs
    mass: np.ndarray  #: smoothed count of each symbol
    first: np.ndarray | None = None  #: first number of each class, with one more entry at the end

    @property
    def whole(self) -> float:
        return self.tokens + SMOOTHING * (self.distinct + 1)

    @property
    def kind(self) -> np.dtype:
        """Type of the numbers in the stored texts."""
        return np.dtype("<u4" if self.first[-1] <= 1 << 32 else "<u8")

    @cached_property
    def corners(self) -> tuple[np.ndarray, np.ndarray]:
        """Where runs begin and end among the numbers, and the smoothed count of all numbers below."""
        places = np.append(self.place, self.first[-1])
        return places, np.concatenate([[0.0], np.cumsum(np.diff(places) * (self.count + SMOOTHING))])

    def class_of(self, numbers: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first, numbers, "right") - 1

    def count_of(self, numbers: np.ndarray) -> np.ndarray:
        return self.count[np.searchsorted(self.place, numbers, "right") - 1]

    def others(self, klass: np.ndarray) -> np.ndarray:
        """First number of each class's member 0."""
        return np.minimum(self.first[klass] + MEMBERS - 1, self.first[klass + 1] - 1)

    def symbol_of(self, numbers: np.ndarray) -> np.ndarray:
        klass = self.class_of(numbers)
        return klass * MEMBERS + np.where(numbers < self.others(klass), numbers - self.first[klass] + 1, 0)


@dataclass
class Paths:
    """The splits above some words of member 0: those of word i are ``first[i]:first[i + 1]`` of the steps."""

    first: np.ndarray
    split: np.ndarray  #: split of each step
    branch: np.ndarray  #: branch the word is in
    key: np.ndarray  #: random value of each split
    bias: np.ndarray  #: log of each branch's smoothed share; -inf for branches without words

    @cached_property
    def bias_by_branch(self) -> np.ndarray:
        return np.ascontiguousarray(self.bias.T)


def paths_of(unigrams: Unigrams, numbers: np.ndarray) -> Paths:
    """Ways from member 0 to each of some sorted, distinct numbers; none for frequent words and lone leaves."""
    places, masses = unigrams.corners
    klass = unigrams.class_of(numbers)
    low, high = unigrams.others(klass), unigrams.first[klass + 1]
    live = np.flatnonzero((numbers >= low) & (high - low > 1))
    low, high = low[live], high[live]
    word, split, branch = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    key, bias = [np.zeros(0, np.uint64)], [np.zeros((0, FAN), np.float32)]
    level = splits = 0
    while len(live):
        new = np.concatenate([[True], low[1:] != low[:-1]])  # sorted words: those of a split are neighbours
        at = np.cumsum(new) - 1
        a, b = low[new], high[new]
        below, upto = np.interp(a, places, masses), np.interp(b, places, masses)
        goal = below[:, None] + (upto - below)[:, None] * (np.arange(1, FAN) / FAN)
        cuts = np.rint(np.interp(goal, masses, places)).astype(np.int64)
        # The first and the last branch are never empty, so every split ends with smaller parts.
        cuts = np.column_stack([a, np.clip(cuts, a[:, None] + 1, b[:, None] - 1), b])
        share = np.diff(np.interp(cuts, places, masses))
        with np.errstate(divide="ignore"):
            bias.append(np.log(share / share.sum(1, keepdims=True)).astype(np.float32))
        key.append(arrays.mix((a * 64 + level).astype(np.uint64)))
        # Words and cuts are sorted: up to a word lie all cuts of earlier splits, the first of its own and those it has passed.
        taken = np.searchsorted(cuts.ravel(), numbers[live], "right") - at * (FAN + 1) - 1
        word.append(live)
        split.append(splits + at)
        branch.append(taken)
        low, high = cuts[at, taken], cuts[at, taken + 1]
        more = high - low > 1
        live, low, high = live[more], low[more], high[more]
        splits += len(a)
        level += 1
    depth = np.zeros(len(numbers), np.int64)
    for some in word:
        depth[some] += 1
    first = np.concatenate([[0], np.cumsum(depth)])
    splits_of, branches_of = np.empty(first[-1], np.int64), np.empty(first[-1], np.int64)
    for k, some in enumerate(word[1:]):
        splits_of[first[some] + k], branches_of[first[some] + k] = split[k + 1], branch[k + 1]
    return Paths(first, splits_of, branches_of, np.concatenate(key), np.concatenate(bias))


class Model:
    def __init__(self, unigrams: Unigrams):
        self.unigrams = unigrams
        mass = unigrams.mass.reshape(CLASSES, MEMBERS)
        with np.errstate(divide="ignore"):
            self.class_bias = np.log(mass.sum(1) / mass.sum()).astype(np.float32)
            self.member_bias = np.log(mass / mass.sum(1, keepdims=True)).astype(np.float32)
        self.weights = np.zeros(sum(self.sizes), np.float32)

    sizes = ((BIGRAMS + 2 * SYMBOLS) * CLASSES, MEMBER_FEATURES * MEMBERS, 2 * BRANCH_FEATURES * FAN)

    def tables(self, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Weights of history features by class, of history and class features by member, of each branch by history and split features."""
        w = self.weights if weights is None else weights
        by_class, by_member, by_branch = np.split(w, np.cumsum(self.sizes[:-1]))
        return by_class.reshape(-1, CLASSES), by_member.reshape(-1, MEMBERS), by_branch.reshape(FAN, -1)


@dataclass
class Tokens:
    """All tokens of some texts, an end after each."""

    row: np.ndarray
    symbol: np.ndarray
    distinct: np.ndarray  #: the different numbers
    at: np.ndarray  #: place of each token among them
    features: tuple
    paths: Paths
    seeds: tuple[np.ndarray, np.ndarray]  #: random values of the last word and of the word before it

    def branches(self, a: int, b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of each step of the tokens a .. b - 1: token (from a), split, branch taken, both feature numbers."""
        at = self.at[a:b]
        start = self.paths.first.take(at)
        steps = self.paths.first.take(at + 1) - start
        step = arrays.ragged(start, steps)
        token = np.repeat(np.arange(b - a), steps)
        split = self.paths.split.take(step)
        key = self.paths.key.take(split)
        near, far = ((((key + seed[a:b].take(token)) * np.uint64(arrays.BASE)) >> np.uint64(65 - BRANCH_FEATURES.bit_length())).view(np.int64) for seed in self.seeds)
        return token, split, self.paths.branch.take(step), near, BRANCH_FEATURES + far


def tokens_in(texts: pa.Array, unigrams: Unigrams) -> Iterator[tuple[int, int, Tokens]]:
    """(first row, last row + 1, tokens) for each chunk of an array of texts stored as numbers."""
    texts = texts.cast(pa.large_binary())
    if not len(texts):
        return
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    for a, b in arrays.row_chunks(offsets, CHUNK_BYTES):
        words = np.diff(offsets[a : b + 1]) // unigrams.kind.itemsize
        number = np.zeros(words.sum() + b - a, np.int64)  # number 0: the end
        number[np.arange(words.sum()) + np.repeat(np.arange(b - a), words)] = data[offsets[a] : offsets[b]].view(unigrams.kind)
        row = np.repeat(np.arange(b - a), words + 1)
        distinct, at = np.unique(number, return_inverse=True)
        symbol = unigrams.symbol_of(distinct).take(at)
        one, two = last_two(arrays.mix(distinct.astype(np.uint64)).take(at), row)
        seeds = (one, two * np.uint64(arrays.BASE))
        yield a, b, Tokens(row, symbol, distinct, at, histories(symbol, row, one + seeds[1]), paths_of(unigrams, distinct), seeds)


def last_two(tokens: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each token's last token and the one before that (0 at the start)."""
    one, two = np.zeros_like(tokens), np.zeros_like(tokens)
    one[1:] = np.where(row[1:] == row[:-1], tokens[:-1], 0)
    two[2:] = np.where(row[2:] == row[:-2], tokens[:-2], 0)
    return one, two


def histories(tokens: np.ndarray, row: np.ndarray, words: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature numbers of each token (a symbol): hashed bigram (random values of the last two words, or the symbols),
    last symbol, symbol before it (0 at the start)."""
    one, two = last_two(tokens, row)
    pair = arrays.mix((one * SYMBOLS + two).astype(np.uint64) if words is None else words) & np.uint64(BIGRAMS - 1)
    return pair.astype(np.int64), BIGRAMS + one, BIGRAMS + SYMBOLS + two


def member_features(one: np.ndarray, two: np.ndarray, klass: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return tuple((arrays.mix((f * CLASSES + klass).astype(np.uint64)) & np.uint64(MEMBER_FEATURES - 1)).astype(np.int64) for f in (one, two))


def _chances(weights: np.ndarray, bias: np.ndarray | float, limit: int = 60) -> np.ndarray:
    """exp(weights + bias). Logs of shares as biases, and weights held within 60 of 0 (30 in each of two factors),
    keep chances and their sums within the range of their type."""
    chances = np.clip(weights, -limit, limit)
    chances += bias
    return np.exp(chances, out=chances)


def _row_sums(rows: np.ndarray) -> np.ndarray:
    return rows @ np.ones(rows.shape[1], rows.dtype)


def _sums(table: np.ndarray, one: np.ndarray, two: np.ndarray, axis: int = 0) -> np.ndarray:
    whole = table.take(one, axis)
    whole += table.take(two, axis)
    return whole


@dataclass
class Contexts:
    """The different (last symbol, symbol before it, class) of some tokens. Few, since symbols are few: what depends on
    them alone is found once for all tokens that share one."""

    at: np.ndarray  #: context of each token
    size: np.ndarray  #: tokens of each context
    one: np.ndarray
    two: np.ndarray
    klass: np.ndarray

    @cached_property
    def features(self) -> tuple[np.ndarray, np.ndarray]:
        return member_features(self.one, self.two, self.klass)

    def factors(self, model: Model, by_class: np.ndarray) -> np.ndarray:
        """Each context's factor of the chances of the classes; the bigram's is the other."""
        return _chances(_sums(by_class, self.one, self.two), model.class_bias, 30)

    def members(self, model: Model, by_member: np.ndarray) -> np.ndarray:
        """Each context's chances of the members of its class."""
        return _chances(_sums(by_member, *self.features), model.member_bias.take(self.klass, 0))


def contexts_of(features: tuple, klass: np.ndarray) -> Contexts:
    _, one, two = features
    code, at, size = np.unique((one * (BIGRAMS + 2 * SYMBOLS) + two) * CLASSES + klass, return_inverse=True, return_counts=True)
    code, klass = np.divmod(code, CLASSES)
    return Contexts(at, size, *np.divmod(code, BIGRAMS + 2 * SYMBOLS), klass)


def distributions(model: Model, weights: np.ndarray, features: tuple, contexts: Contexts) -> tuple[np.ndarray, np.ndarray]:
    """Shares of the classes for each token, shares of the members for each context."""
    by_class, by_member, _ = model.tables(weights)
    classes = _chances(by_class[:BIGRAMS], 0, 30).take(features[0], 0)
    classes *= contexts.factors(model, by_class).take(contexts.at, 0)
    classes /= _row_sums(classes)[:, None]
    members = contexts.members(model, by_member)
    members /= _row_sums(members)[:, None]
    return classes, members


def probabilities(model: Model, weights: np.ndarray, features: tuple, klass: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shares of the classes, and of the members of the given class, for each token."""
    contexts = contexts_of(features, klass)
    classes, members = distributions(model, weights, features, contexts)
    return classes, members.take(contexts.at, 0)


def log_probabilities(model: Model, tokens: Tokens) -> np.ndarray:
    """log10 of each token's probability."""
    by_class, by_member, by_branch = model.tables()
    of_bigram, by_feature = _chances(by_class[:BIGRAMS], 0, 30), np.ascontiguousarray(by_branch.T)
    own = np.empty(len(tokens.at))

    def share(chance: np.ndarray, whole: np.ndarray) -> np.ndarray:
        return np.log10(np.maximum(chance, 1e-37)) - np.log10(whole)

    for a in range(0, len(own), STEP_TOKENS):
        b = min(a + STEP_TOKENS, len(own))
        klass, member = np.divmod(tokens.symbol[a:b], MEMBERS)
        features = tuple(f[a:b] for f in tokens.features)
        contexts = contexts_of(features, klass)
        classes = of_bigram.take(features[0], 0)
        classes *= contexts.factors(model, by_class).take(contexts.at, 0)
        own[a:b] = share(classes.ravel().take(np.arange(b - a) * CLASSES + klass), _row_sums(classes))
        members = contexts.members(model, by_member)
        own[a:b] += share(members.ravel().take(contexts.at * MEMBERS + member), _row_sums(members).take(contexts.at))
        step, split, branch, near, far = tokens.branches(a, b)
        branches = _chances(_sums(by_feature, near, far), tokens.paths.bias.take(split, 0))
        ways = share(branches.ravel().take(np.arange(len(step)) * FAN + branch), _row_sums(branches))
        own[a:b] += np.bincount(step, weights=ways, minlength=b - a)
    return own


def _add_rows(at: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different places (those with most rows first), and the sums of their ``rows``.

    Rows are added whole: the second row of every place to its first, the third, and so on; the rest of a few places
    with many rows at once.
    """
    near = at - at.min()
    order = np.argsort(near.astype(np.uint16) if near.max() < 1 << 16 else near, kind="stable")
    ordered = at[order]
    first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    less = -np.diff(first, append=len(at))
    by_size = np.argsort(less, kind="stable")
    first, less = first[by_size], less[by_size]
    sums = rows.take(order[first], 0)
    added = 1
    while (left := int(np.searchsorted(less, -added))) > 64:
        sums[:left] += rows.take(order[first[:left] + added], 0)
        added += 1
    for k in range(left):
        rest = rows.take(order[first[k] + added : first[k] - less[k]], 0)
        sums[k] += np.ones(len(rest), rows.dtype) @ rest
    return ordered[first], sums


def update(model: Model, weights: np.ndarray, squares: np.ndarray, tokens: Tokens, a: int, b: int) -> None:
    """One adaptive gradient step of the mean log-likelihood of the tokens a .. b - 1."""
    klass, member = np.divmod(tokens.symbol[a:b], MEMBERS)
    features = tuple(f[a:b] for f in tokens.features)
    contexts = contexts_of(features, klass)
    classes, members = distributions(model, weights, features, contexts)
    classes[np.arange(b - a), klass] -= 1
    members *= contexts.size.astype(np.float32)[:, None]
    members -= np.bincount(contexts.at * MEMBERS + member, minlength=members.size).reshape(members.shape)
    (by_class, by_member, by_branch), (sq_class, sq_member, sq_branch) = model.tables(weights), model.tables(squares)
    known, by_context = _add_rows(contexts.at, classes)
    near, far = contexts.features
    sides = [
        (by_class, sq_class, features[0], classes), (by_class, sq_class, contexts.one[known], by_context), (by_class, sq_class, contexts.two[known], by_context),
        (by_member, sq_member, near, members), (by_member, sq_member, far, members),
    ]
    for table, square, at, slope in sides:
        place, sums = _add_rows(at, slope)
        values, squared = table.take(place, 0), square.take(place, 0)
        _learn(values, squared, sums)
        table[place], square[place] = values, squared
    step, split, branch, near, far = tokens.branches(a, b)
    if len(step):
        # By branch, since sums of numbers are faster than sums of short rows.
        branches = _chances(_sums(by_branch, near, far, 1), tokens.paths.bias_by_branch.take(split, 1))
        branches /= branches.sum(0)
        branches.ravel()[branch * len(step) + np.arange(len(step))] -= 1
        for values, squared, slope in zip(by_branch, sq_branch, branches, strict=True):
            sums = np.zeros_like(values)
            np.add.at(sums, near, slope)
            np.add.at(sums, far, slope)
            _learn(values, squared, sums)


def _learn(values: np.ndarray, squared: np.ndarray, sums: np.ndarray) -> None:
    """Moves weights against their summed slopes, the less the larger the sum of all earlier squares."""
    squared += sums * sums
    scale = squared + 1
    np.sqrt(scale, out=scale)
    sums *= RATE
    sums /= scale
    values -= sums


def word_counts(docs: DataFrame) -> tuple[DataFrame, DataFrame, str]:
    """Stored replies (kind 0: what its range found of each distinct word of a block) with how many words of
    each class and count a hash range has (kind 1), and the blocks."""
    grid = exchange.grid_for(docs)
    blocked, block = exchange.in_blocks(docs, "id", grid)
    fact = np.dtype([("count", "<u4"), ("class", "u1")])

    def entries(table: pa.Table) -> pa.Table:
        h, k, learn = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, bool)]
        taught = table["learn"].to_numpy(zero_copy_only=False).astype(bool) if table.num_rows else np.zeros(0, bool)
        for a, _, words in arrays.batch_words(table["text"].combine_chunks(), lower=True):
            h.append(words.hash)
            k.append(shapes(words))
            learn.append(taught[words.doc + a])
        h, k, learn = np.concatenate(h), np.concatenate(k), np.concatenate(learn)
        distinct, first, place = np.unique(h, return_index=True, return_inverse=True)
        facts = np.zeros(len(distinct), fact)
        facts["count"] = np.bincount(place[learn], minlength=len(distinct))
        facts["class"] = k[first]
        return exchange.packed(table[block][0].as_py(), grid, distinct, facts)

    def merge(table: pa.Table) -> pa.Table:
        hashes, facts, sizes = exchange.unpacked(table, fact)
        order, first, group = exchange.groups_of(hashes)
        total = np.add.reduceat(facts["count"][order].astype(np.int64), first)
        klass = facts["class"][order][first]
        by_count = np.lexsort((-total, klass))  # a stable sort: words of equal counts stay by hash
        new = np.ones(len(total), bool)
        new[1:] = (np.diff(klass[by_count].astype(np.int64)) != 0) | (np.diff(total[by_count]) != 0)
        begin = np.flatnonzero(new)
        run = by_count[begin]
        words = np.diff(np.append(begin, len(total)))
        own = np.zeros(len(total), FOUND)
        own["class"], own["count"] = klass, total
        own["place"][by_count] = np.where(total[by_count] > 0, np.arange(len(total)) - np.repeat(begin, words), 0)
        each = np.empty(len(hashes), FOUND)
        each[order] = own[group]
        replies = exchange.replies_of(table, sizes, [exchange.planes(x) for x in np.split(each, np.cumsum(sizes)[:-1])])
        seen = total[run] > 0
        run, words = run[seen], words[seen]
        n, m = replies.num_rows, len(run)
        return pa.table(
            {
                "block": pa.concat_arrays([replies["block"].combine_chunks(), pa.nulls(m, pa.int32())]),
                "part": pa.concat_arrays([replies["part"].combine_chunks(), pa.array([table["part"][0].as_py()] * m, pa.int32())]),
                "reply": pa.concat_arrays([replies["reply"].combine_chunks(), pa.nulls(m, pa.binary())]),
                "kind": pa.array(np.repeat([0, 1], [n, m]).astype(np.int32)),
                "class": pa.array(np.concatenate([np.zeros(n, np.int64), klass[run]]).astype(np.int32)),
                "total": pa.array(np.concatenate([np.zeros(n, np.int64), total[run]])),
                "words": pa.array(np.concatenate([np.zeros(n, np.int64), words])),
            }
        )

    found = blocked.groupBy(block).applyInArrow(entries, exchange.ENTRIES).groupBy("part").applyInArrow(merge, exchange.REPLIES + ", kind int, class int, total long, words long")
    return stored(found, "counts"), blocked, block


def unigrams_of(counts: DataFrame, ends: int) -> Unigrams:
    """All words by class and count. There are at most about as many runs as the root of the number of tokens, per class."""
    runs = counts.where("kind = 1").groupBy("class", "total").agg(F.sum("words").alias("words")).collect()
    runs = np.array([(0, ends, 1)] + [(k, 0, 1) for k in range(1, CLASSES)] + [tuple(r) for r in runs], np.int64)
    klass, count, words = runs[np.lexsort((-runs[:, 1], runs[:, 0]))].T
    place = np.cumsum(words) - words
    first = np.concatenate([[0], np.cumsum(np.bincount(klass, weights=words, minlength=CLASSES))]).astype(np.int64)
    tokens, distinct = int((count * words).sum()), int(words[count > 0].sum())
    found = Unigrams(tokens, distinct, ends, place, count, np.zeros(SYMBOLS), first)
    others = found.others(np.arange(CLASSES))
    places, masses = found.corners
    mass = found.mass.reshape(CLASSES, MEMBERS)
    mass[:, 0] = np.interp(first[1:], places, masses) - np.interp(others, places, masses)
    named = arrays.ragged(first[:-1], others - first[:-1])
    found.mass[found.symbol_of(named)] = found.count_of(named) + SMOOTHING
    return found


def numbered(blocked: DataFrame, block: str, counts: DataFrame, unigrams: Unigrams) -> DataFrame:
    """The rows of the blocks, stored with their words as numbers."""
    shared = blocked.sparkSession.sparkContext.broadcast(unigrams)
    earlier = Window.partitionBy("class", "total").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.where("kind = 1").select("part", "class", "total", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("before"))

    def keys(klass: np.ndarray, count: np.ndarray) -> np.ndarray:
        return klass.astype(np.int64) << 56 | count.astype(np.int64)

    def numbers(replies: pa.Table, before: pa.Table) -> pa.Table:
        """Numbers of a range's words: after those of larger counts and those of equal counts in earlier ranges."""
        uni = shared.value
        run = keys(uni.class_of(uni.place), uni.count)
        order = np.argsort(run)
        start = uni.place.copy()
        at = order[np.searchsorted(run[order], keys(before["class"].to_numpy(), before["total"].to_numpy()))]
        start[at] += before["before"].to_numpy()
        out = []
        for reply in replies["reply"]:
            found = exchange.numbers(reply, FOUND)
            number = start[order[np.searchsorted(run[order], keys(found["class"], found["count"]))]] + found["place"]
            out.append(exchange.planes(number.astype(uni.kind)))
        return pa.table({"block": replies["block"], "part": replies["part"], "reply": pa.array(out, pa.binary())})

    def rows(table: pa.Table, replies: pa.Table) -> pa.Table:
        kind = shared.value.kind
        order = np.argsort(replies["part"].to_numpy(), kind="stable")
        number = np.concatenate([np.zeros(0, kind), *(exchange.numbers(replies["reply"][int(k)], kind) for k in order)])
        chunks = list(arrays.batch_words(table["text"].combine_chunks(), lower=True))
        distinct = np.unique(np.concatenate([np.zeros(0, np.uint64), *(w.hash for _, _, w in chunks)]))
        out = []
        for _, _, words in chunks:
            own = number[np.searchsorted(distinct, words.hash)]
            ends = pa.py_buffer((words.first * kind.itemsize).astype(np.int64))
            out.append(pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(words.first) - 1, [None, ends, pa.py_buffer(own)]).cast(pa.binary()))
        return pa.table({"id": table["id"], "held_out": table["held_out"], "learn": table["learn"], "words": pa.chunked_array(out, pa.binary())})

    replies = counts.where("kind = 0").select("block", "part", "reply").groupBy("part").cogroup(before.groupBy("part")).applyInArrow(lambda a, b: released(numbers, a, b), exchange.REPLIES)
    both = blocked.groupBy(block).cogroup(replies.groupBy("block"))
    return stored(both.applyInArrow(lambda a, b: released(rows, a, b), "id long, held_out boolean, learn boolean, words binary"), "numbered")


def train(docs: DataFrame, model: Model) -> None:
    """Rounds of distributed updates over ``docs`` (words, round)."""
    context = docs.sparkSession.sparkContext
    bounds = np.linspace(0, len(model.weights), SLICES + 1).astype(int)
    for number in range(ROUNDS):
        shared = context.broadcast(model)

        def improve(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            known = shared.value
            weights, squares = known.weights.copy(), np.zeros_like(known.weights)
            seen = 0
            for batch in batches:
                for _, _, tokens in tokens_in(batch.column(0), known.unigrams):
                    for a in range(0, len(tokens.row), STEP_TOKENS):
                        update(known, weights, squares, tokens, a, min(a + STEP_TOKENS, len(tokens.row)))
                    seen += len(tokens.row)
            if seen:
                change = weights - known.weights
                yield pa.RecordBatch.from_arrays(
                    [pa.array(range(SLICES), pa.int32()), pa.array([float(seen)] * SLICES), pa.array([change[a:b].astype(np.float16).tobytes() for a, b in zip(bounds, bounds[1:], strict=False)], pa.binary())],
                    ["slice", "tokens", "change"],
                )

        def average(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums: dict[int, tuple[float, np.ndarray]] = {}
            for batch in batches:
                for k, tokens, change in zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True):
                    total, old = sums.get(k, (0.0, 0.0))
                    sums[k] = (total + tokens, old + tokens * np.frombuffer(change, np.float16).astype(np.float64))
            if sums:
                keys = sorted(sums)
                means = [(sums[k][1] / sums[k][0]).astype(np.float16).tobytes() for k in keys]
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int32()), pa.array([sums[k][0] for k in keys]), pa.array(means, pa.binary())], ["slice", "tokens", "change"])

        changes = docs.where(F.col("round") == number).select("words").mapInArrow(releasing(improve), CHANGES)
        # The slices of all tasks meet by slice; each sum needs the memory of one slice.
        for k, _, change in changes.repartition(SLICES, "slice").mapInArrow(average, CHANGES).collect():
            model.weights[bounds[k] : bounds[k + 1]] += np.frombuffer(change, np.float16).astype(np.float32)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """id, held_out, n_tokens, n_known, base_score, score of every row of ``docs`` (with its words as numbers)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        uni = known.unigrams
        for batch in batches:
            for a, b, tokens in tokens_in(batch.column(2), uni):
                count = uni.count_of(tokens.distinct)
                base = (np.log10(count + SMOOTHING) - np.log10(uni.whole))[tokens.at]
                own = log_probabilities(known, tokens)
                sums = (np.bincount(tokens.row, weights=value, minlength=b - a) for value in (np.ones(len(own)), (count > 0)[tokens.at], base, own))
                n_tokens, n_known, base, own = sums
                columns = [batch.column(0)[a:b], batch.column(1)[a:b], pa.array(n_tokens.astype(np.int64)), pa.array(n_known.astype(np.int64)), pa.array(base), pa.array(own)]
                yield pa.RecordBatch.from_arrays(columns, ["id", "held_out", "n_tokens", "n_known", "base_score", "score"])

    return docs.select("id", "held_out", "words").mapInArrow(releasing(apply), "id long, held_out boolean, n_tokens long, n_known long, base_score double, score double")


def score_texts(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Train on the rows whose id's crc32 is not 0 modulo 10 and score all rows."""
    remainder = crc_remainder("id", 10)
    plain = docs.select(docs[id_column].cast("long").alias("id"), docs[text_column].cast("string").alias("text"))
    plain = plain.select("id", "text", F.coalesce(remainder > 0, F.lit(False)).alias("learn"), F.coalesce(remainder == 0, F.lit(False)).alias("held_out"))
    counts, blocked, block = word_counts(plain)
    unigrams = unigrams_of(counts, plain.where("learn").count())
    texts = numbered(blocked, block, counts, unigrams)
    model = Model(unigrams)
    train(texts.where("learn").select("words", F.pmod(F.xxhash64("id"), F.lit(ROUNDS)).alias("round")), model)
    found = score(texts, model).withColumn("train_tokens", F.lit(unigrams.tokens).cast("long"))
    return found.withColumnRenamed("id", id_column)


def op10_maxent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document: smoothed unigram score and the maximum-entropy model's log10 probability."""
    return score_texts(read(spark, sf_dir, "documents"))
