"""N-gram Jaccard self-join: documents whose shingle sets overlap by a given share, and their groups.

Two documents link when 100 * |A & B| >= percent * |A | B|. A partner of a set of n shingles holds at
least T = ceil(percent * n / 100) of them, so this is a T-occurrence search over inverted lists:

1. One packed exchange (:mod:`rillstone.llm.exchange`) gives the length of every shingle's inverted
   list. A document with fewer than T shingles whose list holds another document has no partner;
   most documents end here. The others store their shared shingles, shortest list first.
2. Equal sets collapse into one representative, the smallest id.
3. Short lists propose candidates: partners share one of the n - T + 1 shingles with the shortest
   lists. Each list first proposes only pairs with a few leaders; the links found contract groups
   of near copies. Then every pair that shares such a list and is not yet in one group is proposed,
   and dropped where the places of their last common shingle leave too few for T.
4. Candidates of a document are searched by DivideSkip: its short inverted lists are merged through
   a heap, its longest ones are probed by binary search, and those that reach T are links.

So links inside a group that is known already are not looked up, and no group's pairs are all made;
no link between groups is lost. Words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z. A text with
fewer words than a shingle is one shingle; a null or empty text has none and links with nothing. A
row with a null id links with nothing and has a null component. Repeated rows are equal sets.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillstone.llm import arrays, exchange
from rillstone.llm.common import read, stored
from rillstone.llm.components import connected_components

#: Leaders a list proposes pairs with before the exact round.
LEADERS = 6
#: Min-hashes of a set; pairs with a leader are looked up if at least LIKELY of them agree.
MIN_HASHES = 16
LIKELY = 10
#: Members of a list that are looked at together, and lists that one task has at once.
LIST_PIECE = 4096
ROWS_TOGETHER = 256
#: Pieces in which the rows of a set of equal texts look up their group.
SALTS = 16


def least_overlap(percent: int, a, b):
    """Least |A & B| of linked sets of a and b shingles."""
    return -(-percent * (a + b) // (100 + percent))


def divide_skip(lists: Sequence[Sequence[int]], threshold: int, skip: int | None = None) -> dict[int, int]:
    """Numbers that occur in at least ``threshold`` of the sorted lists, and how often.

    The ``skip`` longest lists are put aside. A number that reaches the threshold occurs in at
    least threshold - skip of the others, which are merged through a heap; for those numbers the
    long lists are probed by binary search.
    """
    by_length = sorted(lists, key=len)
    if skip is None:
        longest = len(by_length[-1]) if by_length else 0
        skip = int(threshold / (0.01 * np.log2(longest + 1) + 1)) if longest > 1 else 0
    skip = max(0, min(skip, threshold - 1, len(by_length)))
    short, long = by_length[: len(by_length) - skip], by_length[len(by_length) - skip :]
    found: dict[int, int] = {}
    number, count = None, 0
    for x in heapq.merge(*short):
        if x == number:
            count += 1
            continue
        if number is not None and count >= threshold - skip:
            found[number] = count
        number, count = x, 1
    if number is not None and count >= threshold - skip:
        found[number] = count
    for x in found:
        for probed in long:
            k = bisect_left(probed, x)
            found[x] += k < len(probed) and probed[k] == x
    return {x: c for x, c in found.items() if c >= threshold}


def _sets(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all rows (sorted within a row) and their rows."""
    hashes, rows = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for a, _, words in arrays.batch_words(texts, lower=True):
        h, at = arrays.window_hashes(words, size)
        row = words.doc[at]
        for short in range(1, size):
            only = np.flatnonzero(words.counts == short)
            if len(only):
                own = np.zeros(len(only), np.uint64)
                for k in range(short):
                    own = own * arrays.U64(arrays.BASE) + words.hash[words.first[only] + k]
                h, row = np.concatenate([h, arrays.mix(own + arrays.U64(short))]), np.concatenate([row, only])
        order = np.lexsort((h, row))
        h, row = h[order], row[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
        hashes.append(h[new])
        rows.append(row[new] + a)
    return np.concatenate(hashes), np.concatenate(rows)


SET_SCHEMA = "id long, n_shingles long, print1 long, print2 long, live boolean, posted int, shared array<long>, sketch array<int>"


def shingle_sets(docs: DataFrame, id_column: str, text_column: str, size: int, percent: int) -> DataFrame:
    """Per row its set size and two hashes of the set; for rows that may have a partner (``live``) the
    shingles that other rows hold too, shortest list first, of which the first ``posted`` propose
    candidates. ``posted`` counts from the front of the whole set, whose unshared shingles come first.
    ``sketch`` has min-hashes of the set."""
    plain = docs.select(docs[id_column].cast("long").alias("id"), docs[text_column].cast("string").alias("text"))
    grid = exchange.grid_for(plain)
    blocked, block = exchange.in_blocks(plain, "id", grid)

    def entries(table: pa.Table) -> pa.Table:
        h, _ = _sets(table["text"].combine_chunks(), size)
        distinct, counts = np.unique(h, return_counts=True)
        return exchange.packed(table[block][0].as_py(), grid, distinct, np.minimum(counts, 65535).astype(np.uint16))

    def merge(table: pa.Table) -> pa.Table:
        hashes, counts, sizes = exchange.unpacked(table, np.uint16)
        order, first, place = exchange.groups_of(hashes)
        total = np.minimum(np.add.reduceat(counts[order].astype(np.int64), first), 255).astype(np.uint8)
        each = np.empty(len(hashes), np.uint8)
        each[order] = total[place]
        return exchange.replies_of(table, sizes, [x.tobytes() for x in np.split(each, np.cumsum(sizes)[:-1])])

    def apply(table: pa.Table, replies: pa.Table) -> pa.Table:
        rows = table.num_rows
        h, row = _sets(table["text"].combine_chunks(), size)
        distinct, where = np.unique(h, return_inverse=True)
        length = np.concatenate([np.zeros(0, np.uint8), *exchange.reply_bytes(replies)])[where]
        n = np.bincount(row, minlength=rows)
        bounds = np.concatenate([[0], np.cumsum(n)])
        sums = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(arrays.mix(h * arrays.U64(k)))]) for k in (3, 5)]
        prints = [(s[bounds[1:]] - s[bounds[:-1]]).view(np.int64) for s in sums]
        needed = -(-percent * n // 100)
        many = np.bincount(row, weights=length >= 2, minlength=rows)
        live = (many >= needed) & (n > 0) & table["id"].is_valid().to_numpy(zero_copy_only=False)
        shared, sizes, sketches = [np.zeros(0, np.int64)], np.zeros(rows, np.int64), [None] * rows
        factors = arrays.mix(np.arange(1, MIN_HASHES + 1, dtype=np.uint64)) | np.uint64(1)
        for k in np.flatnonzero(live).tolist():
            own, df = h[bounds[k] : bounds[k + 1]], length[bounds[k] : bounds[k + 1]]
            sketches[k] = [int((arrays.mix(own * f) >> np.uint64(33)).min()) for f in factors]
            own = own[np.lexsort((own, df))][int((df < 2).sum()) :]
            shared.append(own.view(np.int64))
            sizes[k] = len(own)
        return pa.table(
            {
                "id": table["id"],
                "n_shingles": pa.array(n.astype(np.int64)),
                "print1": pa.array(prints[0]),
                "print2": pa.array(prints[1]),
                "live": pa.array(live),
                "posted": pa.array((n - needed + 1).astype(np.int32)),
                "shared": pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(np.concatenate(shared))),
                "sketch": pa.array(sketches, pa.list_(pa.int32())),
            }
        )

    return exchange.ask(blocked, block, entries, merge, apply, SET_SCHEMA)


def _links(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) that link, by DivideSkip over the candidates of each u that come together."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            u, v, n_u, n_v = (batch.column(k).to_numpy() for k in range(4))
            (off_u, set_u), (off_v, set_v) = (
                (c.offsets.to_numpy(), c.values.to_numpy()) for c in (batch.column(4), batch.column(5))
            )
            cuts = [*np.flatnonzero(np.concatenate([[True], u[1:] != u[:-1]])).tolist(), len(u)] if len(u) else [0]
            keep = []
            for a, b in zip(cuts, cuts[1:], strict=False):
                query = np.sort(set_u[off_u[a] : off_u[a + 1]])
                index: list[list[int]] = [[] for _ in range(len(query))]
                for c in range(a, b):
                    own = set_v[off_v[c] : off_v[c + 1]]
                    at = np.searchsorted(query, own)
                    at[at == len(query)] = 0
                    for k in at[query[at] == own].tolist() if len(query) else ():
                        index[k].append(c)
                needed = least_overlap(percent, n_u[a:b], n_v[a:b])
                found = divide_skip([x for x in index if x], int(needed.min()))
                keep += [c for c, overlap in found.items() if overlap >= needed[c - a]]
            yield pa.RecordBatch.from_arrays([pa.array(u[keep]), pa.array(v[keep])], ["u", "v"])

    left = sets.select(F.col("id").alias("u"), F.col("n").alias("n_u"), F.col("shared").alias("set_u"))
    right = sets.select(F.col("id").alias("v"), F.col("n").alias("n_v"), F.col("shared").alias("set_v"))
    rows = pairs.join(right, "v").join(left, "u").select("u", "v", "n_u", "n_v", "set_u", "set_v")
    return rows.mapInArrow(search, "u long, v long")


def jaccard_groups(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", size: int = 4, percent: int = 85) -> DataFrame:
    """Per row: id, n_shingles, component_id (the least id reachable by links, its own included)."""
    found = stored(shingle_sets(docs, id_column, text_column, size, percent), "sets")
    live = found.where("live")
    equal = live.groupBy("print1", "print2", F.col("n_shingles").alias("n")).agg(F.min("id").alias("rep"))
    firsts = live.select("id", "posted", "shared", "sketch", "print1", "print2", F.col("n_shingles").alias("n"))
    equal = stored(equal, "classes")
    # Only a representative meets its class; its other rows have no equal id.
    mine = equal.select(F.col("rep").alias("id"), "print1", "print2", "n")
    sets = firsts.join(mine, ["id", "print1", "print2", "n"], "left_semi").dropDuplicates(["id", "print1", "print2"])
    sets = stored(sets.withColumn("m", F.size("shared").cast("long")), "representatives")

    # The first ``posted`` of a whole set, without the unshared ones; places count from 1.
    front = F.slice("shared", 1, F.greatest(F.lit(0), F.col("posted") - (F.col("n") - F.col("m")).cast("int")))
    postings = sets.select("id", "n", "m", F.posexplode(front).alias("pos", "s")).select("s", "id", "n", "m", (F.col("pos") + 1 + F.col("n") - F.col("m")).alias("place"))
    postings = stored(postings, "postings")

    ranks = [F.xxhash64("id", F.lit(k)) for k in range(LEADERS - 2)]
    named = [F.struct(r.alias("r"), F.col("id").alias("leader"), F.col("n").alias("n_b")) for r in (F.col("n"), -F.col("n"), *ranks)]
    leaders = postings.groupBy("s").agg(F.count("*").alias("length"), F.array_distinct(F.array(*(F.struct(F.min(x).leader.alias("leader"), F.min(x).n_b.alias("n_b")) for x in named))).alias("l"))
    leaders = stored(leaders.where("length > 1").select("s", F.explode("l").alias("l")).select("s", "l.*"), "leaders")
    near = postings.join(leaders, "s").where(f"id <> leader AND least(n, n_b) * 100 >= greatest(n, n_b) * {percent}")
    pairs = stored(near.select(F.least("id", "leader").alias("u"), F.greatest("id", "leader").alias("v")).distinct(), "pairs")
    left, right = (sets.select(F.col("id").alias(x), F.col("sketch").alias(f"sketch_{x}")) for x in ("u", "v"))
    agree = F.aggregate(F.zip_with("sketch_u", "sketch_v", lambda x, y: (x == y).cast("int")), F.lit(0), lambda x, y: x + y)
    likely = stored(pairs.join(left, "u").join(right, "v").where(agree >= LIKELY).select("u", "v"), "likely")
    links = stored(_links(likely, sets, percent), "links")

    known = connected_components(links)
    placed = stored(postings.join(known, F.col("id") == F.col("node"), "left").select("s", "id", "n", "m", "place", F.coalesce("component", "id").alias("component")), "placed")
    pairs = _across(placed, percent)
    more = stored(_links(stored(pairs, "pairs"), sets, percent), "links")

    group = connected_components(links.union(more))
    named = equal.join(group, F.col("rep") == F.col("node"), "left").select("print1", "print2", F.col("n").alias("n_shingles"), F.coalesce("component", "rep").alias("component_id"))
    named = named.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = found.where("live").withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int"))
    joined = salted.select("id", "n_shingles", "print1", "print2", "salt").join(named, ["print1", "print2", "n_shingles", "salt"])
    alone = found.where("NOT live").select("id", "n_shingles", F.col("id").alias("component_id"))
    return joined.select("id", "n_shingles", "component_id").union(alone).withColumnRenamed("id", id_column)


def _across(placed: DataFrame, percent: int) -> DataFrame:
    """Pairs (u, v) of documents of two groups that share a list and may link.

    A list is open if it has members of several groups; those outside its main group ask. An asking
    document meets the open lists it is in, packed into arrays, and counts in how many of them each
    other document is and where: its last place leaves room for only so many common shingles. Lists
    are cut by their members' hashes, so that a piece of any list is bounded and all that two
    documents share is counted in one place.
    """
    sizes = placed.groupBy("s", "component").count()
    lists = sizes.groupBy("s").agg(F.count("*").alias("groups"), F.sum("count").alias("length"), F.max_by("component", F.struct("count", "component")).alias("main"))
    lists = stored(lists.where("groups > 1").select("s", "length", "main"), "lists")
    longest = lists.agg(F.max("length")).first()[0] or 1
    members = stored(placed.join(lists.select("s", "main"), "s"), "members")
    asking = stored(members.where("component <> main").select("id").distinct().withColumn("asks", F.lit(True)), "asking")
    members = stored(members.join(asking, "id", "left").withColumn("asks", F.coalesce("asks", F.lit(False))), "members")
    piece = F.pmod(F.xxhash64("id"), F.lit(-(-longest // LIST_PIECE))).cast("int")
    pieces = members.groupBy("s", piece.alias("piece")).agg(F.collect_list(F.struct("id", "n", "m", "place", "component", "asks")).alias("entries"))
    asked = members.where("asks").select("s", *(F.col(c).alias(f"q_{c}") for c in ("id", "n", "m", "place", "component")))
    rows = asked.join(stored(pieces, "pieces"), "s")
    buckets = max(1, asked.count() // ROWS_TOGETHER)
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("q_id"), F.lit(buckets)).cast("int"))

    def count(table: pa.Table) -> pa.Table:
        entries = table["entries"].combine_chunks()
        per_row = entries.value_lengths().to_numpy()
        flat = entries.flatten()
        id_, n, m, place, component = (flat.field(c).to_numpy() for c in ("id", "n", "m", "place", "component"))
        asks = flat.field("asks").to_numpy(zero_copy_only=False)
        q_id, q_n, q_m, q_place, q_component = (np.repeat(table[f"q_{c}"].to_numpy(), per_row) for c in ("id", "n", "m", "place", "component"))
        # Linked sets hold no more in common than: the lesser place up to a common shingle and the
        # lesser rest after it; the fewer shared shingles.
        room = np.minimum(np.minimum(place, q_place) + np.minimum(n - place, q_n - q_place), np.minimum(m, q_m))
        keep = (component != q_component) & (~asks | (q_id < id_)) & (room * (100 + percent) >= (n + q_n) * percent)
        u, v = q_id[keep], id_[keep]
        order = np.lexsort((v, u))
        u, v = u[order], v[order]
        first = np.flatnonzero(np.concatenate([[True], (u[1:] != u[:-1]) | (v[1:] != v[:-1])])[: len(u)])
        if not len(first):
            return pa.table({"u": pa.array([], pa.int64()), "v": pa.array([], pa.int64())})
        rest = np.minimum((n - place)[keep][order], (q_n - q_place)[keep][order])
        both = (n + q_n)[keep][order][first]
        most = np.diff(np.append(first, len(u))) + np.minimum.reduceat(rest, first)
        may = most * (100 + percent) >= both * percent
        return pa.table({"u": pa.array(u[first][may]), "v": pa.array(v[first][may])})

    return rows.groupBy("bucket", "piece").applyInArrow(count, "u long, v long")


def op3_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document: size of its set of 4-word shingles and its group at a Jaccard of 0.85."""
    return jaccard_groups(read(spark, sf_dir, "documents"))
