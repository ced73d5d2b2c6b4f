"""Approximate nearest neighbours by inner product over balanced posting lists.

A bounded sample of vectors is halved again and again at the median between two means, which gives
clusters of equal size; their means are the centroids, linked into a neighbour graph that every
task holds in memory and searches best-first. Every vector joins the list of its nearest centroid
and, near a boundary, further lists: centroids within ``(1 + replicate)`` times the nearest
distance, but none that lies nearer to a chosen centroid than to the vector. A query opens all
lists whose centroids lie within a ratio of its nearest distance, however many they are. The ratio
is measured on each table: the true neighbours of ``PROBES`` queries among all vectors, and the
ratio that opens a list of each; the one that reaches ``RECALL`` of them is taken. Members of the
opened lists are compared on the original vectors in double precision.

Lists that lie side by side form at most ``REGIONS`` regions; a query is sent once to a region, with
the numbers of the lists it opens there.

Inner product becomes distance by one more component, sqrt(largest norm**2 - norm**2), which is 0
for queries. Equal vectors are one entry with the smallest of their ids, as many as a result can
hold; equal queries are one search. Large regions are cut into pieces by a hash of the id, each a
task of its own. The index is fitted on ``SAMPLE`` rows, the number of lists is at most ``MAX_LISTS``;
every vector is in a list.

Vectors that are null, zero, hold null or non-finite components, or have another length than most
do not take part, nor do rows with a null id. Rows that share an id and a vector are one candidate.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rillstone.llm.common import read, stored

SAMPLE = 20000
MAX_LISTS = 2048
LIST_SIZE = 256
REGIONS = 32
#: Rows of one piece of a region.
PIECE = 32768
NEIGHBOURS_IN_GRAPH = 24
BEAM = 32
REPLICAS = 6
REPLICATE = 0.12
#: Queries whose true neighbours set the ratio of opened lists, and the share of these to be reached.
PROBES = 256
RECALL = 0.97


@dataclass
class Lists:
    """Centroids (with the extra component), their neighbour graph, and what completes a vector."""

    centroids: np.ndarray
    graph: np.ndarray
    entries: np.ndarray
    largest: float

    def distances(self, queries: np.ndarray) -> np.ndarray:
        """From each query (its extra component is 0) to every centroid."""
        plain = self.centroids[:, :-1]
        return np.sqrt(np.maximum((queries**2).sum(1)[:, None] + (self.centroids**2).sum(1) - 2 * queries @ plain.T, 0))

    def search(self, points: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Best-first search of the graph for many points at once: centroids, nearest first, and
        their squared distances. Every round opens each point's nearest unopened centroid."""
        n, total = len(points), len(self.centroids)
        beam = min(beam, total)
        norms = (self.centroids**2).sum(1)
        own = (points**2).sum(1)

        def distance(which: np.ndarray) -> np.ndarray:
            return own[:, None] + norms[which] - 2 * np.einsum("nkd,nd->nk", self.centroids[which], points)

        ids = np.full((n, beam), total)
        dist = np.full((n, beam), np.inf)
        opened = np.zeros((n, beam), bool)
        seen = np.zeros((n, total + 1), bool)
        seen[:, total] = True  # stands for no centroid
        new = np.tile(self.entries, (n, 1))
        rows = np.arange(n)[:, None]
        while True:
            fresh = ~seen[rows, new]
            d = np.where(fresh, distance(np.minimum(new, total - 1)), np.inf)
            seen[rows, new] = True
            ids, dist = np.concatenate([ids, np.where(fresh, new, total)], 1), np.concatenate([dist, d], 1)
            opened = np.concatenate([opened, ~fresh], 1)
            order = np.argsort(dist, 1, kind="stable")[:, :beam]
            ids, dist, opened = ids[rows, order], dist[rows, order], opened[rows, order]
            waiting = ~opened & np.isfinite(dist)
            if not waiting.any():
                return ids, dist
            nearest = waiting.argmax(1)
            has = waiting.any(1)
            opened[np.arange(n)[has], nearest[has]] = True
            centre = ids[np.arange(n), nearest]
            new = np.where(has[:, None], self.graph[np.minimum(centre, total - 1)], total)


def _halves(points: np.ndarray, size: int, rng: np.random.Generator) -> list[np.ndarray]:
    """Means of clusters of equal size, by halving at the median between two means."""
    open_, means = [points], []
    while open_:
        some = open_.pop()
        if len(some) <= size:
            means.append(some.mean(0))
            continue
        a, b = some[rng.integers(len(some))], some[rng.integers(len(some))]
        for _ in range(4):
            side = some @ (a - b)
            low = side <= np.median(side)
            if low.all() or not low.any():
                low = np.arange(len(some)) < len(some) // 2
            a, b = some[~low].mean(0), some[low].mean(0)
        order = np.argsort(some @ (a - b), kind="stable")
        half = len(some) // 2
        open_ += [some[order[:half]], some[order[half:]]]
    return means


def fit_lists(sample: np.ndarray, largest: float, lists: int) -> Lists:
    whole = np.concatenate([sample, np.sqrt(np.maximum(largest**2 - (sample**2).sum(1), 0))[:, None]], 1)
    means = np.array(_halves(whole, max(1, -(-len(whole) // lists)), np.random.default_rng(7)))
    # In the order of halving, so that lists of near numbers lie side by side.
    centroids = means[np.sort(np.unique(means, axis=0, return_index=True)[1])]
    near = np.empty((len(centroids), min(NEIGHBOURS_IN_GRAPH, len(centroids))), np.int64)
    norms = (centroids**2).sum(1)
    for a in range(0, len(centroids), 512):
        d = norms[None, :] - 2 * centroids[a : a + 512] @ centroids.T
        near[a : a + 512] = np.argsort(d, 1, kind="stable")[:, : near.shape[1]]
    # Some links back, so that every centroid can be reached, and entries all over the graph.
    back = np.full((len(centroids), 4), len(centroids))
    fill = np.zeros(len(centroids), int)
    for c, others in enumerate(near[:, 1:5].tolist()):
        for o in others:
            if fill[o] < 4 and c not in near[o]:
                back[o, fill[o]] = c
                fill[o] += 1
    entries = np.unique(np.linspace(0, len(centroids) - 1, 32).astype(int))
    return Lists(centroids, np.concatenate([near, back], 1), entries, largest)


def _matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def usable_vectors(table: DataFrame, id_column: str, vector_column: str) -> tuple[DataFrame, int]:
    """id, vector (array<double>) of the rows that take part, and the vectors' length."""
    v = F.col("vector")
    plain = table.select(table[id_column].cast("long").alias("id"), table[vector_column].cast("array<double>").alias("vector")).where("id IS NOT NULL AND vector IS NOT NULL")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    plain = plain.where(~bad & F.exists(v, lambda x: x != 0))
    width = plain.groupBy(F.size(v).alias("width")).count().orderBy(F.desc("count"), "width").first()
    width = width["width"] if width else 0
    return plain.where(F.size(v) == width), width


def _largest(queries: np.ndarray, points: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of queries, rows of points and products of each query's n largest, ties included."""
    products = queries @ points.T
    if products.shape[1] > n:
        least = np.partition(products, -n, axis=1)[:, -n]
        row, column = np.nonzero(products >= least[:, None] - 1e-9)
    else:
        row, column = (x.ravel() for x in np.indices(products.shape))
    return row, column, (queries[row] * points[column]).sum(1)


def _best(row: np.ndarray, ids: np.ndarray, score: np.ndarray, n: int) -> np.ndarray:
    """Places of each row's n largest scores (ties: the smaller id), each id once."""
    order = np.lexsort((ids, -score, row))
    new = np.ones(len(order), bool)
    new[1:] = (row[order][1:] != row[order][:-1]) | (ids[order][1:] != ids[order][:-1])
    order = order[new]
    own = row[order]
    return order[np.arange(len(own)) - np.searchsorted(own, own) < n]


def open_ratio(placed: DataFrame, probes: np.ndarray, lists: Lists, k: int) -> float:
    """The least ratio of distances that reaches ``RECALL`` of the probes' true neighbours among
    all vectors of ``placed`` (id, vector, lists). Each task sends at most k + 1 rows per probe."""
    if not len(probes) or len(lists.centroids) == 1:
        return 1.0
    distance = lists.distances(probes)
    ratio = distance / np.maximum(distance.min(1), 1e-12)[:, None]
    shared = placed.sparkSession.sparkContext.broadcast((probes, ratio))

    def compare(batches):
        queries, ratio = shared.value
        kept = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), np.zeros(0), np.zeros(0, bool)]
        for batch in batches:
            for a in range(0, batch.num_rows, 8192):
                part = batch.slice(a, 8192)
                points, ids = _matrix(part.column(1), queries.shape[1]), part.column(0).to_numpy()
                row, column, score = _largest(queries, points, k + 1)
                first = np.concatenate([[0], np.cumsum(pa.compute.list_value_length(part.column(2)).to_numpy())])
                members = part.column(2).flatten().to_numpy()
                need = np.array([ratio[r, members[first[c] : first[c + 1]]].min() for r, c in zip(row.tolist(), column.tolist(), strict=True)])
                kept = [np.concatenate(x) for x in zip(kept, (row, ids[column], score, need, (queries[row] == points[column]).all(1)), strict=True)]
                best = _best(kept[0], kept[1], kept[2], k + 1)
                kept = [x[best] for x in kept]
        other = ~kept[4]
        yield pa.RecordBatch.from_arrays([pa.array(x[other]) for x in kept[:4]], ["probe", "id", "score", "need"])

    found = placed.select("id", "vector", "lists").mapInArrow(compare, "probe long, id long, score double, need double")
    place = F.row_number().over(Window.partitionBy("probe").orderBy(F.desc("score"), "id"))
    needs = found.withColumn("place", place).where(F.col("place") <= k).select("need").toArrow()["need"].to_numpy()
    return float(np.quantile(needs, RECALL, method="higher")) if len(needs) else 1.0


def nearest(
    table: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", query_every: int = 20, k: int = 20, sample: int = SAMPLE, max_lists: int = MAX_LISTS
) -> DataFrame:
    """query_id, rank, id, score: the k nearest found of every row whose id is divisible by ``query_every``."""
    spark = table.sparkSession
    vectors, width = usable_vectors(table, id_column, vector_column)
    result = f"query_id long, rank int, {id_column} long, score double"
    if not width:
        return spark.createDataFrame([], result)
    count, largest = vectors.agg(F.count("*"), F.max(F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x)))).first()
    bounded = vectors.orderBy(F.xxhash64("id"), "id").limit(sample).select("vector").toArrow()
    lists = fit_lists(_matrix(bounded["vector"], width), largest, int(max(1, min(max_lists, count // LIST_SIZE, bounded.num_rows // 4))))
    shared = spark.sparkContext.broadcast(lists)

    def near_lists(points: np.ndarray) -> list[np.ndarray]:
        known, found = shared.value, []
        for a in range(0, len(points), 512):
            some = points[a : a + 512]
            extra = np.sqrt(np.maximum(known.largest**2 - (some**2).sum(1), 0))
            ids, dist = known.search(np.concatenate([some, extra[:, None]], 1), BEAM)
            dist = np.sqrt(np.maximum(dist, 0))
            inside = dist <= dist[:, :1] * (1 + REPLICATE) + 1e-12
            for row, d, keep in zip(ids, dist, inside, strict=True):
                chosen: list[int] = []
                for c, x in zip(row[keep].tolist(), d[keep].tolist(), strict=True):
                    if len(chosen) < REPLICAS and all(((known.centroids[c] - known.centroids[o]) ** 2).sum() >= x * x for o in chosen):
                        chosen.append(c)
                found.append(np.array(chosen))
        return found

    def place(batches):
        for batch in batches:
            found = near_lists(_matrix(batch.column(1), width)) if batch.num_rows else []
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([x.astype(np.int32) for x in found], pa.list_(pa.int32()))], ["id", "vector", "ids", "lists"])

    # Equal vectors: their smallest ids, enough for any result and the query itself.
    first = Window.partitionBy("vector").orderBy("id")
    entries = vectors.distinct().withColumn("number", F.row_number().over(first)).where(F.col("number") <= k + 1)
    entries = entries.groupBy("vector").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    entries = entries.select(F.col("ids")[0].alias("id"), "vector", "ids")
    placed = stored(entries.mapInArrow(place, "id long, vector array<double>, ids array<long>, lists array<int>"), "placed")
    same = placed.select("id", "ids")

    key = F.xxhash64("vector").alias("key")
    queries = stored(vectors.where(F.col("id") % query_every == 0).select("id", "vector", key), "queries")
    asked = queries.groupBy("key").agg(F.first("vector").alias("vector")).select(F.col("key").alias("id"), "vector")
    probes = asked.orderBy("id").limit(PROBES).select("vector").toArrow()["vector"]
    ratio = open_ratio(placed, _matrix(probes, width), lists, k)
    total = len(lists.centroids)
    regions = min(REGIONS, total)

    def ask(batches):
        region_of = np.arange(total) * regions // total
        for batch in batches:
            rows, region, opened = [], [], []
            points = _matrix(batch.column(1), width)
            for a in range(0, len(points), 512):
                dist = shared.value.distances(points[a : a + 512])
                for n, inside in enumerate(dist <= dist.min(1)[:, None] * ratio + 1e-12):
                    which = np.flatnonzero(inside).astype(np.int32)
                    own, begin = np.unique(region_of[which], return_index=True)
                    rows += [a + n] * len(own)
                    region += own.tolist()
                    opened += np.split(which, begin[1:])
            yield pa.RecordBatch.from_arrays([*(c.take(pa.array(rows, pa.int32())) for c in batch.columns), pa.array(region, pa.int32()), pa.array(opened, pa.list_(pa.int32()))], ["id", "vector", "region", "lists"])

    asked = stored(asked.mapInArrow(ask, "id long, vector array<double>, region int, lists array<int>"), "asked")
    region = lambda x: F.floor(x.cast("long") * regions / total).cast("int")
    members = placed.select("id", "vector", "lists", F.explode(F.array_distinct(F.transform("lists", region))).alias("region"))

    # Regions are at most REGIONS, so their lengths can be broadcast.
    lengths = F.broadcast(members.groupBy("region").agg(F.ceil(F.count("*") / PIECE).alias("pieces")))
    cut = members.join(lengths, "region").withColumn("piece", F.pmod(F.xxhash64("id"), "pieces"))
    ask_lengths = F.broadcast(asked.groupBy("region").agg(F.ceil(F.count("*") / PIECE).alias("turns")))
    cut = cut.join(ask_lengths, "region").withColumn("turn", F.explode(F.sequence(F.lit(0).cast("long"), F.col("turns") - 1)))
    asked = asked.join(ask_lengths, "region").withColumn("turn", F.pmod(F.xxhash64("id"), "turns"))
    asked = asked.join(lengths, "region").withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.col("pieces") - 1)))

    def rows_by_list(table: pa.Table) -> dict[int, np.ndarray]:
        column = table["lists"].combine_chunks()
        row = np.repeat(np.arange(len(column)), pa.compute.list_value_length(column).to_numpy(zero_copy_only=False))
        number = column.flatten().to_numpy()
        order = np.argsort(number, kind="stable")
        which, begin = np.unique(number[order], return_index=True)
        return dict(zip(which.tolist(), np.split(row[order], begin[1:]), strict=True))

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        q, v, score = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]
        if left.num_rows and right.num_rows:
            queries, points = _matrix(left["vector"], width), _matrix(right["vector"], width)
            ids, numbers = right["id"].to_numpy(), left["id"].to_numpy()
            held = {number: (rows, points[rows]) for number, rows in rows_by_list(right).items()}
            for a in range(0, len(queries), 256):
                found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
                for number, rows in rows_by_list(left.slice(a, 256)).items():
                    if number in held:
                        where, some = held[number]
                        row, column, exact = _largest(queries[a + rows], some, k + 1)
                        found.append((rows[row], ids[where[column]], exact))
                row, near, exact = (np.concatenate(x) for x in zip(*found, strict=True))
                best = _best(row, near, exact, k + 1)
                q.append(numbers[a + row[best]])
                v.append(near[best])
                score.append(exact[best])
        return pa.table({"key": pa.array(np.concatenate(q)), "id": pa.array(np.concatenate(v)), "score": pa.array(np.concatenate(score))})

    where = ["region", "piece", "turn"]
    found = asked.select("id", "vector", "lists", *where).groupBy(*where).cogroup(cut.select("id", "vector", "lists", *where).groupBy(*where)).applyInArrow(compare, "key long, id long, score double")
    found = found.groupBy("key", "id").agg(F.max("score").alias("score"))
    best = Window.partitionBy("key").orderBy(F.desc("score"), "id")
    found = found.withColumn("place", F.row_number().over(best)).where(F.col("place") <= k + 1)
    hits = F.array_sort(F.flatten(F.collect_list(F.transform("ids", lambda i: F.struct((-F.col("score")).alias("less"), i.alias("id"))))))
    hits = stored(found.join(same, "id").groupBy("key").agg(F.slice(hits, 1, k + 1).alias("hits")), "hits")
    own = F.slice(F.filter("hits", lambda h: h.id != F.col("query_id")), 1, k)
    rows = queries.select(F.col("id").alias("query_id"), "key").distinct().join(hits, "key").select("query_id", F.posexplode(own).alias("rank", "hit"))
    return rows.select("query_id", (F.col("rank") + 1).cast("int").alias("rank"), F.col("hit.id").alias(id_column), (-F.col("hit.less")).alias("score"))


def op8_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest found of every vector whose vec_id is divisible by 20."""
    return nearest(read(spark, sf_dir, "embeddings"))
