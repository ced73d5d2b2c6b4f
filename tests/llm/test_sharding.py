"""Sharding against the published loop, one key at a time."""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pytest
from llm_cases import documents, frame
from pyspark.sql import functions as F

from rillstone.llm import sharding
from rillstone.llm.sharding import assigned, grow_shards, jump_hash, moved, op12_sharding, sharded_documents, slotted, write_shards


def one_jump(key, n):
    b, j = -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_jumps_are_those_of_the_loop():
    keys = np.random.default_rng(1).integers(0, 2**64, 2000, np.uint64)
    keys[:3] = 0, 1, 2**64 - 1
    counts = (1, 2, 7, 8, 9, 100)
    for n, shard in zip(counts, jump_hash(keys, counts), strict=True):
        assert shard.tolist() == [one_jump(int(k), n) for k in keys]
    assert [x.tolist() for x in jump_hash(keys[:0], (3, 4))] == [[], []]


def test_growth_moves_only_into_new_shards(spark):
    keys = spark.range(20000).withColumnRenamed("id", "k")
    rows = assigned(keys, "k", 8).groupBy("shard", "grown_shard").count().collect()
    assert {r.grown_shard for r in rows if r.shard != r.grown_shard} == {8}
    goes = sum(r["count"] for r in rows if r.grown_shard == 8)
    assert abs(goes - 20000 / 9) < 200
    sizes = Counter()
    for r in rows:
        sizes[r.shard] += r["count"]
    assert len(sizes) == 8 and max(sizes.values()) < 1.06 * 2500
    assert {r.grown_shard for r in moved(keys, "k", 8, 11).collect()} <= {8, 9, 10}
    again = {r.k: r.shard for r in assigned(keys.repartition(7), "k", 8).collect()}
    assert again == {r.k: r.shard for r in assigned(keys, "k", 8).collect()}
    with pytest.raises(ValueError):
        assigned(keys, "k", 8, 7)


def check_slots(rows):
    by_shard = {}
    for r in rows:
        by_shard.setdefault(r.shard, []).append(r.slot)
    for slots in by_shard.values():
        assert sorted(slots) == list(range(len(slots)))


def test_documents_with_awkward_rows(spark, monkeypatch):
    monkeypatch.setattr(sharding, "PIECE_ROWS", 7)
    rows = documents() + [(None, f"null id {k}") for k in range(40)] + [(None, "same")] * 40
    found = sharded_documents(frame(spark, rows)).collect()
    assert len(found) == len(rows)
    check_slots(found)
    expected = Counter()
    for i, t in rows:
        raw = (t or "").encode()
        expected[i, len(raw) + 1, zlib.crc32(raw)] += 1
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in found) == expected
    assert len({r.shard for r in found if r.doc_id is None}) == 1
    assert all(r.grown_shard in (r.shard, 8) and r.law == "key" for r in found)


def test_slots_do_not_depend_on_storage(spark):
    docs = frame(spark, documents())
    one = {tuple(r) for r in sharded_documents(docs.repartition(1)).collect()}
    assert one == {tuple(r) for r in sharded_documents(docs.repartition(9)).collect()}


def test_clashing_names_and_nothing(spark):
    df = spark.range(50).selectExpr("id AS part", "id % 3 AS shard", "id AS zero", "id AS slot", "id AS hash", "id AS _metadata", "id AS place")
    found = slotted(assigned(df, "part", 4), "part")
    assert sorted(found.columns) == sorted(["part", "shard", "zero", "hash", "_metadata", "place", "grown_shard", "slot"])
    check_slots(found.collect())
    assert sharded_documents(frame(spark, [])).count() == 0


def test_written_shards_grow(spark, tmp_path):
    docs = frame(spark, documents()).withColumn("doc_id", F.coalesce("doc_id", F.lit(-9)))
    old, new = str(tmp_path / "old"), str(tmp_path / "new")
    write_shards(docs, "doc_id", 4, old, rows_per_file=5)
    stored = spark.read.parquet(old)
    assert stored.count() == docs.count() and set(stored.columns) == {*docs.columns, "shard"}
    grow_shards(spark, old, "doc_id", 4, 6, new)
    kept = assigned(stored, "doc_id", 4, 6).where("shard = grown_shard").select("doc_id", "shard")
    both = kept.union(spark.read.parquet(new).select("doc_id", "shard")).collect()
    assert Counter(map(tuple, both)) == Counter((r.doc_id, r.shard) for r in assigned(docs, "doc_id", 6).collect())


def test_query_takes_every_document(spark, sf_dir):
    found = op12_sharding(spark, sf_dir).collect()
    assert len(found) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    check_slots(found)
