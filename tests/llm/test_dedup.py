"""Substring dedup, n-gram Jaccard join and components against brute force."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import pytest
from llm_cases import documents, frame, same_rows, sentence, words

from rillstone.llm import exchange, jaccard
from rillstone.llm.common import docs_per_block
from rillstone.llm.components import connected_components
from rillstone.llm.jaccard import divide_skip, jaccard_groups
from rillstone.llm.substrings import dedup_substrings


def brute_substrings(rows, size):
    owner = {}
    for i, t in rows:
        w = words(t)
        for k in range(len(w) - size + 1):
            if i is not None:
                s = tuple(w[k : k + size])
                owner[s] = min(owner.get(s, i), i)
    out = []
    for i, t in rows:
        w, gone = words(t), set()
        if i is not None:
            for k in range(len(w) - size + 1):
                if owner[tuple(w[k : k + size])] < i:
                    gone |= set(range(k, k + size))
        spans = []
        for k in sorted(gone):
            if spans and spans[-1][1] == k:
                spans[-1][1] = k + 1
            else:
                spans.append([k, k + 1])
        out.append((i, len(w), len(gone), str(spans), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return out


@pytest.mark.parametrize("size,blocks,parts", [(13, None, None), (3, 7, 5), (1, 3, 2)])
def test_substrings(spark, monkeypatch, size, blocks, parts):
    if blocks:
        monkeypatch.setattr(exchange, "grid_for", lambda docs: exchange.Grid(blocks, parts))
    rows = documents()
    found = dedup_substrings(frame(spark, rows), window=size).collect()
    same_rows([(r.doc_id, r.n_words, r.n_removed, str([list(x) for x in r.removed]), r.kept) for r in found], brute_substrings(rows, size))


def test_substrings_of_nothing(spark):
    assert dedup_substrings(frame(spark, [])).count() == 0
    same_rows(dedup_substrings(frame(spark, [(1, None), (None, "a")])).select("doc_id", "n_words", "kept").collect(), [(1, 0, ""), (None, 1, "a")])


def brute_groups(rows, size, percent):
    sets, group = {}, {}
    for i, t in rows:
        w = words(t, lower=True)
        shingles = {tuple(w[k : k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set()
        sets[i] = shingles
    ids = [i for i in sets if i is not None]
    group = {i: i for i in ids}

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for x in ids:
        for y in ids:
            if x < y and sets[x] and sets[y]:
                common = len(sets[x] & sets[y])
                if 100 * common >= percent * (len(sets[x]) + len(sets[y]) - common):
                    a, b = root(x), root(y)
                    group[max(a, b)] = min(a, b)
    nulls = {t: len(brute_sets(t, size)) for i, t in rows if i is None}
    return [(i, len(sets[i]), root(i)) if i is not None else (None, nulls[t], None) for i, t in rows]


def brute_sets(t, size):
    w = words(t, lower=True)
    return {tuple(w[k : k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set()


@pytest.mark.parametrize("percent,piece", [(85, 4096), (60, 3)])
def test_groups(spark, monkeypatch, percent, piece):
    monkeypatch.setattr(jaccard, "LIST_PIECE", piece)
    rows = documents(seed=4, plain=30)
    found = jaccard_groups(frame(spark, rows), percent=percent)
    same_rows(found.select("doc_id", "n_shingles", "component_id").collect(), brute_groups(rows, 4, percent))


def test_chained_near_copies(spark, monkeypatch):
    """Neighbours link, ends do not; without leaders the exact round finds every link."""
    monkeypatch.setattr(jaccard, "LIKELY", 99)
    r = random.Random(9)
    base = sentence(r, 160).split(" ")
    rows = []
    for k in range(24):
        rows.append((500 - k, " ".join(base)))
        base[(7 * k) % len(base)] = f"step{k}"
    expected = brute_groups(rows, 4, 85)
    assert len({g for _, _, g in expected}) < len(rows)
    same_rows(jaccard_groups(frame(spark, rows)).select("doc_id", "n_shingles", "component_id").collect(), expected)


def test_groups_of_nothing(spark):
    assert jaccard_groups(frame(spark, [])).count() == 0
    same_rows(jaccard_groups(frame(spark, [(1, ""), (2, None), (3, "")])).collect(), [(1, 0, 1), (2, 0, 2), (3, 0, 3)])


def test_divide_skip_counts_every_list():
    r = random.Random(2)
    for _ in range(200):
        lists = [sorted(r.sample(range(40), r.randint(0, 30))) for _ in range(r.randint(0, 9))]
        for threshold in (1, 2, 5):
            counts = Counter(x for own in lists for x in own)
            expected = {x: c for x, c in counts.items() if c >= threshold}
            for skip in (None, 0, 1, 3, 8):
                assert divide_skip(lists, threshold, skip) == expected


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(k, k + 1) for k in range(40)] + [(1000, 1001 + k) for k in range(30)] + [(5, 5)]
    found = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert found == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(1000, 1031), 1000)}
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_block_size_is_bounded():
    assert docs_per_block(0) == 512 and docs_per_block(10**12) == 16384


def test_pipeline_kept_text_hash(spark):
    rows = [(1, "a b c d e f g h i j k l m n"), (2, "z a b c d e f g h i j k l m n")]
    got = {r.doc_id: hashlib.sha256(r.kept.encode()).hexdigest() for r in dedup_substrings(frame(spark, rows)).collect()}
    assert got[2] == hashlib.sha256(b"z").hexdigest()


def test_rows_without_an_id_are_spread(spark):
    docs = spark.range(6000).selectExpr("if(id % 3 = 0, null, id) AS id", "concat('text ', id) AS text")
    blocked, block = exchange.in_blocks(docs, "id", exchange.Grid(12, 3))
    sizes = [r["count"] for r in blocked.groupBy(block).count().collect()]
    assert len(sizes) == 12 and max(sizes) < 2 * 6000 / 12
