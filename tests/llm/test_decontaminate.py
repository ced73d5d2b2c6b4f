"""Benchmark windows in texts against brute force."""

from __future__ import annotations

import pytest
from llm_cases import ALNUM, documents, frame, same_rows, words

from rillstone.llm.decontaminate import benchmark_blocks, verbatim_matches


def brute(rows, items, window):
    out = []
    for i, t in rows:
        w, hit, names = words(t, ALNUM, True), set(), set()
        for name, text in items:
            b = words(text, ALNUM, True)
            size = min(window, len(b))
            if name is None or not size:
                continue
            windows = {tuple(b[k : k + size]) for k in range(len(b) - size + 1)}
            for k in range(len(w) - size + 1):
                if tuple(w[k : k + size]) in windows:
                    hit |= set(range(k, k + size))
                    names.add(str(name))
        out.append((i, len(w), len(hit), ",".join(sorted(names))))
    return out


@pytest.mark.parametrize("window,block", [(10, 16 << 20), (4, 300), (1, 200)])
def test_hits(spark, window, block):
    rows = documents(seed=6)
    long = [t for _, t in rows if t and len(t.split()) > 60]
    items = [(k, " ".join(long[k].split()[5 : 5 + n])) for k, n in enumerate((30, 10, 12, 9))]
    items += [(10, "alpha1"), (11, None), (12, ""), (None, long[0]), (2, long[5][:200]), (13, "X-x"), (14, "...")]
    docs = frame(spark, rows)
    found = verbatim_matches(docs, spark.createDataFrame(items, "item_id int, text string"), window=window, block_bytes=block)
    got = [(r.row.doc_id, r.n_words, r.n_hit, ",".join(sorted({m.item_id for m in r.matches}))) for r in found.collect()]
    same_rows(got, brute(rows, items, window))


def test_blocks_hold_every_item_once(spark):
    items = spark.createDataFrame([(k, f"word{k} " * 20) for k in range(30)], "item_id int, text string")
    blocks = list(benchmark_blocks(items, "item_id", "text", 10, 500))
    assert len(blocks) > 1 and sorted(i for b in blocks for i in b.item_ids) == sorted(str(k) for k in range(30))


def test_longest_match_and_place(spark):
    item = " ".join(f"w{k}" for k in range(20))
    docs = frame(spark, [(1, "before it " + " ".join(f"W{k}," for k in range(3, 18)) + " after")])
    row = verbatim_matches(docs, spark.createDataFrame([(7, item)], "item_id int, text string")).first()
    assert [tuple(m) for m in row.matches] == [("7", 3, 2, 15)] and row.n_hit == 15


def test_empty_sides(spark):
    none = spark.createDataFrame([], "item_id int, text string")
    assert verbatim_matches(frame(spark, []), none).count() == 0
    assert [r.n_hit for r in verbatim_matches(frame(spark, [(1, "a b")]), none).collect()] == [0]
