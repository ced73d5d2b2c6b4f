"""Hard negatives against plain Python integers, and Strassen against the plain product."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from llm_cases import same_rows

from rillstone.llm import negatives
from rillstone.llm.negatives import Heaps, mine, strassen, windows_of

NAMES = "vec_id long, embedding array<float>, label int, twin string, region int, score string, place long"


@pytest.mark.parametrize("shape", [(1, 1, 1), (3, 5, 2), (64, 64, 64), (33, 70, 129), (0, 4, 3), (4, 0, 3)])
def test_strassen_is_exact(shape):
    m, k, n = shape
    r = np.random.default_rng(m + k + n)
    for top in (4, 2**20, 2**62):
        a, b = r.integers(-top, top, (m, k)), r.integers(-top, top, (k, n))
        assert (strassen(a, b, leaf=2) == a @ b).all()


def test_heaps_merge_in_any_order():
    r = np.random.default_rng(3)
    rows = [r.integers(0, 5, 400), r.integers(-3, 4, 400), r.integers(0, 90, 400), r.integers(0, 2, 400)]
    rows[1][:2] = np.iinfo(np.int64).min, np.iinfo(np.int64).max
    expected = []
    for owner in range(5):
        own = sorted((-int(s), int(i), int(t)) for o, s, i, t in zip(*rows, strict=True) if o == owner)
        expected += [(owner, -s, i, t) for s, i, t in own[:7]]
    for cut in (1, 13, 400):
        heaps = Heaps(7)
        for k in range(0, 400, cut):
            heaps.add(*(x[k : k + cut] for x in rows))
            heaps.merge()
        assert [tuple(map(int, x)) for x in zip(*heaps.rows(), strict=True)] == expected


def test_windows_are_exact():
    p = np.array([*range(-250, 250), 2**62, -(2**62), 2**55 + 1])
    low, high = windows_of(p, 30, 90)
    assert low.tolist() == [-((-30 * int(x)) // 100) for x in p]
    assert high.tolist() == [90 * int(x) // 100 for x in p]


def brute(rows, anchor, n_pos, n_neg, least=30, most=90):
    kept = {}
    for i, v, label in rows:
        if i is not None and v is not None and label is not None and all(x is not None and math.isfinite(x) for x in v):
            kept[i, label, tuple(v)] = [math.floor(256 * float(np.float32(x))) for x in v]
    out = []
    for (i, label, v), q in kept.items():
        if i % anchor:
            continue
        others = sorted(((-sum(a * b for a, b in zip(q, w)), j, m) for (j, m, _), w in kept.items() if j != i))  # noqa: B905
        for s, p, _ in [x for x in others if x[2] == label][:n_pos]:
            near = [x for x in others if x[2] != label and least * -s <= 100 * -x[0] <= most * -s][:n_neg]
            out += [(i, p, k + 1, x[1], -s, -x[0]) for k, x in enumerate(near)]
    return out


def vectors(seed, n, width=6):
    r = random.Random(seed)
    rows = [(k, [r.uniform(-1, 1) for _ in range(width)], r.choice([0, 0, 0, 1, 2, 9])) for k in range(n)]
    rows += [(1000 + k, rows[3][1], r.choice([0, 1])) for k in range(40)]  # one very common vector: ties
    rows += [(3, rows[3][1], rows[3][2]), (10, [0.5] * width, 1), (10, [0.25] * width, 0)]
    rows += [(None, [1.0] * width, 1), (2000, None, 1), (2010, [1.0] * width, None), (2020, [], 1), (2030, [0.5], 0)]
    rows += [(2040, [float("nan")] * width, 1), (2050, [float("inf")] + [0.0] * (width - 1), 1), (2060, [None, 1.0], 1), (-10, [0.9] * width, 0)]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("n,anchors,region,tile", [(200, None, None, None), (150, 5, 40, (3, 7))])
def test_negatives(spark, monkeypatch, n, anchors, region, tile):
    if anchors:
        monkeypatch.setattr(negatives, "ANCHORS", anchors)
        monkeypatch.setattr(negatives, "REGION", region)
        monkeypatch.setattr(negatives, "TILE", tile)
        monkeypatch.setattr(negatives, "LEAF", 2)
    rows = vectors(n, n)
    df = spark.createDataFrame([(i, v, m, "x", 1, "y", 2) for i, v, m in rows], NAMES)
    found = mine(df, "vec_id % 10 = 0", 3, 4)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    same_rows(found.collect(), brute(rows, 10, 3, 4))


def test_negatives_of_nothing(spark):
    empty = spark.createDataFrame([], NAMES)
    assert mine(empty, "vec_id % 10 = 0").count() == 0
    alone = spark.createDataFrame([(0, [1.0], 1, "x", 1, "y", 2), (1, [1e30], 2, "x", 1, "y", 2)], NAMES)
    assert mine(alone, "vec_id % 10 = 0").count() == 0
    assert mine(alone, "vec_id < 0").count() == 0
