"""Spelling variants against a comparison of every word with every other."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from llm_cases import UPPER, documents, frame, same_rows

from rillstone.llm import variants
from rillstone.llm.variants import Deal, letter_counts, letters, near_words, one_edit, op13_variants, spelling_groups, trie_pairs, vocabulary

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def slow_one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) - len(short) == 1 and any(long[:k] + long[k + 1 :] == short for k in range(len(long)))


def brute_counts(rows, every=199, shortest=6, least=5):
    counts = Counter()
    for i, text in rows:
        for run in RUN.findall(text or ""):
            run = run.translate(UPPER)
            h = zlib.crc32(f"{i}:{run}".encode())
            if i is not None and h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += len(run) >= shortest
    return {w: n for w, n in counts.items() if n >= least}


def brute_groups(counts, factor=5):
    near = {w: [o for o in counts if slow_one_edit(w, o)] for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-counts[o], o), default=None)
        form[w] = best if best is not None and counts[best] >= factor * counts[w] else None
    out = []
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, counts[w], len(near[w]), counts.get(form[w])))
    return out


def some_words(r, n):
    stems = ["".join(r.choice("eniatrxéß÷") for _ in range(r.randint(6, 9))) for _ in range(n // 6)]
    found = set(stems)
    while len(found) < n:
        w = r.choice(stems)
        for _ in range(r.randint(1, 2)):
            k, letter = r.randrange(len(w)), r.choice("eniatÿzé")
            w = r.choice([w[:k] + w[k + 1 :], w[:k] + letter + w[k:], w[:k] + letter + w[k + 1 :]])
        found.add(w)
    return sorted(found)


def test_one_edit():
    r = random.Random(2)
    words = some_words(r, 150) + ["", "a", "aa", "ab", "aab", "aaab"]
    for a in words:
        for b in words:
            assert one_edit(a, b) == (a != b and slow_one_edit(a, b))


@pytest.mark.parametrize("leaf", [1, 4, 1000])
def test_trie_finds_all_within_the_budget(leaf):
    r = random.Random(leaf)
    counts = letter_counts(*letters(some_words(r, 240) + ["e" * 300, "e" * 301, "en" * 20]))
    ordered = counts[np.lexsort(counts.T[::-1])]
    found = sorted((int(a), int(b)) for q, w in trie_pairs(ordered, counts, leaf) for a, b in zip(q, w, strict=True))
    apart = counts[:, None, :].astype(int) - ordered[None]
    fits = (np.maximum(apart, 0).sum(2) <= 1) & (np.maximum(-apart, 0).sum(2) <= 1)
    assert found == [(int(a), int(b)) for a, b in np.argwhere(fits)]
    assert not list(trie_pairs(ordered[:0], counts)) and not list(trie_pairs(ordered, counts[:0]))


def edge_words():
    r = random.Random(8)
    long = "".join(r.choice("eniatr") for _ in range(200))
    words = some_words(r, 500) + ["e" * 80, "e" * 79, "e" * 81, long, long[1:], long[:99] + "z" + long[100:], long[:99] + "zz" + long[101:]]
    words += ["e" * 63, "e" * 64, "e" * 65, "n" * 15 + "i", "n" * 16 + "i", "n" * 17 + "i", "n" * 17 + "it"]
    return {w: r.choice([5, 6, 7, 30, 200, 5000]) for w in words}


@pytest.mark.parametrize("bucket,levels", [(16384, None), (40, 3), (7, 12)])
def test_groups(spark, monkeypatch, bucket, levels):
    monkeypatch.setattr(variants, "BUCKET", bucket)
    if levels:
        monkeypatch.setattr(variants.math, "log", lambda *_: levels)
    counts = edge_words()
    rows = list(counts.items())
    half = [(w, n // 2, 1) for w, n in rows[:50]] + [(w, n - n // 2, 2) for w, n in rows[:50]]  # repeated words
    df = spark.createDataFrame(half + [(w, n, 3) for w, n in rows[50:]] + [(None, 9, 4), ("", 9, 5)], "word string, n long, bucket int")
    same_rows(spelling_groups(df).collect(), brute_groups(counts))


def test_each_pair_once(spark):
    counts = edge_words()
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    found = [frozenset((r.word, r.other)) for r in near_words(df).collect()]
    words = sorted(counts)
    assert Counter(found) == Counter(frozenset((a, b)) for k, a in enumerate(words) for b in words[:k] if slow_one_edit(a, b))


def test_vocabulary(spark):
    r = random.Random(5)
    rows = documents() + [(k, " ".join(r.choice(["Harbour", "harbor", "HÄRBOUR", "colours", "x1y", "étéété"]) for _ in range(40))) for k in range(500, 600)]
    for every in (199, 3):
        found = vocabulary(frame(spark, rows), every=every).collect()
        assert {r.word: r.n for r in found} == brute_counts(rows, every)
    same_rows(spelling_groups(vocabulary(frame(spark, rows), every=3)).collect(), brute_groups(brute_counts(rows, 3)))


def test_nothing_and_strange_words(spark):
    assert spelling_groups(vocabulary(frame(spark, []))).count() == 0
    assert near_words(spark.createDataFrame([], "word string, n long")).count() == 0
    with pytest.raises(ValueError):
        letters(["日本"])


def test_deal_reaches_every_near_key():
    r = random.Random(1)
    words = some_words(r, 400)
    deal = Deal(5, 97)
    keys = deal.keys(letter_counts(*letters(words)))
    reach = [set() for _ in words]
    for rows, found in deal.reached(keys):
        for k, key in zip(rows, found, strict=True):
            reach[k].add(int(key))
    for a, w in enumerate(words):
        for b, o in enumerate(words):
            if keys[a] <= keys[b] and slow_one_edit(w, o):
                assert int(keys[b]) in reach[a]


def test_query_is_brute_force(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    same_rows(op13_variants(spark, sf_dir).collect(), brute_groups(brute_counts(docs)))
