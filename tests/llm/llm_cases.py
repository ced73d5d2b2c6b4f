"""Small documents with every awkward case, and plain-Python twins of the word rules."""

from __future__ import annotations

import random
import re

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCUMENTS = "doc_id long, text string, block int, id string, n_words string, row double"


def words(text, kind=SPACED, lower=False):
    text = text or ""
    return kind.findall(text.translate(UPPER) if lower else text)


def sentence(r, n):
    return " ".join(r.choice(["alpha", "beta", "Gamma", "delta,", "épsilon", "zeta", "eta.", "theta", "日本", "42"]) + str(r.randint(0, 60)) for _ in range(n))


def documents(seed=1, plain=60):
    """(doc_id, text): nulls, empty and very long texts, copies, near copies, shared passages."""
    r = random.Random(seed)
    rows = [(k, sentence(r, r.choice([1, 3, 4, 12, 13, 30, 80]))) for k in range(plain)]
    passage, base = sentence(r, 55), sentence(r, 120)
    rows += [(100 + k, f"{sentence(r, 20)}\n{passage}\t{sentence(r, r.randint(0, 9))}") for k in range(8)]
    for k in range(14):
        changed = base.split(" ")
        for _ in range(k % 5):
            changed[r.randrange(len(changed))] = f"new{r.randint(0, 999)}"
        rows.append((200 + k, " ".join(changed)))
    rows += [(300 + k, base) for k in range(5)]  # copies
    rows += [(400, None), (401, ""), (402, " \n\t "), (403, "one"), (404, "one"), (405, "One"), (406, "a b c"), (407, "A b c")]
    rows += [(408, "x " * 3000), (409, sentence(r, 9000)), (410, "y" * 200_000), (411, "\x00nul 'll l'll don't    　x")]
    rows += [(-5, passage), (None, passage), (None, None), (2**40, base)]
    rows += [(3, rows[3][1])]  # a repeated row
    r.shuffle(rows)
    return rows


def frame(spark, rows):
    """With columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, 7, "x", "y", 0.5) for i, t in rows], DOCUMENTS)


def same_rows(found, expected):
    key = lambda row: tuple((v is None, str(v)) for v in row)
    found, expected = sorted(map(tuple, found), key=key), sorted(map(tuple, expected), key=key)
    assert len(found) == len(expected)
    for a, b in zip(found, expected, strict=True):
        assert a == b
