"""Byte-level BPE against tiktoken and its own round trip."""

from __future__ import annotations

import hashlib
import random
import time

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import documents, frame, same_rows

from rillstone.llm import bpe


@pytest.fixture(scope="module")
def ours():
    return bpe.load(P.path(bpe.VOCABULARY))


@pytest.fixture(scope="module")
def theirs(ours):
    return tiktoken.Encoding("test", pat_str=P.PATTERN, mergeable_ranks=ours.ranks, special_tokens={})


def encode(ours, texts):
    return [ids.tolist() for _, ids, _ in bpe.encode_array(ours, bpe.PieceCache(), pa.array(texts, pa.string()))]


@settings(max_examples=300, deadline=None)
@given(texts=st.lists(st.text("aeins 'stdmrvl.!9é日 　\n\t\x00𝒳", max_size=40), max_size=6))
def test_ids_equal_tiktoken(ours, theirs, texts):
    assert encode(ours, texts) == [theirs.encode_ordinary(t) for t in texts]


def test_overlapping_tokens_merge_from_the_left(ours, theirs):
    r = random.Random(5)
    texts = ["".join(r.choice(["es", "e", "se", "an", "a", "na", "ere", "er", "-", "--", " "]) for _ in range(r.randint(1, 14))) for _ in range(3000)]
    assert encode(ours, texts) == [theirs.encode_ordinary(t) for t in texts]
    for text in texts[:300]:
        if " " not in text and "-" not in text:
            assert ours.merged(text.encode()) == theirs.encode_ordinary(text)


def test_documents(spark, theirs):
    rows = documents()
    found = bpe.encode_documents(frame(spark, rows)).collect()
    expected = []
    for i, t in rows:
        ids = theirs.encode_ordinary(t or "")
        expected.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest(), str(ids), t or ""))
    same_rows([(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256, str(r.ids), r.decoded) for r in found], expected)
    assert bpe.encode_documents(frame(spark, [])).count() == 0


def test_offsets_and_split_characters(ours):
    text = "é日𝒳x 日本"
    ids, spans = ours.encode(text)
    raw = text.encode()
    assert b"".join(ours.token_bytes[i] for i in ids) == raw
    assert spans[0][0] == 0 and spans[-1][1] == len(text)
    for (a, b), i in zip(spans, ids, strict=True):
        assert ours.token_bytes[i] in text[a:b].encode()
    assert "".join(ours.decode_text(ids)) == text
    assert any(ours.token_bytes[i].decode("utf-8", "replace").count("�") for i in ids)  # some character is split
    assert ours.encode("") == ([], []) and ours.decode_text([]) == []


def test_a_full_cache_changes_nothing(ours, theirs, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_PIECES", 20)
    monkeypatch.setattr(bpe, "CHUNK_BYTES", 100)
    texts = [t or "" for _, t in documents()][:40]
    assert encode(ours, texts) == [theirs.encode_ordinary(t) for t in texts]


def test_long_runs_of_overlapping_tokens(ours, theirs):
    for text in ("an" * 700, "ana" * 301 + "x", "hahaha" * 150, "es" * 333 + "e"):
        assert ours.merged(text.encode()) == theirs.encode_ordinary(text)
    began = time.process_time()
    assert ours.decode(np.array(encode(ours, ["an" * 100_000])[0])).tobytes() == b"an" * 100_000
    assert time.process_time() - began < 30  # two thousand letters took two seconds when the work was quadratic
