"""Array words, windows and hashes against regular expressions."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import ALNUM, SPACED, documents, words

from rillstone.llm import arrays

TEXTS = st.lists(st.none() | st.text("aB é　\n\t.9日\x00", max_size=30), max_size=8)


def read_words(texts, kind, lower):
    found = []
    for _, _, w in arrays.batch_words(pa.array(texts, pa.string()), kind, lower):
        spelled = [w.data[a:b].tobytes().decode() for a, b in zip(w.start, w.end, strict=True)]
        found += [spelled[a:b] for a, b in zip(w.first, w.first[1:], strict=False)]
    return found


@settings(max_examples=200, deadline=None)
@given(TEXTS, st.booleans())
def test_words_equal_the_patterns(texts, lower):
    assert read_words(texts, arrays.NOT_SPACE, lower) == [words(t, SPACED, lower) for t in texts]
    assert read_words(texts, arrays.ALNUM, True) == [words(t, ALNUM, True) for t in texts]


@pytest.mark.parametrize("chunk", [1, 50, 1 << 20])
def test_chunks_and_slices_do_not_matter(monkeypatch, chunk):
    monkeypatch.setattr(arrays, "CHUNK_BYTES", chunk)
    texts = [t for _, t in documents()]
    offsets, data = arrays.text_buffer(pa.array(["before", *texts], pa.string()).slice(1))
    found = []
    for a, b in arrays.row_chunks(offsets, chunk):
        found.append(arrays.words_of(data[offsets[a] : offsets[b]], offsets[a : b + 1]).hash)
    whole = arrays.words_of(data, offsets).hash
    assert np.array_equal(np.concatenate(found), whole)
    spelled = [w for t in texts for w in words(t)]
    assert len(set(spelled)) == len(np.unique(whole)) and len(spelled) == len(whole)


def test_window_hashes_tell_windows_apart():
    texts = ["a b c d", "a b c d e", "b c d", "ab c d", "a bc d", None, "d c b a"]
    (_, _, w), = arrays.batch_words(pa.array(texts, pa.string()))
    h, at = arrays.window_hashes(w, 3)
    expected = [tuple(words(t)[k : k + 3]) for t in texts for k in range(len(words(t)) - 2)]
    assert len(h) == len(expected) == len(at)
    for i in range(len(h)):
        for j in range(len(h)):
            assert (h[i] == h[j]) == (expected[i] == expected[j])


def test_empty_array():
    assert list(arrays.batch_words(pa.array([], pa.string()))) == []
