"""Words of whole Arrow batches as numpy arrays.

A batch of texts lies in one UTF-8 buffer, so word ends, word hashes and window hashes of all its
texts come from a handful of numpy passes over that buffer; no Python object per word is made.
A word hash is a polynomial (Rabin-Karp) hash modulo 2**64 over a random value per byte. Equal
words have equal hashes everywhere; different words collide with a chance of about 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U64 = np.uint64
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
#: Bytes of text handled at once; a longer text is handled alone.
CHUNK_BYTES = 1 << 20
#: Longest text whose power tables are kept between calls.
KEPT_BYTES = 4 << 20

_powers: dict[int, np.ndarray] = {}


def _geometric(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; tables up to that of ``KEPT_BYTES`` are kept."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, CHUNK_BYTES + 2)
        have = np.empty(size, U64)
        have[0], filled = 1, 1
        while filled < size:
            step = min(filled, size - filled)
            have[filled : filled + step] = have[:step] * U64(pow(base, filled, 1 << 64))
            filled += step
        if n <= KEPT_BYTES:
            _powers[base] = have
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all bits (a bijection)."""
    h = h ^ (h >> U64(30))
    h = h * U64(0xBF58476D1CE4E5B9)
    h ^= h >> U64(27)
    h = h * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


#: One fixed random value per byte.
BYTE_VALUES = mix(np.arange(1, 257, dtype=U64) * U64(0x9E3779B97F4A7C15))

_spaces = np.zeros(256, bool)
_spaces[[0x20, *range(0x09, 0x0E)]] = True
#: Bytes of words ``[^\x20\x09-\x0D]+``.
NOT_SPACE = ~_spaces
#: Bytes of words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` (digits, lower-case letters, non-ASCII).
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True
#: Lower-cases A-Z, leaves other bytes.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


@dataclass
class Words:
    """Words of some texts, in order. ``doc`` is the row of each word within the chunk."""

    data: np.ndarray  #: bytes of the texts, lower-cased if asked for
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    doc: np.ndarray
    first: np.ndarray  #: first word of each row, with one more entry at the end

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def text_buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (rows + 1) and bytes of a string array; null is an empty text."""
    texts = texts.cast(pa.large_string()).fill_null("")
    if not len(texts):
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    low, high = int(offsets[0]), int(offsets[-1])
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[low:high] if raw is not None and high > low else np.zeros(0, np.uint8)
    return offsets - low, data


def row_chunks(offsets: np.ndarray, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``size`` bytes each; every row is in one of them."""
    row, rows = 0, len(offsets) - 1
    while row < rows:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + size, "right")) - 1)
        yield row, min(end, rows)
        row = min(end, rows)


def segment_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each ``data[start:end]``, whatever its place."""
    n = len(data)
    sums = np.zeros(n + 1, U64)
    np.cumsum(BYTE_VALUES[data] * _geometric(BASE, n), out=sums[1:])
    h = (sums[end] - sums[start]) * _geometric(INVERSE, n + 1)[start]
    return mix(h + (end - start).astype(U64))


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices ``starts[i] .. starts[i] + lengths[i] - 1`` of all i, one after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


def words_of(data: np.ndarray, offsets: np.ndarray, kind: np.ndarray = NOT_SPACE, lower: bool = False) -> Words:
    """Words of the texts ``data[offsets[i]:offsets[i + 1]]``; ``kind`` says which bytes are word bytes."""
    offsets = offsets - offsets[0]
    n = len(data)
    if lower:
        data = LOWER[data]
    inside = np.empty(n + 1, bool)
    inside[:n] = kind[data]
    inside[n] = False
    begins = inside[:n].copy()
    begins[1:] &= ~inside[: n - 1]
    ends = inside[:n].copy()
    ends[:-1] &= ~inside[1:n]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < n)]
    begins[cuts] = inside[cuts]
    ends[cuts - 1] = inside[cuts - 1]
    start = np.flatnonzero(begins)
    end = np.flatnonzero(ends) + 1
    h = segment_hashes(data, start, end)
    first = np.searchsorted(start, offsets)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    return Words(data, start, end, h, doc, first)


def batch_words(texts: pa.Array, kind: np.ndarray = NOT_SPACE, lower: bool = False) -> Iterator[tuple[int, int, Words]]:
    """(first row, last row + 1, words) for each chunk of an array of texts."""
    offsets, data = text_buffer(texts)
    for a, b in row_chunks(offsets):
        yield a, b, words_of(data[offsets[a] : offsets[b]], offsets[a : b + 1], kind, lower)


def window_hashes(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Rabin-Karp hash of every ``size`` consecutive words of one row, and the window's first word."""
    if len(words.hash) < size:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    at = np.flatnonzero(words.doc[: len(words.doc) - size + 1] == words.doc[size - 1 :])
    h = np.zeros(len(at), U64)
    for k in range(size):
        h = h * U64(BASE) + words.hash[at + k]
    return mix(h), at
