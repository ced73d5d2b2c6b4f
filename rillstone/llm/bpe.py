"""Byte-level BPE encoding and decoding with the ``tokenizers`` library over Arrow batches.

The vocabulary is a rank file: a line per token with its bytes in base64 and its rank. The library
works on characters, so each byte stands as one printable character (the usual byte table), and a
token's rank is its id. A rank file gives no merge rules; every way to split a token into two
tokens is a rule, in the order of the ranks, so that the lowest rank merges first as it does in
the ``tiktoken`` library. One case is left: where a token can overlap itself (x+y = y+z), equal
ranks must merge from the left, and rules have an order. Pieces in which that can happen are found
by their tokens and bytes and merged by :meth:`ByteBpe.merged` instead.

Pieces repeat, so each distinct piece of a batch is encoded once; numpy passes over the batch's
characters find where the matches of :data:`public_tokenizers.PATTERN` begin (:func:`piece_starts`).
Every text is decoded again and compared with its bytes; one that differs (a hash collision) is
encoded by itself.

Nulls are empty texts; a text without tokens has the hash of nothing. Repeated rows give repeated
rows, extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import os
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from heapq import heappop, heappush

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from rillstone.llm import arrays
from rillstone.llm.common import read, releasing

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: Distinct pieces kept between batches by one Python worker.
CACHE_PIECES = 1_000_000
CHUNK_BYTES = 2 << 20
#: Pieces given to the library at once: its results hold far more than the ids.
PIECES_AT_ONCE = 8192


def byte_characters() -> list[str]:
    """Byte -> character: printable Latin-1 bytes stand for themselves, others from U+0100 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(others)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class ByteBpe:
    """A tokenizer made from ranks; ids are ranks."""

    def __init__(self, ranks: dict[bytes, int]):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a Spark task has one core
        from tokenizers import Tokenizer, models

        self.ranks = ranks
        table = byte_characters()
        self.byte_of = {c: b for b, c in enumerate(table)}

        def spell(token: bytes) -> str:
            return "".join(table[b] for b in token)

        rules, overlaps, own_overlap = [], set(), set()
        for token in sorted(ranks, key=ranks.get):
            splits = [(token[:k], token[k:]) for k in range(1, len(token)) if token[:k] in ranks and token[k:] in ranks]
            rules += [(spell(x), spell(y)) for x, y in splits]
            tails = {y: x for x, y in splits}
            double = {tails[y] + y + z for y, z in splits if y in tails and tails[y] != z}
            overlaps |= double
            own_overlap |= {token} if double else set()
        self.tokenizer = Tokenizer(models.BPE({spell(t): r for t, r in ranks.items()}, rules))
        self.overlap = re.compile(b"|".join(map(re.escape, sorted(overlaps))) or b"(?!)")
        size = max(ranks.values(), default=-1) + 1
        self.spelling = str.maketrans(dict(enumerate(table)))
        self.token_bytes = [b""] * size
        inside = re.compile(b"|".join(map(re.escape, sorted(own_overlap))) or b"(?!)")
        #: Tokens that hold one that can overlap itself.
        self.overlapping = np.zeros(size, bool)
        for token, rank in ranks.items():
            self.token_bytes[rank] = token
            self.overlapping[rank] = inside.search(token) is not None
        self.lengths = np.fromiter(map(len, self.token_bytes), np.int64, size)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.flat = np.frombuffer(b"".join(self.token_bytes), np.uint8)

    def merged(self, piece: bytes) -> list[int]:
        """Ids of one piece, always merging the lowest rank, from the left.

        Neighbours that may merge wait in a heap by rank and place; an entry whose parts have merged
        otherwise since is passed over. The work grows with n log n for n bytes.
        """
        n = len(piece)
        after = list(range(1, n + 1))  # where the part that begins here ends
        before = list(range(-1, n))  # where the part before it begins
        heap: list[tuple[int, int, int]] = []

        def offer(left: int) -> None:
            if left >= 0 and after[left] < n:
                end = after[after[left]]
                rank = self.ranks.get(piece[left:end])
                if rank is not None:
                    heappush(heap, (rank, left, end))

        for i in range(n - 1):
            offer(i)
        gone = bytearray(n)
        while heap:
            _, left, end = heappop(heap)
            right = after[left]
            if gone[left] or right >= n or after[right] != end:
                continue
            gone[right] = 1
            after[left] = end
            if end < n:
                before[end] = left
            offer(left)
            offer(before[left])
        ids, at = [], 0
        while at < n:
            ids.append(self.ranks[piece[at : after[at]]])
            at = after[at]
        return ids

    def encode_pieces(self, pieces: list[str]) -> list[list[int]]:
        """Ids of pieces, each spelled in the characters of the byte table."""
        found: list[list[int]] = []
        for k in range(0, len(pieces), PIECES_AT_ONCE):
            found += [e.ids for e in self.tokenizer.encode_batch_fast(pieces[k : k + PIECES_AT_ONCE], add_special_tokens=False)]
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        ids = np.fromiter((t for own in found for t in own), np.int64, int(lengths.sum()))
        doubtful = np.repeat(np.arange(len(found)), lengths)[self.overlapping[ids]]
        for i in np.unique(doubtful).tolist():
            piece = bytes(self.byte_of[c] for c in pieces[i])
            if self.overlap.search(piece):
                found[i] = self.merged(piece)
        return found

    def encode(self, text: str) -> tuple[list[int], list[tuple[int, int]]]:
        """Ids of a text, and of each token the first and one past the last character it touches.

        A token may begin or end inside a character; the characters it shares then appear in the
        spans of both tokens.
        """
        ids = next(encode_array(self, PieceCache(), pa.array([text])))[1].tolist()
        character = np.repeat(np.arange(len(text)), [len(c.encode()) for c in text])
        ends = np.cumsum([len(self.token_bytes[i]) for i in ids], dtype=np.int64)
        begins = ends - [len(self.token_bytes[i]) for i in ids]
        return ids, [(int(character[a]), int(character[b - 1]) + 1) for a, b in zip(begins, ends, strict=True)]

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """Bytes of a sequence of ids."""
        return self.flat[arrays.ragged(self.starts[ids], self.lengths[ids])]

    def decode_text(self, ids: list[int]) -> list[str]:
        """What each token adds to the text: a character split over tokens comes with its last one.

        Bytes that form no character give U+FFFD.
        """
        import codecs

        decoder = codecs.getincrementaldecoder("utf-8")("replace")
        parts = [decoder.decode(self.token_bytes[i]) for i in ids]
        rest = decoder.decode(b"", final=True)
        if parts:
            parts[-1] += rest
        return parts


@lru_cache(maxsize=2)
def load(path: str) -> ByteBpe:
    return ByteBpe(read_ranks(path))


#: Code points of white space.
WHITE_SPACE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
LETTER, NUMBER, OTHER, SPACE = range(4)


@lru_cache(maxsize=1)
def character_classes() -> np.ndarray:
    kinds = {"L": LETTER, "N": NUMBER}
    table = np.fromiter((kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)), np.uint8, 0x110000)
    table[WHITE_SPACE] = SPACE
    return table


def piece_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Byte positions at which the matches of :data:`public_tokenizers.PATTERN` begin, text by text.

    A run of one class is a piece, with one space before it. The last character of a run of white
    space is a piece of its own unless it is that space or ends the text. An apostrophe that
    begins a piece takes one of the seven endings after it.
    """
    n = len(data)
    if not n:
        return np.zeros(0, np.int64)
    byte_at = np.flatnonzero((data & 0xC0) != 0x80)
    code = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
    kind = character_classes()[code]
    opens = np.zeros(n + 1, bool)
    opens[offsets] = True
    opens = opens[byte_at]  # first character of a text
    closes = np.append(opens[1:], True)
    before = np.concatenate([[SPACE], kind[:-1]])
    start = opens | (kind != before)
    spaces = kind == SPACE
    start[:-1] |= spaces[:-1] & ~spaces[1:] & ~closes[:-1]
    after_space = np.concatenate([[False], code[:-1] == 0x20]) & ~opens & ~spaces
    start &= ~after_space
    for i in np.flatnonzero((code == 0x27) & start & ~closes).tolist():
        rest = chr(code[i + 1]) + ("" if closes[i + 1] else chr(code[i + 2]))
        length = 2 if rest in ("re", "ve", "ll") else 1 if rest[0] in "stmd" else 0
        if length:
            start[i + 1] = False
            if not closes[i + length] and kind[i + length + 1] == LETTER:
                start[i + length + 1] = True
    return byte_at[start]


class PieceCache:
    """Distinct pieces and their ids, sorted by the pieces' hashes."""

    def __init__(self):
        self.clear()

    def clear(self):
        self.hash = np.zeros(0, np.uint64)
        self.start = np.zeros(0, np.int64)
        self.length = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def places(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.hash, hashes)
        known = at < len(self.hash)
        known[known] = self.hash[at[known]] == hashes[known]
        return at, known

    def add(self, hashes: np.ndarray, found: list[list[int]]):
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        ids = np.fromiter((t for ids in found for t in ids), np.uint32, int(lengths.sum()))
        starts = len(self.ids) + np.cumsum(lengths) - lengths
        at = np.searchsorted(self.hash, hashes)
        self.hash = np.insert(self.hash, at, hashes)
        self.start = np.insert(self.start, at, starts)
        self.length = np.insert(self.length, at, lengths)
        self.ids = np.concatenate([self.ids, ids])


def encode_chunk(bpe: ByteBpe, cache: PieceCache, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts of a chunk, and where each text's ids begin (one more entry at the end)."""
    start = piece_starts(data, offsets)
    end = np.append(start[1:], len(data))
    h = arrays.segment_hashes(data, start, end)
    distinct, where, place = np.unique(h, return_index=True, return_inverse=True)
    if len(cache.hash) + len(distinct) > CACHE_PIECES:
        cache.clear()
    _, known = cache.places(distinct)
    new = where[~known]
    if len(new):
        lengths = (end - start)[new]
        spelled = data[arrays.ragged(start[new], lengths)].tobytes().decode("latin-1").translate(bpe.spelling)
        ends = np.cumsum(lengths).tolist()
        cache.add(distinct[~known], bpe.encode_pieces([spelled[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]))
    at, _ = cache.places(distinct)
    at = at[place]
    lengths = cache.length[at]
    ids = cache.ids[arrays.ragged(cache.start[at], lengths)]
    before = np.zeros(len(start) + 1, np.int64)
    np.cumsum(lengths, out=before[1:])
    return ids, before[np.searchsorted(start, offsets)]


def encode_array(bpe: ByteBpe, cache: PieceCache, texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(row, ids, decoded bytes) of every text."""
    offsets, data = arrays.text_buffer(texts)
    for a, b in arrays.row_chunks(offsets, CHUNK_BYTES):
        part, cuts = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        ids, first = encode_chunk(bpe, cache, part, cuts)
        decoded = bpe.decode(ids)
        right = np.array_equal(decoded, part)
        ends = np.concatenate([[0], np.cumsum(bpe.lengths[ids])])
        for i in range(b - a):
            own = ids[first[i] : first[i + 1]]
            text = decoded[ends[first[i]] : ends[first[i + 1]]]
            if not right and not np.array_equal(text, part[cuts[i] : cuts[i + 1]]):
                alone, end = part[cuts[i] : cuts[i + 1]], cuts[i + 1] - cuts[i]
                pieces = np.split(alone, piece_starts(alone, np.array([0, end]))[1:])
                own = np.array([t for p in pieces for t in bpe.merged(p.tobytes())], np.uint32)
                text = bpe.decode(own)
            yield a + i, own, text


def encode_documents(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", path: str | None = None, with_ids: bool = True) -> DataFrame:
    """Encode every text and decode it again: id, n_tokens, ids_sha256, decoded_sha256 and, if
    wanted, ``ids`` and the ``decoded`` text. ``path`` is a rank file that every executor has."""
    path = path or public_tokenizers.path(VOCABULARY)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, cache = load(path), PieceCache()
        for batch in batches:
            counts, sums, texts, ids = [], [], [], []
            decoded_sums = []
            for _, own, text in encode_array(bpe, cache, batch.column(1)):
                little = own.astype("<u4")
                counts.append(len(own))
                sums.append(hashlib.sha256(little.tobytes()).hexdigest())
                decoded_sums.append(hashlib.sha256(text.tobytes()).hexdigest())
                if with_ids:
                    ids.append(own.astype(np.int32))
                    texts.append(text.tobytes().decode())
            columns = [batch.column(0), pa.array(counts, pa.int64()), pa.array(sums, pa.string()), pa.array(decoded_sums, pa.string())]
            names = ["id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                columns += [pa.array(ids, pa.list_(pa.int32())), pa.array(texts, pa.string())]
                names += ["ids", "decoded"]
            yield pa.RecordBatch.from_arrays(columns, names)

    kind = docs.schema[id_column].dataType.simpleString()
    schema = f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    if with_ids:
        schema += ", ids array<int>, decoded string"
    found = docs.select(docs[id_column].alias("id"), docs[text_column].cast("string").alias("text")).mapInArrow(releasing(encode), schema)
    return found.withColumnRenamed("id", id_column)


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document: token count, hash of its ids, hash of the bytes decoded from them."""
    return encode_documents(read(spark, sf_dir, "documents"), with_ids=False)
