"""Substring dedup: word windows that an earlier document already holds are cut out.

Every window of ``window`` consecutive words gets a Rabin-Karp hash. Spark finds the smallest
document id of each hash over the whole table (see :mod:`rillstone.llm.exchange`); a window whose
hash starts in a document with a smaller id is a repeat, and overlapping repeats merge into maximal
intervals of words to remove. Windows are judged on the input.

Words are ``[^\\x20\\x09-\\x0D]+``, unchanged. Null and empty texts have no words; texts shorter than
a window lose nothing; rows with a null id are neither smaller nor larger than any and stay whole;
rows that share an id do not remove each other's words. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillstone.llm import arrays, exchange
from rillstone.llm.common import read

WINDOW = 13


def _ordered(table: pa.Table) -> pa.Table:
    return table.take(pc.sort_indices(table["id"])).combine_chunks()


def _windows(table: pa.Table, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each window of the rows with an id, and its row."""
    usable = table["id"].is_valid().to_numpy(zero_copy_only=False)
    hashes, rows = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for a, _, words in arrays.batch_words(table["text"].combine_chunks()):
        h, at = arrays.window_hashes(words, window)
        row = words.doc[at] + a
        hashes.append(h[usable[row]])
        rows.append(row[usable[row]])
    return np.concatenate(hashes), np.concatenate(rows)


def _owners(table: pa.Table, window: int):
    """Distinct window hashes, the first row of each, and for every window its row and hash's place."""
    h, row = _windows(table, window)
    order, first, place = exchange.groups_of(h)
    where = np.empty(len(h), np.int64)
    where[order] = place
    return h[order][first], row[order][first], row, where


def dedup_substrings(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", window: int = WINDOW, carry: tuple[str, ...] = ()) -> DataFrame:
    """Per row: id, n_words, n_removed, ``removed`` (maximal [first, last + 1) word intervals) and
    ``kept`` (the other words joined by one space). ``carry`` names columns to pass along in the
    struct ``carried``, with the unchanged text where nothing was removed, so that no join is needed."""
    plain = docs.select(docs[id_column].cast("long").alias("id"), docs[text_column].cast("string").alias("text"), *([F.struct(*[docs[c].alias(c) for c in carry]).alias("carried")] if carry else []))
    grid = exchange.grid_for(plain)
    blocked, block = exchange.in_blocks(plain, "id", grid)

    def entries(table: pa.Table) -> pa.Table:
        number = table[block][0].as_py()
        table = _ordered(table)
        distinct, owner, _, _ = _owners(table, window)
        return exchange.packed(number, grid, distinct, table["id"].fill_null(0).to_numpy()[owner].astype(np.int64))

    def merge(table: pa.Table) -> pa.Table:
        hashes, ids, sizes = exchange.unpacked(table, np.int64)
        order, first, place = exchange.groups_of(hashes)
        smallest = np.minimum.reduceat(ids[order], first)
        repeat = np.empty(len(ids), bool)
        repeat[order] = ids[order] > smallest[place]
        return exchange.replies_of(table, sizes, [np.packbits(x).tobytes() for x in np.split(repeat, np.cumsum(sizes)[:-1])])

    def apply(table: pa.Table, replies: pa.Table) -> pa.Table:
        table = _ordered(table)
        ids = table["id"].fill_null(0).to_numpy()
        distinct, owner, row, where = _owners(table, window)
        sizes = np.diff(grid.split(distinct))
        flags = [np.unpackbits(x, count=int(n)) for x, n in zip(exchange.reply_bytes(replies), sizes[sizes > 0], strict=True)]
        elsewhere = np.concatenate([np.zeros(0, np.uint8), *flags]).astype(bool)
        repeat = elsewhere[where] | (ids[row] > ids[owner][where])
        usable = table["id"].is_valid().to_numpy(zero_copy_only=False)
        n_words, n_removed, kept, spans, span_counts, done = [], [], [], [], [], 0
        for a, b, words in arrays.batch_words(table["text"].combine_chunks()):
            at = np.flatnonzero(words.doc[: max(0, len(words.doc) - window + 1)] == words.doc[window - 1 :])
            at = at[usable[words.doc[at] + a]]
            mine = repeat[done : done + len(at)]
            done += len(at)
            edge = np.zeros(len(words.doc) + 1, np.int32)
            np.add.at(edge, at[mine], 1)
            np.add.at(edge, at[mine] + window, -1)
            cut = np.cumsum(edge[:-1]) > 0
            n_words.append(words.counts)
            n_removed.append(np.bincount(words.doc[cut], minlength=b - a))
            kept.append(_joined(words, ~cut, b - a))
            begins = cut & np.concatenate([[True], ~cut[:-1] | (words.doc[1:] != words.doc[:-1])])[: len(cut)]
            ends = cut & np.concatenate([~cut[1:] | (words.doc[1:] != words.doc[:-1]), [True]])[: len(cut)]
            base = words.first[words.doc]
            pairs = np.stack([(np.arange(len(cut)) - base)[begins], (np.arange(len(cut)) - base)[ends] + 1], 1)
            spans.append(pairs.ravel())
            span_counts.append(np.bincount(words.doc[begins], minlength=b - a))
        flat, counts = np.concatenate(spans).astype(np.int32), np.concatenate(span_counts)
        offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
        pairs = pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, 2, dtype=np.int32)), pa.array(flat))
        whole = pa.chunked_array(kept, pa.string())
        columns = {}
        if carry:
            removed = pa.array(np.concatenate(n_removed) > 0)
            whole = pc.if_else(removed, whole.combine_chunks(), table["text"].combine_chunks())
            columns["carried"] = table["carried"]
        return pa.table(
            {
                "id": table["id"],
                "n_words": pa.array(np.concatenate(n_words).astype(np.int64)),
                "n_removed": pa.array(np.concatenate(n_removed).astype(np.int64)),
                "removed": pa.ListArray.from_arrays(offsets, pairs),
                "kept": whole,
                **columns,
            }
        )

    schema = "id long, n_words long, n_removed long, removed array<array<int>>, kept string"
    if carry:
        schema += f", carried {plain.schema['carried'].dataType.simpleString()}"
    return exchange.ask(blocked, block, entries, merge, apply, schema).withColumnRenamed("id", id_column)


def _joined(words: arrays.Words, keep: np.ndarray, rows: int) -> pa.Array:
    """The kept words of each row, joined by one space."""
    start, length, doc = words.start[keep], (words.end - words.start)[keep], words.doc[keep]
    source = np.append(words.data, np.uint8(0x20))
    index = arrays.ragged(start, length + 1)
    ends = np.cumsum(length + 1)
    index[ends - 1] = len(words.data)  # the space after each word
    last = np.append(doc[1:] != doc[:-1], True) if len(doc) else np.zeros(0, bool)
    text = np.delete(source[index], ends[last] - 1)  # none after the last word of a row
    size = np.bincount(doc, weights=length + 1, minlength=rows).astype(np.int64)
    offsets = np.concatenate([[0], np.cumsum(np.maximum(size - 1, 0))]).astype(np.int32)
    return pa.StringArray.from_buffers(rows, pa.py_buffer(offsets.tobytes()), pa.py_buffer(text.tobytes()))


def op4_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document: word count, removed words, hash of what is kept."""
    found = dedup_substrings(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


#: Windows as word lists; the smallest id of each; words under a window of a smaller id.
OP4_SQL = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
starts AS (
  SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM words WHERE len(w) >= 13),
hashed AS (
  SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS s FROM starts),
least AS (SELECT s, min(doc_id) AS owner FROM hashed GROUP BY s),
gone AS (
  SELECT h.doc_id, unnest(range(h.i, h.i + 13)) AS k
  FROM hashed h JOIN least l ON h.s = l.s WHERE l.owner < h.doc_id),
cut AS (SELECT doc_id, list(DISTINCT k) AS ks FROM gone GROUP BY doc_id)
SELECT words.doc_id, CAST(len(w) AS BIGINT) AS n_words,
  CAST(coalesce(len(ks), 0) AS BIGINT) AS n_removed,
  sha256(array_to_string(CASE WHEN ks IS NULL THEN w ELSE list_filter(w, lambda x, j: NOT list_contains(ks, j)) END, ' '))
    AS kept_sha256
FROM words LEFT JOIN cut USING (doc_id)
"""
