"""Corpus-wide facts about hashes (of words, shingles, windows) in one shuffle of packed arrays.

Documents are dealt into blocks by a hash of id and text, so that many rows without an id, or with the
same one, are spread like others. Each block sends its distinct hashes, sorted
and packed, one row per hash range; a range sees what all blocks hold of its hashes and sends each
block one packed reply in the order of its request; blocks and replies meet again by block.

A hash that is in every document is one entry per block, so no hash is hot. A range holds an even
share of the hashes and a block a bounded number of documents, and both numbers grow with the
table, so no task grows with it. Both users of the blocks name the same exchange of the texts,
which Spark runs once.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillstone.llm.common import docs_per_block, fresh_name, released

ENTRIES = "block int, part int, hashes binary, facts binary"
REPLIES = "block int, part int, reply binary"


@dataclass(frozen=True)
class Grid:
    blocks: int
    parts: int

    def edges(self) -> np.ndarray:
        """Lower ends of the hash ranges, but for the first."""
        return np.array([(k << 64) // self.parts for k in range(1, self.parts)], np.uint64)

    def split(self, distinct: np.ndarray) -> np.ndarray:
        """Where each range begins among sorted hashes, with one more entry at the end."""
        return np.concatenate([[0], np.searchsorted(distinct, self.edges()), [len(distinct)]]).astype(np.int64)


def grid_for(docs: DataFrame, docs_per_part: int = 4096) -> Grid:
    n = docs.count()
    return Grid(max(1, -(-n // docs_per_block(n))), max(1, -(-n // docs_per_part)))


def in_blocks(docs: DataFrame, id_column: str, grid: Grid) -> tuple[DataFrame, str]:
    name = fresh_name(docs, "block")
    dealt = F.pmod(F.xxhash64(F.col(id_column), F.col("text")), F.lit(grid.blocks))
    return docs.withColumn(name, dealt.cast("int")), name


def planes(values: np.ndarray) -> bytes:
    """Numbers byte by byte: all lowest bytes, then all second ones and so on. Sorted hashes as
    differences, and small facts, leave the higher ones zero, which the shuffle's codec removes."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.dtype.itemsize).T).tobytes()


def numbers(packed: pa.Scalar, kind: np.dtype) -> np.ndarray:
    """What ``planes`` packed."""
    raw = np.frombuffer(packed.as_buffer(), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(raw.T).view(kind).ravel()


def packed(block: int, grid: Grid, distinct: np.ndarray, facts: np.ndarray) -> pa.Table:
    """Rows of ENTRIES of one block: its sorted distinct hashes and a fixed-width fact for each."""
    cuts = grid.split(distinct)
    full = [k for k in range(grid.parts) if cuts[k] < cuts[k + 1]]
    return pa.table(
        {
            "block": pa.array([block] * len(full), pa.int32()),
            "part": pa.array(full, pa.int32()),
            "hashes": pa.array([planes(np.diff(distinct[cuts[k] : cuts[k + 1]], prepend=np.uint64(0))) for k in full], pa.binary()),
            "facts": pa.array([planes(facts[cuts[k] : cuts[k + 1]]) for k in full], pa.binary()),
        }
    )


def unpacked(entries: pa.Table, kind: np.dtype) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All hashes and facts of a range, and how many came from each row."""
    hashes = [np.cumsum(numbers(x, np.uint64), dtype=np.uint64) for x in entries["hashes"]]
    facts = [numbers(x, kind) for x in entries["facts"]]
    return np.concatenate(hashes), np.concatenate(facts), np.fromiter(map(len, hashes), np.int64, len(hashes))


def groups_of(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order that sorts the hashes, where each distinct one begins in it, and its index per place."""
    order = np.argsort(hashes, kind="stable")
    ordered = hashes[order]
    new = np.ones(len(ordered), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    return order, np.flatnonzero(new), np.cumsum(new) - 1


def replies_of(entries: pa.Table, sizes: np.ndarray, replies: list[bytes]) -> pa.Table:
    return pa.table({"block": entries["block"], "part": entries["part"], "reply": pa.array(replies, pa.binary())})


def reply_bytes(replies: pa.Table) -> list[np.ndarray]:
    """The replies to one block, in the order of the ranges."""
    order = np.argsort(replies["part"].to_numpy(), kind="stable")
    rows = replies["reply"]
    return [np.frombuffer(rows[int(k)].as_buffer(), np.uint8) for k in order]


def ask(
    blocked: DataFrame,
    block: str,
    entries: Callable[[pa.Table], pa.Table],
    merge: Callable[[pa.Table], pa.Table],
    apply: Callable[[pa.Table, pa.Table], pa.Table],
    schema: str,
) -> DataFrame:
    """Blocks -> entries -> replies -> blocks with their replies -> rows of ``schema``."""
    asked = blocked.groupBy(block).applyInArrow(lambda table: released(entries, table), ENTRIES)
    replies = asked.groupBy("part").applyInArrow(lambda table: released(merge, table), REPLIES)
    both = blocked.groupBy(block).cogroup(replies.groupBy("block"))
    return both.applyInArrow(lambda table, answers: released(apply, table, answers), schema)
