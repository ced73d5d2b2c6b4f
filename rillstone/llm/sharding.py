"""Sharding by jump consistent hashing.

A row's shard follows from its key and the number of shards alone. The key's hash seeds a
generator whose draws are the numbers of shards at which the key would move ("jumps"); the
last jump below the number of shards is the shard. There is no ring and no table of any size. With one more
shard a key either stays or moves into the new one, which is about one key in n + 1.

Slots number the rows of a shard from 0 without gaps. Their order is that of the keys' hashes, so
it mixes a source's rows through the shard, does not depend on how the table is stored, and is found without
bringing a shard together: one range sort over all shards, in pieces cut at equal numbers of rows,
then the pieces' row counts give each piece its first slot.

Null keys are one key, as are equal keys: all their rows share a shard. In the sort they are ordered
by the further columns and by their place in a stored table, so that they fall into many pieces.
Null texts count as no bytes. An empty table gives an empty result. Column names of the
input are kept; added columns whose names are taken replace the input's.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rillstone.llm.common import fresh_name, read, stored

#: The generator's fixed multiplier, of the published method.
JUMP_FACTOR = np.uint64(2862933555777941757)
#: Rows of one sorted piece.
PIECE_ROWS = 1 << 20


def jump_hash(hashes: np.ndarray, counts: tuple[int, ...]) -> list[np.ndarray]:
    """The shard of every 64-bit hash, for each of several ascending numbers of shards.

    One walk over the jumps serves all of them: it ends at the largest number, and what had been
    reached below a smaller one is the answer for that.
    """
    state = hashes.astype(np.uint64, copy=True)
    at = np.zeros(len(state), np.int64)
    shards = [np.zeros(len(state), np.int32) for _ in counts]
    walking = np.arange(len(state))
    while len(walking):
        for n, shard in zip(counts, shards, strict=True):
            below = at[walking] < n
            shard[walking[below]] = at[walking[below]]
        state[walking] = state[walking] * JUMP_FACTOR + np.uint64(1)
        draw = (state[walking] >> np.uint64(33)).astype(np.float64) + 1
        at[walking] = np.minimum((at[walking] + 1) * (2.0**31 / draw), float(1 << 40)).astype(np.int64)
        walking = walking[at[walking] < counts[-1]]
    return shards


def shard_of(key_hash: Column, *counts: int) -> Column:
    """Struct ``s0, s1, ...``: the shard of a 64-bit key hash for each number of shards."""
    if not counts or min(counts) < 1 or list(counts) != sorted(counts):
        raise ValueError(f"numbers of shards must be positive and ascending, not {counts}")

    @F.pandas_udf(", ".join(f"s{k} int" for k in range(len(counts))))
    def jumps(hashes: pd.Series) -> pd.DataFrame:
        found = jump_hash(hashes.to_numpy(np.int64).view(np.uint64), counts)
        return pd.DataFrame({f"s{k}": shard for k, shard in enumerate(found)})

    return jumps(key_hash)


def assigned(df: DataFrame, key: str, shards: int, grown: int | None = None) -> DataFrame:
    """The rows with ``shard``, and ``grown_shard`` for ``grown`` shards (one more by default)."""
    grown = shards + 1 if grown is None else grown
    named = fresh_name(df, "jumps")
    both = df.withColumn(named, shard_of(F.xxhash64(F.col(key)), shards, grown))
    return both.withColumns({"shard": F.col(f"{named}.s0"), "grown_shard": F.col(f"{named}.s1")}).drop(named)


def moved(df: DataFrame, key: str, shards: int, grown: int) -> DataFrame:
    """Only the rows that change their shard when the shards grow from ``shards`` to ``grown``."""
    return assigned(df, key, shards, grown).where("shard <> grown_shard")


def slotted(sharded: DataFrame, key: str, order: tuple[str, ...] = ()) -> DataFrame:
    """The rows of ``assigned`` with ``slot``: 0, 1, ... within each shard (a column of that name is replaced).

    Rows are ordered by the hash of the key, the key, and the ``order`` columns; rows equal in all of
    these by their place in the stored input.
    """
    held = stored(sharded.drop("slot"), "sharded")
    hashed, tie, place, part, zero = (fresh_name(held, x) for x in ("hash", "tie", "place", "part", "zero"))
    row = held.metadataColumn("_metadata")
    tied = held.select("*", F.xxhash64(F.col(key)).alias(hashed), F.xxhash64(row.file_path, row.row_index).alias(tie))
    pieces = max(int(held.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-held.count() // PIECE_ROWS))
    sorting = ["shard", hashed, key, *order, tie]
    ranged = tied.repartitionByRange(pieces, *sorting).sortWithinPartitions(*sorting)
    # Piece number in the upper bits, row in the piece in the lower 33, fixed by writing them down.
    ranged = stored(ranged.drop(hashed, tie).withColumn(place, F.monotonically_increasing_id()), "slotted")
    numbered = ranged.withColumn(part, F.shiftright(place, 33))
    counts = numbered.groupBy("shard", part).agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("low"))
    before = F.sum("n").over(Window.partitionBy("shard").orderBy(part).rowsBetween(Window.unboundedPreceding, -1))
    firsts = counts.select("shard", part, (F.col("low") - F.coalesce(before, F.lit(0))).alias(zero))
    return numbered.join(firsts, ["shard", part]).withColumn("slot", F.col(place) - F.col(zero)).select(*held.columns, "slot")


def write_shards(docs: DataFrame, key: str, shards: int, path: str, rows_per_file: int = PIECE_ROWS) -> None:
    """Write all columns of ``docs`` as Parquet, a folder ``shard=k`` for each shard.

    Every task writes what it holds into the shards' folders: nothing is shuffled, and a hot key's
    rows are written by the tasks that read them. Files hold ``rows_per_file`` rows at most. The
    folders are given as a whole: an existing path is an error. A shard that has no row has no folder.
    """
    rows = assigned(docs, key, shards).drop("grown_shard")
    rows.write.mode("error").option("maxRecordsPerFile", rows_per_file).partitionBy("shard").parquet(path)


def grow_shards(spark: SparkSession, path: str, key: str, shards: int, grown: int, target: str) -> None:
    """The shards appended to those that ``write_shards`` wrote, into another folder.

    ``target`` gets a folder for each of the new shards, with the rows that move there. The old
    folders stay as they are; their rows whose ``moved`` shard is new are to be left out when they are read.
    """
    there = spark.read.parquet(path).drop("shard")
    rows = moved(there, key, shards, grown).drop("shard").withColumnRenamed("grown_shard", "shard")
    rows.write.mode("error").partitionBy("shard").parquet(target)


def sharded_documents(docs: DataFrame, shards: int = 8) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every document."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + F.lit(1)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).cast("long").alias("text_crc32"),
        F.lit("key").alias("law"),
    )
    found = slotted(assigned(rows, "doc_id", shards), "doc_id", ("text_crc32", "size"))
    return found.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in shards 0 to 7 by the law ``key``."""
    return sharded_documents(read(spark, sf_dir, "documents"))
