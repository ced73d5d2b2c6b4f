"""Which offsets of a topic never arrived in bronze, and which arrived twice.

With ``failOnDataLoss=false`` a stream goes on when the broker has dropped messages, and a source without
exactly-once delivery repeats some. Both show in the offsets, which a broker counts up by one in each
partition (control records of transactions and compaction take offsets too; there a gap is no loss).
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Offsets looked at side by side in one task.
BLOCK = 1 << 20

_OF = ["topic", "partition"]


def _dates(bronze: DataFrame, since: date | None, until: date | None) -> DataFrame:
    """Bronze dates ``since`` <= dt < ``until``, pruned by partition."""
    if since is not None:
        bronze = bronze.where(F.col("dt") >= F.lit(since))
    if until is not None:
        bronze = bronze.where(F.col("dt") < F.lit(until))
    return bronze.where("offset IS NOT NULL")


def offset_gaps(bronze: DataFrame, since: date | None = None, until: date | None = None, block: int = BLOCK) -> DataFrame:
    """topic, partition, first_missing, last_missing, n_missing: each run of offsets that is not there,
    between the least and the greatest offset of its partition.

    A partition may hold a third of all messages, so no window runs over a whole one. Offsets are first
    reduced to one row each, then compared with their predecessor within blocks of ``block`` offsets, a bounded
    number of rows whatever arrived; then the blocks' ends are compared with each other, one row a block.
    Messages of later dates may fill a gap at the end of a range of dates.
    """
    of_block = [*_OF, "block"]
    blocked = _dates(bronze, since, until).select(*_OF, "offset", F.floor(F.col("offset") / block).alias("block"))
    once = blocked.groupBy(*of_block, "offset").agg(F.count(F.lit(1)).alias("n"))
    before = F.lag("offset").over(Window.partitionBy(*of_block).orderBy("offset"))
    inside = once.withColumn("last", before).where("offset > last + 1").select(*_OF, "last", "offset")
    ends = blocked.groupBy(*of_block).agg(F.min("offset").alias("offset"), F.max("offset").alias("high"))
    ahead = F.lag("high").over(Window.partitionBy(*_OF).orderBy("block"))
    between = ends.withColumn("last", ahead).where("offset > last + 1").select(*_OF, "last", "offset")
    return inside.unionAll(between).select(
        *_OF,
        (F.col("last") + 1).alias("first_missing"),
        (F.col("offset") - 1).alias("last_missing"),
        (F.col("offset") - F.col("last") - 1).alias("n_missing"),
    )


def offset_repeats(bronze: DataFrame, since: date | None = None, until: date | None = None) -> DataFrame:
    """topic, partition, offset, n_copies, same_message of offsets that are there more than once.

    Without ``same_message`` an offset was given to different messages, as after a topic was made anew.
    Copies are counted in each task before the shuffle.
    """
    named = _dates(bronze, since, until).select(*_OF, "offset", F.xxhash64("key", "value").alias("h"))
    counts = named.groupBy(*_OF, "offset").agg(F.count(F.lit(1)).alias("n_copies"), F.min("h").alias("low"), F.max("h").alias("high"))
    return counts.where("n_copies > 1").select(*_OF, "offset", "n_copies", (F.col("low") == F.col("high")).alias("same_message"))


def without_repeats(bronze: DataFrame) -> DataFrame:
    """Bronze with one row for each offset of a partition: the first taken in (then the least text).

    Rows without an offset all stay. A hot partition is no hot key: rows are dealt by offset too. Like every batch
    function here it may run on a stored table before a layer is rebuilt from it.
    """
    order = ["ingest_time", "key", "value"]
    rest = [c for c in bronze.columns if c not in (*_OF, "offset", *order)]
    kept = F.min(F.struct(*order, *rest)).alias("kept")
    found = bronze.where("offset IS NOT NULL").groupBy(*_OF, "offset").agg(kept)
    unpacked = found.select(*[F.col(c) if c in (*_OF, "offset") else F.col(f"kept.{c}").alias(c) for c in bronze.columns])
    return unpacked.unionAll(bronze.where("offset IS NULL"))
