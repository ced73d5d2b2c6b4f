"""Hold summaries against the rows they were made from.

A stream counts a row only while its window is open, a backfill only what was there when it ran. Both kinds of
late row are in silver and in no summary. Summaries written with ``audited`` say how many
rows went into each window, so the two can be compared window by window.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _same(keys: list[str], mark: str) -> Column:
    """Equality of the keys with those that carry a mark; a null key equals a null key."""
    return reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"{mark}{k}")) for k in keys])


def window_gaps(silver: DataFrame, summary: DataFrame, size: str, keys: list[str], time: str = "event_time") -> DataFrame:
    """Windows whose summary does not hold exactly the source's rows.

    Columns: ``keys``, window_start, window_end; ``n_rows`` in silver and ``n_summarised``;
    ``n_missed``, the difference (below zero where rows were counted twice); ``n_summaries``, the stored rows of
    the window; ``last_offset`` and ``partition`` of what was summarised, the latter null unless all
    of it came from one topic partition. A window whose summary does not say how many rows it holds is not judged.

    Two aggregates with partial sums before their shuffles, then one join on window and keys: rows of
    windows meet there, not events.
    """
    windowed = silver.groupBy(F.window(time, size).alias("w"), *keys).agg(F.count(F.lit(1)).alias("n_rows"))
    counted = windowed.select(*keys, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "n_rows")
    own = [*keys, "window_start"]
    stored = summary.groupBy(*own).agg(
        F.max("window_end").alias("_end"),
        F.sum("n_rows").alias("n_summarised"),
        (F.count("n_rows") == F.count(F.lit(1))).alias("_known"),
        F.count(F.lit(1)).alias("n_summaries"),
        F.max("last_offset").alias("last_offset"),
        F.min("least_partition").alias("_least"),
        F.max("most_partition").alias("_most"),
    )
    stored = stored.withColumnsRenamed({k: f"_{k}" for k in own})
    both = counted.join(stored, _same(own, "_"), "full_outer")
    missed = F.coalesce("n_rows", F.lit(0)) - F.coalesce("n_summarised", F.lit(0))
    shown = both.select(
        *[F.coalesce(k, f"_{k}").alias(k) for k in own],
        F.coalesce("window_end", "_end").alias("window_end"),
        F.coalesce("n_rows", F.lit(0)).alias("n_rows"),
        F.coalesce("n_summarised", F.lit(0)).alias("n_summarised"),
        missed.alias("n_missed"),
        F.coalesce("n_summaries", F.lit(0)).alias("n_summaries"),
        "last_offset",
        F.when(F.col("_least") == F.col("_most"), F.col("_least")).alias("partition"),
        F.coalesce("_known", F.lit(True)).alias("_known"),
    )
    return shown.where("_known AND (n_missed <> 0 OR n_summaries > 1)").drop("_known")


def missed_rows(silver: DataFrame, gaps: DataFrame, size: str, keys: list[str], time: str = "event_time") -> DataFrame:
    """The rows of ``silver`` that are in no summary, with their window, its ``n_missed``, and ``certain``.

    In a window without any summary these are all its rows. Otherwise they are those behind the last offset that was
    summarised, if the window came from one topic partition (messages keyed by station do) and if these
    are as many as are missing. Where that does not hold, nothing tells the window's rows apart: all of them are
    given, with ``certain`` false.
    """
    own = [*keys, "window_start"]
    marked = gaps.where("n_missed > 0").withColumnsRenamed({c: f"_{c}" for c in gaps.columns})
    windowed = silver.withColumn("_w", F.window(time, size)).withColumns({"window_start": F.col("_w.start"), "window_end": F.col("_w.end")})
    rows = windowed.drop("_w").join(marked, _same(own, "_"))
    behind = (F.col("_n_summarised") == 0) | (
        (F.col("source_partition") == F.col("_partition")) & (F.col("source_offset") > F.col("_last_offset"))
    )
    rows = rows.withColumn("_behind", F.coalesce(behind, F.lit(False)))
    counts = rows.groupBy(*[F.col(k).alias(f"_of_{k}") for k in own]).agg(F.count_if("_behind").alias("_n_behind"))
    told = rows.join(counts, _same(own, "_of_")).withColumn("certain", F.col("_n_behind") == F.col("_n_missed"))
    found = told.where(F.col("_behind") | ~F.col("certain"))
    return found.select(*silver.columns, "window_start", "window_end", F.col("_n_missed").alias("n_missed"), "certain")
