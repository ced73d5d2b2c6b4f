"""The one windowed aggregate every summary table is made of."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def window_agg(
    df: DataFrame,
    size: str,
    keys: list[str],
    measures: dict[str, Column],
    dt_from: str = "end",
    watermark: str | None = None,
    time: str = "event_time",
    audited: bool = False,
) -> DataFrame:
    """Tumbling-window aggregate: keys, window bounds, measures, partition date.

    Rows without a time belong to no window and are left out. ``dt_from`` picks the
    window bound whose date becomes ``dt``. ``watermark`` (streams only) says how long
    after the newest event a window stays open; on a batch frame it has no effect.

    ``audited`` adds what went into each row: how many rows, and, where the frame has them, the last offset and
    the range of topic partitions. ``window_gaps`` holds these against the source.

    One shuffle, on (window, keys), after a partial aggregate in every input task: a key
    that holds a third of the rows sends a few partial rows per task, not its events.
    """
    if dt_from not in ("start", "end"):
        raise ValueError(f"dt_from must be 'start' or 'end', not {dt_from!r}")
    if audited:
        measures = {**measures, **_what_went_in(df)}
    if watermark:
        df = df.withWatermark(time, watermark)
    grouped = df.groupBy(F.window(time, size).alias("w"), *keys).agg(
        *[measure.alias(name) for name, measure in measures.items()]
    )
    return grouped.select(
        *keys,
        F.col("w.start").alias("window_start"),
        F.col("w.end").alias("window_end"),
        *measures,
        F.to_date(f"w.{dt_from}").alias("dt"),
    )


def _what_went_in(df: DataFrame) -> dict[str, Column]:
    counted = {"n_rows": F.count(F.lit(1))}
    if "source_offset" in df.columns:
        counted |= {
            "last_offset": F.max("source_offset"),
            "least_partition": F.min("source_partition"),
            "most_partition": F.max("source_partition"),
        }
    return counted
