"""Bounded reads for clients: filter, order, project, take the first n."""

from __future__ import annotations

import re
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillstone.functions import row_text

#: The partition of rows without a value.
_NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def read_view(
    df: DataFrame,
    columns: list[str] | None = None,
    filters: dict[str, Any] | None = None,
    order_by: str | None = None,
    descending: bool = True,
    limit: int | None = None,
    lenient: bool = False,
    newest_partitions: str | None = None,
) -> DataFrame:
    """Filter, order and cut a table, as a lazy frame.

    * ``filters`` are equalities; a ``None`` value filters nothing.
    * Unknown names are an error, or are ignored when ``lenient``. If ``lenient`` leaves
      no column, all are kept.
    * Nulls come last in both directions. Ties are settled by the other columns of the
      result, so a limited read is repeatable.
    * ``limit`` of ``None`` or below one takes everything; otherwise Spark keeps the
      first n of each task and merges those, it does not sort the table.
    * ``newest_partitions`` names a partition column that never falls as ``order_by``
      rises. A descending, limited read then opens only the newest partitions that
      together hold n rows (see ``_newest``); the result is the same. Small counts run when
      the view is made. The ``recent_*`` views do so by ``dt`` unless told otherwise.
    """
    known = set(df.columns)
    asked = [*(columns or []), *(filters or {}), *([order_by] if order_by else [])]
    unknown = [c for c in asked if c not in known]
    if unknown and not lenient:
        raise ValueError(f"no such columns: {unknown}")

    for name, value in (filters or {}).items():
        if value is not None and name in known:
            df = df.where(F.col(name) == F.lit(value))
    shown = [c for c in (columns or []) if c in known] or df.columns

    bounded = limit is not None and limit > 0
    if order_by in known:
        if newest_partitions and bounded and descending:
            df = _newest(df, newest_partitions, limit)
        first = F.col(order_by)
        lead = first.desc_nulls_last() if descending else first.asc_nulls_last()
        df = df.orderBy(lead, *[F.col(c).asc_nulls_last() for c in shown if c != order_by])
    if bounded:
        df = df.limit(limit)
    return df.select(*shown)


def _newest(df: DataFrame, partition: str, limit: int) -> DataFrame:
    """Only the newest partitions that together hold ``limit`` rows.

    The partition values are read from the file names that planning lists anyway. Rows of
    the newest date are counted, then of the newest two, four and so on, until there are
    enough: only the files of those dates are opened. The oldest value needed becomes a
    literal in the scan's partition filter. A frame whose files lie in no such partitions,
    or that holds fewer rows, is not cut.
    """
    mark = re.compile(rf"/{re.escape(partition)}=([^/]+)/")
    values = sorted({m[1] for m in map(mark.search, df.inputFiles()) if m and m[1] != _NO_VALUE}, reverse=True)
    look_back = 1
    while values:
        cutoff = values[min(look_back, len(values)) - 1]
        newest = df.where(F.col(partition) >= F.lit(cutoff).cast(df.schema[partition].dataType))
        if newest.limit(limit).count() >= limit:
            return newest
        if look_back >= len(values):
            break
        look_back *= 2
    return df


def _recent(
    df: DataFrame,
    columns: list[str],
    time: str,
    most: int,
    station_id: str | None,
    limit: int,
    newest_partitions: str | None,
) -> DataFrame:
    if not 1 <= limit <= most:
        raise ValueError(f"limit must lie in 1..{most}, not {limit}")
    return read_view(
        df,
        columns,
        {"station_id": station_id},
        time,
        limit=limit,
        newest_partitions=newest_partitions,
    )


# Fixed: columns and order of the five read views.
_BIKE = [
    "event_time", "dt", "station_id", "bike_city", "docks_total", "docks_available",
    "bikes_available", "bikes_occupied",
]
_WEATHER = [
    "event_time", "dt", "station_id", "weather_city", "temp_c", "precip_mm", "humidity",
    "wind_kph", "pressure_mb", "condition",
]
_BIKE_MINUTE = [
    "minute", "station_id", "bike_city", "bikes_available", "bikes_occupied", "docks_total", "dt",
]
_BIKE_HOURLY = [
    "window_start", "window_end", "dt", "station_id", "bike_city", "bikes_occupied_hour",
    "bikes_available_avg_hour", "availability_rate_avg_hour", "utilization_rate_avg_hour",
    "docks_total",
]
_WEATHER_HOURLY = [
    "window_start", "window_end", "dt", "station_id", "weather_city", "avg_temp_c_hour",
    "sum_precip_mm_hour", "avg_humidity_hour", "avg_wind_kph_hour", "avg_pressure_mb_hour",
]


def recent_bike(
    silver: DataFrame,
    station_id: str | None = None,
    limit: int = 100,
    newest_partitions: str | None = "dt",
) -> DataFrame:
    """Newest bike events, at most 5000."""
    return _recent(silver, _BIKE, "event_time", 5000, station_id, limit, newest_partitions)


def recent_weather(
    silver: DataFrame,
    station_id: str | None = None,
    limit: int = 100,
    newest_partitions: str | None = "dt",
) -> DataFrame:
    """Newest weather events, at most 5000."""
    return _recent(silver, _WEATHER, "event_time", 5000, station_id, limit, newest_partitions)


def recent_bike_minute(
    gold: DataFrame,
    station_id: str | None = None,
    limit: int = 200,
    newest_partitions: str | None = "dt",
) -> DataFrame:
    """Newest minutes of bike counts, at most 10000; the window start is ``minute``."""
    named = gold.withColumnRenamed("window_start", "minute")
    return _recent(named, _BIKE_MINUTE, "minute", 10000, station_id, limit, newest_partitions)


def recent_bike_hourly(
    gold: DataFrame,
    station_id: str | None = None,
    limit: int = 200,
    newest_partitions: str | None = "dt",
) -> DataFrame:
    """Newest hours of bike usage, at most 10000."""
    return _recent(gold, _BIKE_HOURLY, "window_start", 10000, station_id, limit, newest_partitions)


def recent_weather_hourly(
    gold: DataFrame,
    station_id: str | None = None,
    limit: int = 200,
    newest_partitions: str | None = "dt",
) -> DataFrame:
    """Newest hours of weather, at most 10000."""
    return _recent(
        gold, _WEATHER_HOURLY, "window_start", 10000, station_id, limit, newest_partitions
    )


def as_json_rows(df: DataFrame) -> DataFrame:
    """One JSON object per row in column ``json``: times as text, nulls as ``null``."""
    shown = df.select(*[row_text(f.name, f.dataType) for f in df.schema.fields])
    return shown.select(
        F.to_json(F.struct(*shown.columns), {"ignoreNullFields": "false"}).alias("json")
    )
