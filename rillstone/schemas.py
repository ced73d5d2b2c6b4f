"""Declared schemas: the message envelope, the two payloads, and every table.

Nothing is inferred at run time. A table is always read with its declared
schema, so a partition value such as ``007`` stays text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import (
    BinaryType,
    DataType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

TEXT, BYTES, INT, LONG = StringType(), BinaryType(), IntegerType(), LongType()
REAL, TIME, DATE = DoubleType(), TimestampType(), DateType()


def _columns(**types: DataType) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in types.items()])


ENVELOPE = _columns(
    key=BYTES,
    value=BYTES,
    topic=TEXT,
    partition=INT,
    offset=LONG,
    timestamp=TIME,
    timestampType=INT,
)

# Payload field names and types are fixed by the producers of the two topics.
BIKE_EVENT = _columns(
    station_id=TEXT,
    bike_city=TEXT,
    docks_total=INT,
    bikes_available=INT,
    bikes_occupied=INT,
    docks_available=INT,
    event_time=TEXT,
)

WEATHER_EVENT = _columns(
    station_id=TEXT,
    weather_city=TEXT,
    temp_c=REAL,
    precip_mm=REAL,
    humidity=INT,
    wind_kph=REAL,
    pressure_mb=INT,
    condition=TEXT,
    event_time=TEXT,
)

_BRONZE = _columns(
    key=TEXT,
    value=TEXT,
    topic=TEXT,
    partition=INT,
    offset=LONG,
    kafka_timestamp=TIME,
    kafka_timestamp_type=INT,
    ingest_time=TIME,
    dt=DATE,
)

_SILVER_BIKE = _columns(
    station_id=TEXT,
    bike_city=TEXT,
    docks_total=INT,
    bikes_available=INT,
    bikes_occupied=INT,
    docks_available=INT,
    event_time=TIME,
    dt=DATE,
    availability_rate=REAL,
    utilization_rate=REAL,
)

_SILVER_WEATHER = _columns(
    station_id=TEXT,
    weather_city=TEXT,
    temp_c=REAL,
    precip_mm=REAL,
    humidity=INT,
    wind_kph=REAL,
    pressure_mb=INT,
    condition=TEXT,
    event_time=TIME,
    dt=DATE,
)


def _bike_usage(suffix: str) -> StructType:
    return _columns(
        **{
            "station_id": TEXT,
            "bike_city": TEXT,
            "window_start": TIME,
            "window_end": TIME,
            f"bikes_occupied_{suffix}": LONG,
            f"bikes_available_avg_{suffix}": REAL,
            f"availability_rate_avg_{suffix}": REAL,
            f"utilization_rate_avg_{suffix}": REAL,
            "docks_total": INT,
            "dt": DATE,
        }
    )


def _weather_summary(suffix: str) -> StructType:
    return _columns(
        **{
            "station_id": TEXT,
            "weather_city": TEXT,
            "window_start": TIME,
            "window_end": TIME,
            f"avg_temp_c_{suffix}": REAL,
            f"sum_precip_mm_{suffix}": REAL,
            f"avg_humidity_{suffix}": REAL,
            f"avg_wind_kph_{suffix}": REAL,
            f"avg_pressure_mb_{suffix}": REAL,
            "dt": DATE,
        }
    )


_BIKE_MINUTE = _columns(
    station_id=TEXT,
    bike_city=TEXT,
    window_start=TIME,
    window_end=TIME,
    bikes_available=INT,
    bikes_occupied=INT,
    docks_total=INT,
    dt=DATE,
)


@dataclass(frozen=True)
class TableSpec:
    """One stored table.

    ``clustering`` says how rows are brought together before a write:

    * ``"none"``: each task writes what it holds. Right when a task's rows fall
      into few partitions anyway.
    * ``"rebalance"``: shuffle by the partition columns and let adaptive execution
      cut oversized shuffle partitions, so a station that owns a third of all rows
      is written by many tasks.
    * ``"hash"``: shuffle by the partition columns. Only for aggregate output, whose
      rows per partition are bounded by windows per day, not by events.

    ``audit`` are columns that are stored beside the declared ones and read only on request: where a
    silver row lay in its topic, and what went into a summary row. ``keys`` name a summary's row
    within its window.

    ``spread_by`` divides one partition among several writers by a hash of the named
    columns, for ``"hash"`` tables whose partitions hold every station. The writers are a
    quarter of the session's shuffle partitions.
    """

    layer: str
    name: str
    schema: StructType
    partitions: tuple[str, ...]
    clustering: str = "none"
    spread_by: tuple[str, ...] = ()
    audit: StructType = StructType([])
    keys: tuple[str, ...] = ()

    @property
    def stored_schema(self) -> StructType:
        return StructType([*self.schema.fields, *self.audit.fields])

    @property
    def path(self) -> str:
        return f"{self.layer}/{self.name}"

    @property
    def view_name(self) -> str:
        return f"{self.layer}_{self.name}"


_DAY_STATION = ("dt", "station_id")
_PLACE = _columns(source_partition=INT, source_offset=LONG)
_SUMMARISED = _columns(n_rows=LONG, last_offset=LONG, least_partition=INT, most_partition=INT)
_BIKE_KEYS, _WEATHER_KEYS = ("station_id", "bike_city"), ("station_id", "weather_city")


def _silver(name: str, schema: StructType) -> TableSpec:
    return TableSpec("silver", name, schema, _DAY_STATION, "rebalance", audit=_PLACE)


# Weather and usage of one station and hour, side by side; filled on request only.
_WEATHER_BIKE = _columns(
    station_id=TEXT,
    window_start=TIME,
    dt=DATE,
    weather_city=TEXT,
    avg_temp_c_hour=REAL,
    sum_precip_mm_hour=REAL,
    bike_city=TEXT,
    bikes_occupied_hour=LONG,
    utilization_rate_avg_hour=REAL,
)


def _gold(name: str, schema: StructType, keys: tuple[str, ...], partitions=_DAY_STATION, spread_by=()) -> TableSpec:
    return TableSpec("gold", name, schema, partitions, "hash", spread_by, _SUMMARISED, keys)


BRONZE_BIKE = TableSpec("bronze", "bike", _BRONZE, ("dt",))
BRONZE_WEATHER = TableSpec("bronze", "weather", _BRONZE, ("dt",))
SILVER_BIKE = _silver("bike_events", _SILVER_BIKE)
SILVER_WEATHER = _silver("weather_events", _SILVER_WEATHER)
GOLD_BIKE_HOURLY = _gold("bike_usage_hourly", _bike_usage("hour"), _BIKE_KEYS)
GOLD_BIKE_DAILY = _gold("bike_usage_daily", _bike_usage("day"), _BIKE_KEYS)
GOLD_WEATHER_HOURLY = _gold("weather_hourly", _weather_summary("hour"), _WEATHER_KEYS)
GOLD_WEATHER_DAILY = _gold("weather_daily", _weather_summary("day"), _WEATHER_KEYS)
GOLD_BIKE_MINUTE = _gold("bike_minute", _BIKE_MINUTE, _BIKE_KEYS, ("dt",), ("station_id",))

GOLD_WEATHER_BIKE = TableSpec("gold", "weather_bike_hourly", _WEATHER_BIKE, _DAY_STATION, "hash")

# Optional side tables: what strict parsing refused, with its raw text.
QUARANTINE_BIKE = TableSpec("quarantine", "bike", _BRONZE, ("dt",))
QUARANTINE_WEATHER = TableSpec("quarantine", "weather", _BRONZE, ("dt",))

TABLES: tuple[TableSpec, ...] = (
    BRONZE_BIKE,
    BRONZE_WEATHER,
    SILVER_BIKE,
    SILVER_WEATHER,
    GOLD_BIKE_HOURLY,
    GOLD_BIKE_DAILY,
    GOLD_WEATHER_HOURLY,
    GOLD_WEATHER_DAILY,
    GOLD_BIKE_MINUTE,
    QUARANTINE_BIKE,
    QUARANTINE_WEATHER,
)
