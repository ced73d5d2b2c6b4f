"""Small inputs for the unit tests."""

from __future__ import annotations

import json
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillstone.schemas import ENVELOPE
from rillstone.sources import EnvelopeFolder, publish


def utc(text: str) -> datetime:
    return datetime.fromisoformat(text).replace(tzinfo=timezone.utc)


def bike(station="S001", at="2024-01-01T10:00:00Z", available=4, docks=10, city="Boston", **more):
    occupied = None if docks is None or available is None else docks - available
    return {
        "station_id": station, "bike_city": city, "docks_total": docks,
        "bikes_available": available, "bikes_occupied": occupied,
        "docks_available": available, "event_time": at, **more,
    }


def weather(station="S001", at="2024-01-01T10:00:00Z", temp=15.0, precip=0.0, humidity=60,
            wind=10.0, pressure=1015, condition="Clear", city="Boston"):
    return {
        "station_id": station, "weather_city": city, "temp_c": temp, "precip_mm": precip,
        "humidity": humidity, "wind_kph": wind, "pressure_mb": pressure,
        "condition": condition, "event_time": at,
    }


def envelope(spark: SparkSession, values: list, topic: str = "bike") -> DataFrame:
    """Messages from payload dicts, or from raw texts and nulls as they are."""
    rows = []
    for n, value in enumerate(values):
        text = json.dumps(value) if isinstance(value, dict) else value
        key = value.get("station_id") if isinstance(value, dict) else None
        rows.append((
            key.encode() if key else None, text.encode() if text is not None else None,
            topic, 0, n, utc("2024-01-01 12:00:00"), 0,
        ))
    return spark.createDataFrame(rows, ENVELOPE)


def bronze(spark: SparkSession, values: list, topic: str = "bike") -> DataFrame:
    from rillstone.operators import to_bronze

    taken_in = F.lit("2024-02-01 00:00:00").cast("timestamp")
    return to_bronze(envelope(spark, values, topic), taken_in)


def drop_into(spark: SparkSession, folder: str, values: list, topic: str = "bike") -> None:
    """One more file in an envelope folder."""
    publish(envelope(spark, values, topic).coalesce(1), EnvelopeFolder(folder))


def plan_of(df: DataFrame) -> str:
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")


def rows_of(df: DataFrame) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)
