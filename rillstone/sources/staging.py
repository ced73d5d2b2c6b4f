"""Map the generic ``events`` test table onto the two topics.

The broker and real readings are not available where the tests run, so the payloads
are derived, row by row, from columns of ``events``; every event gives one bike and
one weather message. The same arithmetic stands in the SQL the results are checked
against. One station per thirty user ids keeps the station count at thirty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillstone.functions import classify_condition, iso_utc
from rillstone.schemas import BIKE_EVENT, WEATHER_EVENT
from rillstone.sources.envelope import to_envelope

EVENTS = (
    "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, "
    "value DOUBLE, props STRING"
)

# Which raw text replaces the payload in the malformed variant, by event number.
BROKEN_TEXTS = (
    "not json",
    "[1,2]",
    "{}",
    "null",
    "",
    '{"station_id":"S001","docks_total":',
    '{"station_id":"S001","docks_total":"x"}',
)


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")


def stream_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The file source streams folders, so the one file is picked by name."""
    return (
        spark.readStream.schema(EVENTS).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    )


def _message_columns() -> list:
    return [
        F.pmod("user_id", F.lit(30)).alias("m"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    ]


def _station(city: str) -> list:
    number = (F.col("m") + 1).cast("string")
    return [
        F.concat(F.lit("S"), F.lpad(number, 3, "0")).alias("station_id"),
        F.concat(F.lit("City"), number).alias(city),
    ]


def bike_readings(events: DataFrame) -> DataFrame:
    """Payload columns of the bike topic, then the envelope's own columns."""
    base = events.select(
        *_message_columns(), F.from_json("props", "k INT").getField("k").alias("k")
    ).withColumn("docks_total", (12 + F.col("m") % 17).cast("int"))
    stocked = base.withColumn(
        "bikes_available", (F.col("k") % (F.col("docks_total") + 1)).cast("int")
    )
    return stocked.select(
        *_station("bike_city"),
        "docks_total",
        "bikes_available",
        (F.col("docks_total") - F.col("bikes_available")).alias("bikes_occupied"),
        F.col("bikes_available").alias("docks_available"),
        iso_utc("timestamp").alias("event_time"),
        "m",
        "offset",
        "timestamp",
    )


def weather_readings(events: DataFrame) -> DataFrame:
    """Payload columns of the weather topic, then the envelope's own columns."""
    base = events.select(*_message_columns(), F.round(F.col("value") * 100).cast("bigint").alias("c"))
    measured = base.select(
        "*",
        (F.col("c") % 400 / F.lit(10.0)).alias("temp_c"),
        F.when(F.col("c") % 20 < 13, F.lit(0.0))
        .otherwise(F.col("c") % 40 / F.lit(10.0))
        .alias("precip_mm"),
        (25 + F.col("c") % 76).cast("int").alias("humidity"),
        (F.col("c") % 450 / F.lit(10.0)).alias("wind_kph"),
        (1000 + F.col("c") % 30).cast("int").alias("pressure_mb"),
    )
    return measured.select(
        *_station("weather_city"),
        "temp_c",
        "precip_mm",
        "humidity",
        "wind_kph",
        "pressure_mb",
        classify_condition().alias("condition"),
        iso_utc("timestamp").alias("event_time"),
        "m",
        "offset",
        "timestamp",
    )


def bike_envelope(events: DataFrame) -> DataFrame:
    return enveloped(bike_readings(events), "bike", BIKE_EVENT.names)


def weather_envelope(events: DataFrame) -> DataFrame:
    return enveloped(weather_readings(events), "weather", WEATHER_EVENT.names)


def enveloped(readings: DataFrame, topic: str, payload: list[str]) -> DataFrame:
    return to_envelope(
        readings.select(
            *payload,
            (F.col("m") % 3).cast("int").alias("partition"),
            "offset",
            "timestamp",
            F.lit(0).alias("timestampType"),
        ),
        topic,
        payload=payload,
        carry=["partition", "offset", "timestamp", "timestampType"],
    )


def with_broken_texts(envelope: DataFrame) -> DataFrame:
    """Every seventh message loses its payload to one of ``BROKEN_TEXTS`` in turn."""
    turn = F.floor(F.col("offset") / 7) % len(BROKEN_TEXTS) + 1
    broken = F.element_at(F.array(*[F.lit(t) for t in BROKEN_TEXTS]), turn.cast("int"))
    return envelope.withColumn(
        "value",
        F.when(F.col("offset") % 7 == 0, broken.cast("binary")).otherwise(F.col("value")),
    )


def with_bike_faults(readings: DataFrame) -> DataFrame:
    """Some readings break a bike promise: too many bikes, or a wrong remainder."""
    n = F.col("offset")
    return readings.withColumns(
        {
            "bikes_available": F.when(
                n % 11 == 3, F.col("docks_total") + F.col("bikes_available") + 1
            ).otherwise(F.col("bikes_available")),
            "bikes_occupied": F.when(n % 13 == 5, F.col("bikes_occupied") - 1).otherwise(
                F.col("bikes_occupied")
            ),
        }
    )


def with_weather_faults(readings: DataFrame) -> DataFrame:
    """Some readings break a weather promise: range, sign, digits or label."""
    n = F.col("offset")
    return readings.withColumns(
        {
            "humidity": F.when(n % 11 == 3, F.col("humidity") + 80).otherwise(F.col("humidity")),
            "wind_kph": F.when(n % 13 == 5, F.lit(-1.5)).otherwise(F.col("wind_kph")),
            "precip_mm": F.when(n % 29 == 7, F.lit(-0.5)).otherwise(F.col("precip_mm")),
            "temp_c": F.when(n % 17 == 2, F.lit(20.25)).otherwise(F.col("temp_c")),
            "condition": F.when(n % 19 == 4, F.lit("Fog")).otherwise(F.col("condition")),
        }
    )
