"""Landing: the message as it came, readable, with the time it was taken in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def to_bronze(envelope: DataFrame, ingest_time: Column | None = None) -> DataFrame:
    """Key and value as text, the broker's metadata, ingest time and its date.

    ``ingest_time`` replaces the clock where a repeatable result is wanted.
    """
    taken_in = F.current_timestamp() if ingest_time is None else ingest_time
    return envelope.select(
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        "topic",
        "partition",
        "offset",
        F.col("timestamp").alias("kafka_timestamp"),
        F.col("timestampType").alias("kafka_timestamp_type"),
        taken_in.alias("ingest_time"),
        F.to_date(taken_in).alias("dt"),
    )
