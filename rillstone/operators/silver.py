"""Parsing: text to typed events, and what to do with text that will not parse."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from rillstone.functions import safe_ratio
from rillstone.schemas import BIKE_EVENT, WEATHER_EVENT

# Holds the raw text of a record the reader could not fit to the schema.
_REFUSED = "_refused_text"


def _strict(schema: StructType) -> StructType:
    return StructType([*schema.fields]).add(_REFUSED, StringType())


def _parsed(schema: StructType) -> Column:
    """The payload as one struct column ``_event``, from one parse of the text.

    A filter on a plain ``from_json`` column is pushed below the projection that makes it,
    and parses every text a second time there. Filters on generated columns stay above
    the generator, so the struct passes through a one-element ``explode``.
    """
    options = {}
    if _REFUSED in schema.names:
        options = {"columnNameOfCorruptRecord": _REFUSED, "allowNonNumericNumbers": "false"}
    return F.explode(F.array(F.from_json("value", schema, options))).alias("_event")


def _well_formed(required: tuple[str, ...]) -> Column:
    """A JSON object at the start of the text fitted the schema and names its station.

    ``{}`` fits, but names none; a blank name is none.

    Never null, so its negation is the exact complement; false where there was no text.
    """
    fits = F.col(f"_event.{_REFUSED}").isNull()
    for name in required:
        fits = fits & (F.trim(F.coalesce(F.col(f"_event.{name}"), F.lit(""))) != "")
    return fits


def parse_events(
    bronze: DataFrame,
    schema: StructType,
    on_malformed: str = "drop",
    required: tuple[str, ...] = ("station_id",),
    placed: bool = False,
) -> DataFrame:
    """Payload columns of every message, ``event_time`` as timestamp, and its date.

    ``on_malformed``:

    * ``"drop"``: only messages that begin with a JSON object that fits the schema (NaN and
      Infinity are no numbers) and carries the ``required`` text fields, not blank. What follows
      a complete object in the same text is ignored, and an object in place of a text field is
      taken as its text, both as Spark's reader does.
    * ``"keep"``: every message that has any text; what does not fit becomes null.

    ``placed`` adds each message's topic partition and offset, for audits of later layers.

    ``quarantined`` gives the rest of ``"drop"``. Unreadable times become null, they do
    not fail the query.
    """
    place = [F.col("partition").alias("source_partition"), F.col("offset").alias("source_offset")] if placed else []
    if on_malformed == "keep":
        parsed = bronze.select(_parsed(schema), *place).where(F.col("_event").isNotNull())
    elif on_malformed == "drop":
        parsed = bronze.select(_parsed(_strict(schema)), *place).where(_well_formed(required))
    else:
        raise ValueError(f"on_malformed must be 'drop' or 'keep', not {on_malformed!r}")
    return _events(parsed, schema, ["source_partition", "source_offset"] if placed else [])


def _events(parsed: DataFrame, schema: StructType, more: list[str]) -> DataFrame:
    events = parsed.select(*[F.col(f"_event.{name}") for name in schema.names], *more)
    return events.withColumn("event_time", F.try_to_timestamp("event_time")).withColumn(
        "dt", F.to_date("event_time")
    )


def quarantined(
    bronze: DataFrame, schema: StructType, required: tuple[str, ...] = ("station_id",)
) -> DataFrame:
    """The bronze rows that ``parse_events(..., "drop")`` leaves out, unchanged.

    Includes messages without any text, so silver and quarantine together are bronze.
    """
    return (
        bronze.select("*", _parsed(_strict(schema)))
        .where(~_well_formed(required))
        .select(*bronze.columns)
    )


def parsed_messages(
    bronze: DataFrame, schema: StructType, required: tuple[str, ...] = ("station_id",)
) -> DataFrame:
    """Every message with its parsed struct ``_event`` and whether it ``_fits``: one parse, from which
    ``accepted`` and ``refused`` take their rows."""
    return bronze.select("*", _parsed(_strict(schema))).withColumn("_fits", _well_formed(required))


def accepted(parsed: DataFrame, schema: StructType, placed: bool = False) -> DataFrame:
    """What ``parse_events(..., "drop")`` gives, from ``parsed_messages``."""
    place = {"source_partition": F.col("partition"), "source_offset": F.col("offset")} if placed else {}
    return _events(parsed.where("_fits").withColumns(place), schema, list(place))


def refused(parsed: DataFrame) -> DataFrame:
    """What ``quarantined`` gives, from ``parsed_messages``."""
    return parsed.where("NOT _fits").drop("_event", "_fits")


def with_rates(df: DataFrame) -> DataFrame:
    """Share of docks with a bike ready, and share of docks whose bike is out."""
    return df.withColumns(
        {
            "availability_rate": safe_ratio("bikes_available", "docks_total"),
            "utilization_rate": safe_ratio("bikes_occupied", "docks_total"),
        }
    )


def bike_silver(bronze: DataFrame, on_malformed: str = "drop", placed: bool = False) -> DataFrame:
    return with_rates(parse_events(bronze, BIKE_EVENT, on_malformed, placed=placed))


def weather_silver(bronze: DataFrame, on_malformed: str = "drop", placed: bool = False) -> DataFrame:
    return parse_events(bronze, WEATHER_EVENT, on_malformed, placed=placed)
