"""Every operator as a named query over the ``events`` test table.

Batch queries are one lazy plan from the event rows through message text to the result.
Streaming and table queries write under ``scratch_dir`` and return the stored table.
Doubles are rounded to nine places, since the order of addition is not fixed.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from rillstone import operators as op
from rillstone import schemas as S
from rillstone.functions import classify_condition
from rillstone.layout import LakeLayout, query_lake, register_views
from rillstone.operators.quality import bike_rules, weather_rules
from rillstone.session import scratch_dir
from rillstone.sources import (
    EnvelopeFolder,
    compact,
    expire,
    newest,
    publish,
    read_table,
    rewrite_compact,
    staging,
    write_table,
)
from rillstone.streaming import LakeJob, backfill_summaries, lake_flows, late_rows, open_windows, restate, summary_gaps

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

INGEST_TIME = "2024-02-01 00:00:00"
RETENTION_AS_OF = date(2024, 2, 5)
BACKFILL_UNTIL = date(2024, 1, 20)
LATE_FROM = date(2024, 1, 21)
CLOSED_BEFORE = date(2024, 1, 19)
FORGOTTEN_BEFORE = date(2024, 1, 15)


def query(build: Query) -> Query:
    """Register a builder under its own name, with the session zone pinned to UTC."""

    def pinned(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return build(spark, sf_dir)

    QUERIES[build.__name__] = pinned
    return pinned


def _ingest_time():
    return F.lit(INGEST_TIME).cast("timestamp")


def _bronze(envelope: DataFrame) -> DataFrame:
    return op.to_bronze(envelope, _ingest_time())


def _bike_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bronze(staging.bike_envelope(staging.read_events(spark, sf_dir)))


def _weather_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bronze(staging.weather_envelope(staging.read_events(spark, sf_dir)))


def _bike(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.bike_silver(_bike_bronze(spark, sf_dir))


def _weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.weather_silver(_weather_bronze(spark, sf_dir))


def _rounded(df: DataFrame, places: int = 9) -> DataFrame:
    return df.select(
        *[
            F.round(f.name, places).alias(f.name) if isinstance(f.dataType, DoubleType) else f.name
            for f in df.schema.fields
        ]
    )


# ---- landing and parsing ---------------------------------------------------------


@query
def bronze_bike(spark, sf_dir):
    return _bike_bronze(spark, sf_dir)


@query
def bronze_weather(spark, sf_dir):
    return _weather_bronze(spark, sf_dir)


@query
def silver_bike(spark, sf_dir):
    return _bike(spark, sf_dir)


@query
def silver_weather(spark, sf_dir):
    return _weather(spark, sf_dir)


def _broken_bike_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    envelope = staging.bike_envelope(staging.read_events(spark, sf_dir))
    return _bronze(staging.with_broken_texts(envelope))


@query
def malformed_keep(spark, sf_dir):
    return op.bike_silver(_broken_bike_bronze(spark, sf_dir), "keep")


@query
def malformed_drop(spark, sf_dir):
    return op.bike_silver(_broken_bike_bronze(spark, sf_dir), "drop")


@query
def malformed_quarantine(spark, sf_dir):
    return op.quarantined(_broken_bike_bronze(spark, sf_dir), S.BIKE_EVENT)


def _broken_weather_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    envelope = staging.weather_envelope(staging.read_events(spark, sf_dir))
    return _bronze(staging.with_broken_texts(envelope))


@query
def malformed_weather_drop(spark, sf_dir):
    return op.weather_silver(_broken_weather_bronze(spark, sf_dir), "drop")


@query
def malformed_weather_quarantine(spark, sf_dir):
    return op.quarantined(_broken_weather_bronze(spark, sf_dir), S.WEATHER_EVENT)


# ---- window summaries ------------------------------------------------------------


@query
def bike_hourly(spark, sf_dir):
    return _rounded(op.bike_usage(_bike(spark, sf_dir), "hour"))


@query
def bike_daily(spark, sf_dir):
    return _rounded(op.bike_usage(_bike(spark, sf_dir), "day"))


@query
def bike_minute(spark, sf_dir):
    return op.bike_minute(_bike(spark, sf_dir))


@query
def weather_hourly(spark, sf_dir):
    return _rounded(op.weather_summary(_weather(spark, sf_dir), "hour"))


@query
def weather_daily(spark, sf_dir):
    return _rounded(op.weather_summary(_weather(spark, sf_dir), "day"))


# ---- across tables ---------------------------------------------------------------


@query
def utilization_by_hour_of_day(spark, sf_dir):
    return _rounded(op.utilization_by_hour_of_day(_bike(spark, sf_dir)))


def _weather_bike(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.weather_bike_hourly(
        op.weather_summary(_weather(spark, sf_dir), "hour"),
        op.bike_usage(_bike(spark, sf_dir), "hour"),
    )


@query
def weather_bike_hourly(spark, sf_dir):
    return _rounded(_weather_bike(spark, sf_dir))


@query
def rain_usage_correlation(spark, sf_dir):
    return _rounded(op.rain_usage_correlation(_weather_bike(spark, sf_dir)))


@query
def rain_usage_correlation_by_station(spark, sf_dir):
    return _rounded(op.rain_usage_correlation(_weather_bike(spark, sf_dir), ["station_id"]))


@query
def station_enriched(spark, sf_dir):
    return _rounded(op.with_station(_weather(spark, sf_dir)))


@query
def retained(spark, sf_dir):
    return op.retained(_bike(spark, sf_dir), RETENTION_AS_OF, 20)


# ---- labels and checks -----------------------------------------------------------


@query
def condition_labels(spark, sf_dir):
    readings = staging.weather_readings(staging.read_events(spark, sf_dir))
    gappy = readings.withColumn("temp_c", F.when(F.col("offset") % 23 != 0, F.col("temp_c")))
    return gappy.select(
        "offset", "temp_c", "precip_mm", "wind_kph", "humidity",
        classify_condition().alias("label"),
    )


def _faulty_bike(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings = staging.with_bike_faults(staging.bike_readings(staging.read_events(spark, sf_dir)))
    return op.bike_silver(_bronze(staging.enveloped(readings, "bike", S.BIKE_EVENT.names)))


def _faulty_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings = staging.with_weather_faults(
        staging.weather_readings(staging.read_events(spark, sf_dir))
    )
    return op.weather_silver(
        _bronze(staging.enveloped(readings, "weather", S.WEATHER_EVENT.names))
    )


@query
def bike_violations(spark, sf_dir):
    return op.bike_violations(_faulty_bike(spark, sf_dir))


@query
def weather_violations(spark, sf_dir):
    return op.weather_violations(_faulty_weather(spark, sf_dir))


@query
def bike_violation_counts(spark, sf_dir):
    return op.violation_counts(_faulty_bike(spark, sf_dir), bike_rules(), ["station_id"])


@query
def weather_violation_counts(spark, sf_dir):
    return op.violation_counts(_faulty_weather(spark, sf_dir), weather_rules(), ["station_id"])


@query
def weather_nonfinite_counts(spark, sf_dir):
    """Readings that are no numbers: kept as read, and counted by the ``finite`` rule."""
    readings = staging.weather_readings(staging.read_events(spark, sf_dir))
    n = F.col("offset")
    readings = readings.withColumn(
        "temp_c", F.when(n % 7 == 3, F.lit(float("nan"))).otherwise(F.col("temp_c"))
    ).withColumn(
        "wind_kph", F.when(n % 5 == 1, F.lit(float("inf"))).otherwise(F.col("wind_kph"))
    )
    bronze = _bronze(staging.enveloped(readings, "weather", S.WEATHER_EVENT.names))
    return op.violation_counts(op.weather_silver(bronze, "keep"), weather_rules(), ["station_id"])


# ---- offsets ---------------------------------------------------------------------


def _patchy_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One topic partition that lost some runs of messages and got some twice."""
    envelope = staging.bike_envelope(staging.read_events(spark, sf_dir)).withColumn("partition", F.lit(0))
    n = F.col("offset")
    there = envelope.where(~((n % 97).between(5, 7)) & ~((n % 1000).between(400, 480)))
    again = there.where(n % 53 == 0)
    return _bronze(there.unionAll(again).unionAll(again.where(n % 2 == 0)))


@query
def offset_gaps(spark, sf_dir):
    """Blocks far smaller than the default, so that runs end in later blocks too."""
    return op.offset_gaps(_patchy_bronze(spark, sf_dir), block=64)


@query
def offset_repeats(spark, sf_dir):
    return op.offset_repeats(_patchy_bronze(spark, sf_dir))


@query
def offsets_once(spark, sf_dir):
    """Repeated messages taken out of bronze again."""
    return op.without_repeats(_patchy_bronze(spark, sf_dir))


# ---- client reads ----------------------------------------------------------------


@query
def recent_bike(spark, sf_dir):
    return op.recent_bike(_bike(spark, sf_dir))


@query
def recent_bike_one_station(spark, sf_dir):
    return op.recent_bike(_bike(spark, sf_dir), station_id="S007", limit=25)


@query
def recent_weather(spark, sf_dir):
    return op.recent_weather(_weather(spark, sf_dir))


@query
def recent_bike_minute(spark, sf_dir):
    return op.recent_bike_minute(op.bike_minute(_bike(spark, sf_dir)))


@query
def recent_bike_hourly(spark, sf_dir):
    return _rounded(op.recent_bike_hourly(op.bike_usage(_bike(spark, sf_dir), "hour")))


@query
def recent_weather_hourly(spark, sf_dir):
    return _rounded(op.recent_weather_hourly(op.weather_summary(_weather(spark, sf_dir), "hour")))


@query
def bike_json_rows(spark, sf_dir):
    return op.as_json_rows(
        op.read_view(
            _bike(spark, sf_dir),
            ["event_time", "dt", "station_id", "bike_city", "docks_total", "bikes_available"],
        )
    )


@query
def weather_json_rows(spark, sf_dir):
    return op.as_json_rows(
        op.read_view(
            _weather(spark, sf_dir),
            ["station_id", "event_time", "temp_c", "precip_mm", "humidity", "condition"],
        )
    )


@query
def oldest_hours_one_station(spark, sf_dir):
    return op.read_view(
        op.bike_usage(_bike(spark, sf_dir), "hour"),
        ["window_start", "station_id", "bikes_occupied_hour", "docks_total"],
        {"station_id": "S003", "bike_city": None},
        order_by="window_start",
        descending=False,
        limit=40,
    )


def _json(view: str, frame) -> None:
    """Register ``<view>_json``: the rows of a read view as clients get them."""

    def build(spark, sf_dir):
        return op.as_json_rows(_rounded(getattr(op, view)(frame(spark, sf_dir))))

    build.__name__ = f"{view}_json"
    query(build)


_json("recent_bike", _bike)
_json("recent_weather", _weather)
_json("recent_bike_minute", lambda spark, sf_dir: op.bike_minute(_bike(spark, sf_dir)))
_json("recent_bike_hourly", lambda spark, sf_dir: op.bike_usage(_bike(spark, sf_dir), "hour"))
_json(
    "recent_weather_hourly",
    lambda spark, sf_dir: op.weather_summary(_weather(spark, sf_dir), "hour"),
)


@query
def bronze_json_rows(spark, sf_dir):
    """Broker times with fractions of a second."""
    bronze = _bike_bronze(spark, sf_dir)
    micros = F.timestamp_micros(F.unix_micros("kafka_timestamp") + F.col("offset") % 1_000_000)
    return op.as_json_rows(bronze.select("key", "offset", micros.alias("kafka_timestamp")))


# ---- stored tables ---------------------------------------------------------------


@query
def table_recent_bike(spark, sf_dir):
    """Write the silver table in batch; the read opens only the newest partitions."""
    layout = LakeLayout(scratch_dir(spark, "table_recent_bike"))
    write_table(_bike(spark, sf_dir), layout, S.SILVER_BIKE)
    return op.recent_bike(read_table(spark, layout, S.SILVER_BIKE), limit=500)


def _stored(spark, name: str, rows: DataFrame, spec: S.TableSpec) -> DataFrame:
    layout = LakeLayout(scratch_dir(spark, name))
    write_table(rows, layout, spec)
    return read_table(spark, layout, spec)


@query
def table_recent_weather(spark, sf_dir):
    stored = _stored(spark, "table_recent_weather", _weather(spark, sf_dir), S.SILVER_WEATHER)
    return op.recent_weather(stored, limit=500)


@query
def table_recent_bike_minute(spark, sf_dir):
    rows = op.bike_minute(_bike(spark, sf_dir))
    return op.recent_bike_minute(_stored(spark, "table_recent_minute", rows, S.GOLD_BIKE_MINUTE))


@query
def table_recent_bike_hourly(spark, sf_dir):
    rows = op.bike_usage(_bike(spark, sf_dir), "hour")
    return _rounded(
        op.recent_bike_hourly(_stored(spark, "table_recent_hourly", rows, S.GOLD_BIKE_HOURLY))
    )


@query
def table_recent_weather_hourly(spark, sf_dir):
    rows = op.weather_summary(_weather(spark, sf_dir), "hour")
    stored = _stored(spark, "table_recent_weather_hourly", rows, S.GOLD_WEATHER_HOURLY)
    return _rounded(op.recent_weather_hourly(stored))


@query
def newest_bike_one_station(spark, sf_dir):
    """Newest rows of a stored table by its newest folders alone, here for one station."""
    layout = LakeLayout(scratch_dir(spark, "newest_bike"))
    write_table(_bike(spark, sf_dir), layout, S.SILVER_BIKE)
    rows = newest(spark, layout, S.SILVER_BIKE, 25, F.col("station_id") == "S007")
    return op.recent_bike(rows, "S007", 25, newest_partitions=None)


@query
def newest_bike_minute(spark, sf_dir):
    """The same of a summary that was filled in batch, whose folders are named by the windows' start."""
    layout = LakeLayout(scratch_dir(spark, "newest_bike_minute"))
    write_table(_bike(spark, sf_dir), layout, S.SILVER_BIKE)
    backfill_summaries(spark, layout, date(2024, 3, 1), only=(S.GOLD_BIKE_MINUTE,))
    return op.recent_bike_minute(newest(spark, layout, S.GOLD_BIKE_MINUTE, 200), newest_partitions=None)


@query
def table_compacted(spark, sf_dir):
    """A table of many small files, copied with few."""
    layout = LakeLayout(scratch_dir(spark, "table_compacted"))
    source, target = LakeLayout(f"{layout.base}/small"), LakeLayout(f"{layout.base}/few")
    for turn in range(3):
        write_table(_weather(spark, sf_dir).where(F.pmod("pressure_mb", F.lit(3)) == turn), source, S.SILVER_WEATHER)
    rewrite_compact(spark, source, target, S.SILVER_WEATHER)
    return read_table(spark, target, S.SILVER_WEATHER)


@query
def table_compacted_twice(spark, sf_dir):
    """The same dates copied again replace the copy."""
    layout = LakeLayout(scratch_dir(spark, "table_compacted_twice"))
    source, target = LakeLayout(f"{layout.base}/small"), LakeLayout(f"{layout.base}/few")
    rows = op.bike_minute(_bike(spark, sf_dir))
    for turn in range(3):
        write_table(rows.where(F.minute("window_start") % 3 == turn), source, S.GOLD_BIKE_MINUTE)
    for _ in range(2):
        rewrite_compact(spark, source, target, S.GOLD_BIKE_MINUTE)
    return read_table(spark, target, S.GOLD_BIKE_MINUTE)


@query
def table_compacted_in_place(spark, sf_dir):
    """Small files of closed dates replaced twice, with rows appended to them in between."""
    layout = LakeLayout(scratch_dir(spark, "table_compacted_in_place"))
    rows = op.bike_minute(_bike(spark, sf_dir))
    for turn in range(3):
        write_table(rows.where(F.minute("window_start") % 3 == turn), layout, S.GOLD_BIKE_MINUTE)
        if turn:
            compact(spark, layout, S.GOLD_BIKE_MINUTE, CLOSED_BEFORE)
    return read_table(spark, layout, S.GOLD_BIKE_MINUTE)


@query
def table_expired(spark, sf_dir):
    """Whole dates deleted; what stays is what ``retained`` keeps."""
    layout = LakeLayout(scratch_dir(spark, "table_expired"))
    write_table(_bike(spark, sf_dir), layout, S.SILVER_BIKE)
    expire(spark, layout, S.SILVER_BIKE, RETENTION_AS_OF, 20)
    return read_table(spark, layout, S.SILVER_BIKE)


@query
def stream_expired(spark, sf_dir):
    """The same beside the log of a streaming sink, which goes on naming the deleted files."""
    layout = LakeLayout(f"{scratch_dir(spark, 'stream_expired')}/lake")
    _job(spark, layout, {"bike": staging.bike_envelope(staging.stream_events(spark, sf_dir))}, one_parse=False).run_available([S.SILVER_BIKE])
    expire(spark, layout, S.SILVER_BIKE, RETENTION_AS_OF, 20)
    return read_table(spark, layout, S.SILVER_BIKE)


@query
def table_batch_then_stream(spark, sf_dir):
    """Half of the rows written in batch, half by a stream, in one table."""
    layout = LakeLayout(scratch_dir(spark, "table_batch_then_stream"))
    even = staging.read_events(spark, sf_dir).where("event_id % 2 = 0")
    odd = staging.stream_events(spark, sf_dir).where("event_id % 2 = 1")
    write_table(op.bike_silver(_bronze(staging.bike_envelope(even))), layout, S.SILVER_BIKE)
    _job(spark, layout, {"bike": staging.bike_envelope(odd)}).run_available([S.SILVER_BIKE])
    return _rounded(read_table(spark, layout, S.SILVER_BIKE))


@query
def sql_after_append(spark, sf_dir):
    """Views over a partly filled lake; rows appended later are in the next query."""
    layout = LakeLayout(scratch_dir(spark, "sql_after_append"))
    bike = _bike(spark, sf_dir)
    write_table(bike.where("bikes_available % 2 = 0"), layout, S.SILVER_BIKE)
    register_views(spark, layout)
    write_table(bike.where("bikes_available % 2 = 1"), layout, S.SILVER_BIKE)
    return query_lake(
        spark,
        layout,
        """
        SELECT station_id, hour(event_time) AS hr, count(*) AS n_rows,
               (SELECT count(*) FROM quarantine_bike) AS refused
        FROM silver_bike_events GROUP BY station_id, hr
        """,
    )


@query
def sql_rain_and_usage(spark, sf_dir):
    """Write two summary tables in batch and join them in SQL through the views."""
    layout = LakeLayout(scratch_dir(spark, "sql_rain_and_usage"))
    write_table(
        op.weather_summary(_weather(spark, sf_dir), "hour"), layout, S.GOLD_WEATHER_HOURLY
    )
    write_table(op.bike_usage(_bike(spark, sf_dir), "hour"), layout, S.GOLD_BIKE_HOURLY)
    register_views(spark, layout, (S.GOLD_WEATHER_HOURLY, S.GOLD_BIKE_HOURLY))
    return spark.sql(
        """
        SELECT w.station_id, w.window_start, w.dt,
               round(w.sum_precip_mm_hour, 9) AS sum_precip_mm_hour, b.bikes_occupied_hour
        FROM gold_weather_hourly w
        JOIN gold_bike_usage_hourly b
          ON w.window_start = b.window_start AND w.station_id = b.station_id
        """
    )


# ---- streams ---------------------------------------------------------------------


def _job(spark: SparkSession, layout: LakeLayout, sources: dict, **options) -> LakeJob:
    return LakeJob(
        spark,
        layout,
        sources,
        lake_flows(quarantine=True, ingest_time=_ingest_time(), **options),
        shuffle_partitions=spark.sparkContext.defaultParallelism,
    )


def _streamed(spark: SparkSession, sf_dir: str, spec: S.TableSpec, replay: bool = False):
    """Run the flows that lead to one table over all events, and read the table."""
    base = scratch_dir(spark, f"stream_{spec.name}")
    layout = LakeLayout(f"{base}/lake")
    if replay:
        topic = "bike" if "bike" in spec.name else "weather"
        sources = {topic: EnvelopeFolder(f"{base}/topics/{topic}")}
        _publish(spark, sf_dir, sources)
    else:
        events = staging.stream_events(spark, sf_dir)
        sources = {
            "bike": staging.bike_envelope(events),
            "weather": staging.weather_envelope(events),
        }
    _job(spark, layout, sources).run_available([spec])
    return _rounded(read_table(spark, layout, spec))


def _publish(spark: SparkSession, sf_dir: str, sources: dict, files: int | None = None) -> None:
    events = staging.read_events(spark, sf_dir)
    if files:
        events = events.repartition(files, "event_id")
    make = {"bike": staging.bike_envelope, "weather": staging.weather_envelope}
    for topic, folder in sources.items():
        publish(make[topic](events), folder)


def _bounded(spark: SparkSession, sf_dir: str, spec: S.TableSpec, topic: str, cut: date | None = None, fills: int = 1):
    """Many unordered files per topic, worked off in bounded batches, with more shuffle partitions
    than cores. With ``cut``, earlier dates are filled in batch and the stream starts there."""
    base = scratch_dir(spark, f"bounded_{spec.name}")
    layout = LakeLayout(f"{base}/lake")
    sources = {topic: EnvelopeFolder(f"{base}/topics/{topic}", max_files_per_trigger=4)}
    _publish(spark, sf_dir, sources, files=12)
    job = LakeJob(
        spark,
        layout,
        sources,
        lake_flows(ingest_time=_ingest_time(), summaries_from=cut),
        max_files_per_trigger=200,
        shuffle_partitions=2 * spark.sparkContext.defaultParallelism,
    )
    if cut:
        silver = S.SILVER_BIKE if topic == "bike" else S.SILVER_WEATHER
        job.run_available([silver])
        for _ in range(fills):
            backfill_summaries(spark, layout, cut, only=(spec,))
    late = job.run_available([spec])[spec.view_name]["late_rows_dropped"]
    if late:
        raise AssertionError(f"{late} late rows")
    return _rounded(read_table(spark, layout, spec))


@query
def stream_bike_daily_bounded(spark, sf_dir):
    return _bounded(spark, sf_dir, S.GOLD_BIKE_DAILY, "bike")


@query
def stream_weather_hourly_bounded(spark, sf_dir):
    return _bounded(spark, sf_dir, S.GOLD_WEATHER_HOURLY, "weather")


@query
def stream_bike_daily_backfilled(spark, sf_dir):
    return _bounded(spark, sf_dir, S.GOLD_BIKE_DAILY, "bike", BACKFILL_UNTIL)


@query
def stream_bike_daily_backfilled_twice(spark, sf_dir):
    """The backfill is run again, as after a failure, and adds nothing."""
    return _bounded(spark, sf_dir, S.GOLD_BIKE_DAILY, "bike", BACKFILL_UNTIL, fills=2)


@query
def stream_weather_hourly_backfilled_twice(spark, sf_dir):
    """Hourly windows of one event date lie under two partition dates."""
    return _bounded(spark, sf_dir, S.GOLD_WEATHER_HOURLY, "weather", BACKFILL_UNTIL, fills=2)


def _with_forgotten(spark: SparkSession, sf_dir: str, name: str, backfilled: bool) -> LakeLayout:
    """A lake whose daily summary lacks rows: every fiftieth event of the first days came after its day was
    summarised, by a stream, or in batch with the stream starting at a later date."""
    base = scratch_dir(spark, name)
    layout = LakeLayout(f"{base}/lake")
    folder = EnvelopeFolder(f"{base}/topics/bike")
    events = staging.read_events(spark, sf_dir)
    late = (F.col("event_id") % 50 == 7) & (F.col("ts") < F.lit(FORGOTTEN_BEFORE.isoformat()).cast("timestamp_ntz"))
    publish(staging.bike_envelope(events.where(~late)), folder)
    cut = FORGOTTEN_BEFORE if backfilled else None
    job = _job(spark, layout, {"bike": folder}, summaries_from=cut)
    if backfilled:
        job.run_available([S.SILVER_BIKE])
        backfill_summaries(spark, layout, cut, only=(S.GOLD_BIKE_DAILY,))
    job.run_available([S.GOLD_BIKE_DAILY])
    # What comes late has later offsets.
    publish(staging.bike_envelope(events.where(late)).withColumn("offset", F.col("offset") + 10**9), folder)
    job.run_available([S.GOLD_BIKE_DAILY])
    return layout


@query
def late_rows_table(spark, sf_dir):
    """The rows themselves, told apart from those that were summarised in the same windows."""
    return _rounded(late_rows(spark, _with_forgotten(spark, sf_dir, "late_rows_table", False), S.GOLD_BIKE_DAILY))


@query
def late_windows_after_backfill(spark, sf_dir):
    """Windows whose rows came after the backfill, which no watermark ever saw."""
    layout = _with_forgotten(spark, sf_dir, "late_windows", True)
    gaps = summary_gaps(spark, layout, S.GOLD_BIKE_DAILY)
    return gaps.select("station_id", "bike_city", "window_start", "window_end", "n_rows", "n_summarised", "n_missed", "n_summaries")


@query
def restated_bike_daily(spark, sf_dir):
    layout = _with_forgotten(spark, sf_dir, "restated", False)
    for _ in range(2):
        restate(spark, layout, S.GOLD_BIKE_DAILY)
    return _rounded(read_table(spark, layout, S.GOLD_BIKE_DAILY))


@query
def restated_after_backfill(spark, sf_dir):
    layout = _with_forgotten(spark, sf_dir, "restated_backfill", True)
    restate(spark, layout, S.GOLD_BIKE_DAILY, until=FORGOTTEN_BEFORE)
    return _rounded(read_table(spark, layout, S.GOLD_BIKE_DAILY))


@query
def stream_open_windows(spark, sf_dir):
    """What the stream has read and not yet written: the windows in its state."""
    layout = LakeLayout(f"{scratch_dir(spark, 'stream_open_windows')}/lake")
    _job(spark, layout, {"bike": staging.bike_envelope(staging.stream_events(spark, sf_dir))}).run_available([S.GOLD_BIKE_DAILY])
    return open_windows(spark, layout, S.GOLD_BIKE_DAILY)


@query
def stream_weather_bike_hourly(spark, sf_dir):
    """Two windowed aggregates and their join in one stream."""
    layout = LakeLayout(f"{scratch_dir(spark, 'stream_weather_bike')}/lake")
    events = staging.stream_events(spark, sf_dir)
    sources = {"bike": staging.bike_envelope(events), "weather": staging.weather_envelope(events)}
    _job(spark, layout, sources, joined=True).run_available([S.GOLD_WEATHER_BIKE])
    return _rounded(read_table(spark, layout, S.GOLD_WEATHER_BIKE))


@query
def stream_silver_with_quarantine(spark, sf_dir):
    """Silver from the flow that fills the quarantine from the same parse; the topic comes in several files."""
    base = scratch_dir(spark, "stream_silver_with_quarantine")
    layout, folder = LakeLayout(f"{base}/lake"), EnvelopeFolder(f"{base}/topics/bike", max_files_per_trigger=1)
    events = staging.read_events(spark, sf_dir).repartition(3, "event_id")
    publish(staging.with_broken_texts(staging.bike_envelope(events)), folder)
    _job(spark, layout, {"bike": folder}).run_available([S.SILVER_BIKE, S.QUARANTINE_BIKE])
    return _rounded(read_table(spark, layout, S.SILVER_BIKE))


@query
def stream_quality_totals(spark, sf_dir):
    """The counts a stream observes on its way into silver, summed over its batches."""
    layout = LakeLayout(f"{scratch_dir(spark, 'stream_quality_totals')}/lake")
    readings = staging.with_weather_faults(staging.weather_readings(staging.stream_events(spark, sf_dir)))
    envelope = staging.with_broken_texts(staging.enveloped(readings, "weather", S.WEATHER_EVENT.names))
    seen = _job(spark, layout, {"weather": envelope}).run_available([S.SILVER_WEATHER])
    observed = seen[S.SILVER_WEATHER.view_name]["observed"]
    counts = {**observed["messages"], **observed["quality"]}
    return spark.createDataFrame([tuple(counts.values())], ", ".join(f"{name} long" for name in counts))


@query
def stream_bike_hourly_composed(spark, sf_dir):
    """Topic to summary in one plan."""
    layout = LakeLayout(f"{scratch_dir(spark, 'stream_composed')}/lake")
    events = staging.stream_events(spark, sf_dir)
    job = LakeJob(
        spark,
        layout,
        {"bike": staging.bike_envelope(events)},
        lake_flows(ingest_time=_ingest_time(), composed=True),
        shuffle_partitions=spark.sparkContext.defaultParallelism,
    )
    job.run_available([S.GOLD_BIKE_HOURLY])
    return _rounded(read_table(spark, layout, S.GOLD_BIKE_HOURLY))


@query
def stream_quarantine_weather(spark, sf_dir):
    """Malformed weather messages of a stream, routed to their own table."""
    layout = LakeLayout(f"{scratch_dir(spark, 'stream_quarantine_weather')}/lake")
    envelope = staging.with_broken_texts(
        staging.weather_envelope(staging.stream_events(spark, sf_dir))
    )
    _job(spark, layout, {"weather": envelope}).run_available([S.QUARANTINE_WEATHER])
    return read_table(spark, layout, S.QUARANTINE_WEATHER)


@query
def stream_late_rows(spark, sf_dir):
    """Two files read in turn: what comes a batch after its window closed is dropped.

    Events of the first 20 days come first, then the others with every third event of the
    first days again: their windows have closed, so the summary must not count them.
    """
    base = scratch_dir(spark, "stream_late_rows")
    layout = LakeLayout(f"{base}/lake")
    folder = EnvelopeFolder(f"{base}/topics/bike")
    events = staging.read_events(spark, sf_dir)
    early = F.col("ts") < F.lit(LATE_FROM.isoformat()).cast("timestamp_ntz")
    flows = lake_flows(ingest_time=_ingest_time(), composed=True)
    job = LakeJob(spark, layout, {"bike": folder}, flows, shuffle_partitions=spark.sparkContext.defaultParallelism)
    publish(staging.bike_envelope(events.where(early)), folder)
    job.run_available([S.GOLD_BIKE_DAILY])
    again = events.where(early & (F.col("event_id") % 3 == 0) & (F.col("ts") < F.lit(CLOSED_BEFORE.isoformat()).cast("timestamp_ntz")))
    publish(staging.bike_envelope(events.where(~early).union(again)), folder)
    job.run_available([S.GOLD_BIKE_DAILY])
    return _rounded(read_table(spark, layout, S.GOLD_BIKE_DAILY))


@query
def stream_bronze_bike(spark, sf_dir):
    return _streamed(spark, sf_dir, S.BRONZE_BIKE, replay=True)


@query
def stream_bronze_weather(spark, sf_dir):
    return _streamed(spark, sf_dir, S.BRONZE_WEATHER, replay=True)


@query
def stream_silver_bike(spark, sf_dir):
    return _streamed(spark, sf_dir, S.SILVER_BIKE)


@query
def stream_silver_weather(spark, sf_dir):
    return _streamed(spark, sf_dir, S.SILVER_WEATHER)


@query
def stream_bike_hourly(spark, sf_dir):
    return _streamed(spark, sf_dir, S.GOLD_BIKE_HOURLY)


@query
def stream_bike_daily(spark, sf_dir):
    return _streamed(spark, sf_dir, S.GOLD_BIKE_DAILY)


@query
def stream_bike_minute(spark, sf_dir):
    return _streamed(spark, sf_dir, S.GOLD_BIKE_MINUTE)


@query
def stream_weather_hourly(spark, sf_dir):
    return _streamed(spark, sf_dir, S.GOLD_WEATHER_HOURLY)


@query
def stream_weather_daily(spark, sf_dir):
    return _streamed(spark, sf_dir, S.GOLD_WEATHER_DAILY)


@query
def stream_quarantine(spark, sf_dir):
    """Malformed messages of a stream, routed to their own table with their text."""
    layout = LakeLayout(f"{scratch_dir(spark, 'stream_quarantine')}/lake")
    envelope = staging.with_broken_texts(
        staging.bike_envelope(staging.stream_events(spark, sf_dir))
    )
    _job(spark, layout, {"bike": envelope}).run_available([S.QUARANTINE_BIKE])
    return read_table(spark, layout, S.QUARANTINE_BIKE)
