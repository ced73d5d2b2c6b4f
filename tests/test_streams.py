"""Streams: lateness, restarts, failures, skew, sources."""

from __future__ import annotations

import os
import time
from datetime import datetime
from types import SimpleNamespace

import pytest
from helpers import bike, bronze, drop_into, rows_of, weather
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from rillstone import LakeLayout, scratch_dir
from rillstone import schemas as S
from rillstone.__main__ import arguments, main, source_for
from rillstone.operators import bike_silver, bike_usage, to_bronze
from rillstone.plans import registry
from rillstone.session import ROCKSDB_PROVIDER, rocksdb_options, s3a_options, settings
from rillstone.sources import (
    EnvelopeFolder,
    KafkaTopic,
    publish,
    read_envelope_stream,
    read_table,
    staging,
    to_envelope,
    write_table,
)
from rillstone.streaming import Flow, FlowFailed, LakeJob, lake_flows


@pytest.fixture
def place(tmp_path):
    """A lake and one envelope folder per topic."""
    return SimpleNamespace(
        layout=LakeLayout(str(tmp_path / "lake")),
        bike=str(tmp_path / "bike"),
        weather=str(tmp_path / "weather"),
    )


def run(spark, place, *only, **options):
    job = LakeJob(
        spark, place.layout,
        {"bike": EnvelopeFolder(place.bike), "weather": EnvelopeFolder(place.weather)},
        lake_flows(**options),
    )
    return job.run_available(only or None)


def table(spark, place, spec):
    return read_table(spark, place.layout, spec)


HOURLY = S.GOLD_BIKE_HOURLY


def test_all_nine_tables(spark, place):
    drop_into(spark, place.bike, [bike(), bike(at="2024-01-03T00:00:00Z"), "not json", None, " "])
    drop_into(spark, place.weather, [weather(), weather(at="2024-01-03T00:00:00Z")], "weather")
    progress = run(spark, place)
    assert len(progress) == 11
    counts = {spec.view_name: table(spark, place, spec).count() for spec in S.TABLES}
    assert counts == {
        "bronze_bike": 5, "bronze_weather": 2, "silver_bike_events": 2,
        "silver_weather_events": 2, "gold_bike_usage_hourly": 1, "gold_bike_usage_daily": 1,
        "gold_weather_hourly": 1, "gold_weather_daily": 1, "gold_bike_minute": 1,
        "quarantine_bike": 3, "quarantine_weather": 0,
    }
    assert progress["gold_bike_usage_hourly"]["watermark"] == "2024-01-02T23:45:00.000Z"
    assert not any(p["active"] for p in progress.values())


def test_late_row_for_an_open_window_counts(spark, place):
    drop_into(spark, place.bike, [bike(at="2024-01-01T11:10:00Z")])
    run(spark, place, HOURLY)
    assert table(spark, place, HOURLY).count() == 0
    drop_into(spark, place.bike, [bike(at="2024-01-01T10:30:00Z")])
    run(spark, place, HOURLY)
    drop_into(spark, place.bike, [bike(at="2024-01-01T11:20:00Z")])
    run(spark, place, HOURLY)
    got = table(spark, place, HOURLY).select("window_start", "bikes_occupied_hour")
    assert rows_of(got) == [(datetime(2024, 1, 1, 10), 6)]


def test_late_row_for_a_closed_window_is_dropped_from_gold_only(spark, place):
    drop_into(spark, place.bike, [bike(at="2024-01-01T10:05:00Z")])
    run(spark, place, HOURLY)
    drop_into(spark, place.bike, [bike(at="2024-01-01T11:20:00Z")])
    run(spark, place, HOURLY)
    drop_into(spark, place.bike, [bike(at="2024-01-01T10:30:00Z")])
    progress = run(spark, place, HOURLY)
    assert table(spark, place, S.SILVER_BIKE).count() == 3
    got = table(spark, place, HOURLY).select("window_start", "bikes_occupied_hour")
    assert rows_of(got) == [(datetime(2024, 1, 1, 10), 6)]
    assert progress["gold_bike_usage_hourly"]["late_rows_dropped"] == 1


def test_row_in_the_batch_that_closes_its_window_counts(spark, place):
    drop_into(spark, place.bike, [bike(at="2024-01-01T10:05:00Z")])
    run(spark, place, HOURLY)
    drop_into(
        spark, place.bike, [bike(at="2024-01-01T11:20:00Z"), bike(at="2024-01-01T10:30:00Z")]
    )
    run(spark, place, HOURLY)
    got = table(spark, place, HOURLY).select("window_start", "bikes_occupied_hour")
    assert rows_of(got) == [(datetime(2024, 1, 1, 10), 12)]


def test_restart_neither_loses_nor_repeats(spark, place):
    drop_into(spark, place.bike, [bike(at="2024-01-01T10:05:00Z"), bike(at="2024-01-01T12:00:00Z")])
    run(spark, place, HOURLY)
    run(spark, place, HOURLY)
    assert table(spark, place, HOURLY).count() == 1
    drop_into(spark, place.bike, [bike(at="2024-01-01T12:30:00Z"), bike(at="2024-01-01T14:00:00Z")])
    run(spark, place, HOURLY)
    assert table(spark, place, S.BRONZE_BIKE).count() == 4
    assert table(spark, place, S.SILVER_BIKE).count() == 4
    got = table(spark, place, HOURLY).select(F.hour("window_start"), "bikes_occupied_hour")
    assert rows_of(got) == [(10, 6), (12, 12)]


def test_stream_equals_batch_on_closed_windows(spark, place, sf_dir):
    events = staging.read_events(spark, sf_dir)
    publish(staging.bike_envelope(events).repartition(3), EnvelopeFolder(place.bike))
    with settings(spark, rocksdb_options()):
        assert spark.conf.get(
            "spark.sql.streaming.stateStore.providerClass") == ROCKSDB_PROVIDER
        run(spark, place, S.GOLD_BIKE_MINUTE)
    silver = bike_silver(registry._bronze(staging.bike_envelope(events)))
    cut = silver.agg(F.max("event_time") - F.expr("INTERVAL 15 MINUTES")).first()[0]
    from rillstone.operators import bike_minute

    batch = bike_minute(silver).where(F.col("window_end") <= F.lit(cut))
    stream = table(spark, place, S.GOLD_BIKE_MINUTE)
    assert stream.exceptAll(batch).count() == 0 and batch.exceptAll(stream).count() == 0


def test_bounded_batches_give_the_same_silver(spark, place):
    for n in range(4):
        drop_into(spark, place.bike, [bike(f"S00{n}"), bike("S009")])
    job = LakeJob(
        spark, place.layout, {"bike": EnvelopeFolder(place.bike, max_files_per_trigger=1)},
        max_files_per_trigger=2,
    )
    progress = job.run_available([S.SILVER_BIKE])
    assert table(spark, place, S.SILVER_BIKE).count() == 8
    assert progress["bronze_bike"]["batches"] >= 4
    assert progress["silver_bike_events"]["batches"] >= 2


def test_text_ids_survive_the_whole_chain(spark, place):
    drop_into(spark, place.bike, [bike("007"), bike("007", at="2024-01-02T00:00:00Z")])
    run(spark, place, HOURLY)
    assert rows_of(table(spark, place, HOURLY).select("station_id")) == [("007",)]


def test_keep_and_quarantine(spark, place):
    drop_into(spark, place.bike, [bike(), "not json", "{}", "", None])
    run(spark, place, S.SILVER_BIKE, S.QUARANTINE_BIKE, on_malformed="keep", quarantine=True)
    assert table(spark, place, S.SILVER_BIKE).count() == 3
    refused = table(spark, place, S.QUARANTINE_BIKE)
    assert rows_of(refused.select("value")) == sorted(
        [("not json",), ("{}",), ("",), (None,)], key=repr
    )


def test_files_with_old_dates_are_not_skipped(spark, place):
    drop_into(spark, place.bike, [bike()])
    run(spark, place, S.BRONZE_BIKE)
    known = set(os.listdir(place.bike))
    drop_into(spark, place.bike, [bike("S002")])
    for name in set(os.listdir(place.bike)) - known:
        os.utime(os.path.join(place.bike, name), (1_500_000_000, 1_500_000_000))
    run(spark, place, S.BRONZE_BIKE)
    assert table(spark, place, S.BRONZE_BIKE).count() == 2


def test_json_envelopes(spark, place):
    publish(
        to_envelope(spark.createDataFrame([bike()]), "bike"), EnvelopeFolder(place.bike, "json")
    )
    job = LakeJob(spark, place.layout, {"bike": EnvelopeFolder(place.bike, "json")})
    job.run_available([S.SILVER_BIKE])
    assert table(spark, place, S.SILVER_BIKE).first().bikes_available == 4


def test_hot_station_is_split_in_a_stream(spark, place):
    """Two thirds of a batch in one station: several tasks write it, nothing is lost."""
    hot = spark.range(40_000).select(
        F.when(F.col("id") % 3 > 0, "S001").otherwise("S002").alias("station_id"),
        F.sha2(F.col("id").cast("string"), 256).alias("bike_city"),
        F.lit(10).alias("docks_total"), F.lit(4).alias("bikes_available"),
        F.lit("2024-01-01T10:00:00Z").alias("event_time"),
    ).repartition(8)
    publish(to_envelope(hot, "bike"), EnvelopeFolder(place.bike))
    with settings(spark, {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "256k"}):
        run(spark, place, S.SILVER_BIKE)
    silver = table(spark, place, S.SILVER_BIKE)
    files = silver.where("station_id = 'S001'").select(F.input_file_name()).distinct().count()
    assert files >= 4
    assert silver.count() == 40_000


def _failing_flows():
    def fail(df):
        return to_bronze(df).withColumn(
            "value", F.when(F.col("offset") >= 0, F.raise_error(F.lit("bad luck")).cast("string"))
        )

    return (
        Flow("bike", S.BRONZE_BIKE, fail),
        Flow("weather", S.BRONZE_WEATHER, to_bronze),
    )


def test_failure_names_the_flow_and_stops_the_rest(spark, place):
    drop_into(spark, place.bike, [bike()])
    drop_into(spark, place.weather, [weather()], "weather")
    sources = {"bike": EnvelopeFolder(place.bike), "weather": EnvelopeFolder(place.weather)}
    job = LakeJob(spark, place.layout, sources, _failing_flows())
    with pytest.raises(FlowFailed, match="bad luck") as failure:
        job.run(poll_seconds=1)
    assert failure.value.name == "bronze_bike"
    assert not any(q.isActive for q in job.queries.values())
    with pytest.raises(FlowFailed):
        LakeJob(spark, place.layout, sources, _failing_flows()).run_available()


def test_a_flow_that_cannot_start_stops_those_that_did(spark, place):
    drop_into(spark, place.bike, [bike()])
    job = LakeJob(
        spark, place.layout,
        {"bike": EnvelopeFolder(place.bike), "weather": KafkaTopic("host:9092", "weather")},
    )
    with pytest.raises(AnalysisException, match="(?i)kafka"):
        job.start()
    assert list(job.queries) == ["bronze_bike"]
    assert not job.queries["bronze_bike"].isActive


def test_unknown_table_is_an_error(spark, place):
    with pytest.raises(ValueError, match="quarantine_bike"):
        LakeJob(spark, place.layout, {}, lake_flows(quarantine=False)).run_available([S.QUARANTINE_BIKE])


def test_continuous_run_follows_the_source(spark, place):
    drop_into(spark, place.bike, [bike()])
    """With a processing-time trigger."""
    flows = tuple(f for f in lake_flows(every="1 second") if f.target in (S.BRONZE_BIKE, S.SILVER_BIKE))
    job = LakeJob(spark, place.layout, {"bike": EnvelopeFolder(place.bike)}, flows)
    job.start()

    def seen(n):
        for _ in range(60):
            if table(spark, place, S.SILVER_BIKE).count() == n:
                return True
            time.sleep(0.5)
        return False

    try:
        assert seen(1)
        drop_into(spark, place.bike, [bike("S002"), bike("S003")])
        assert seen(3)
    finally:
        job.stop()
    job.wait(1)
    assert not any(p["active"] for p in job.progress().values())


def test_summary_of_a_stored_table_is_the_batch_summary(spark, place):
    write_table(bike_silver(bronze(spark, [bike(), bike("S002")])), place.layout, S.SILVER_BIKE)
    stored = table(spark, place, S.SILVER_BIKE)
    assert bike_usage(stored, "hour").count() == 2


def test_kafka_options():
    topic = KafkaTopic("host:9092", "bike", max_offsets_per_trigger=10, min_partitions=64)
    assert topic.read_options() == {
        "kafka.bootstrap.servers": "host:9092", "subscribe": "bike",
        "startingOffsets": "latest", "failOnDataLoss": "false",
        "maxOffsetsPerTrigger": "10", "minPartitions": "64",
    }
    assert topic.write_options() == {"kafka.bootstrap.servers": "host:9092"}
    assert KafkaTopic("h", "t", "earliest").read_options()["startingOffsets"] == "earliest"


def test_kafka_without_its_connector_says_so(spark):
    with pytest.raises(AnalysisException, match="(?i)kafka"):
        read_envelope_stream(spark, KafkaTopic("host:9092", "bike"))


def test_object_store_options():
    plain = s3a_options("http://store:9000")
    assert plain["spark.hadoop.fs.s3a.endpoint"] == "store:9000"
    assert plain["spark.hadoop.fs.s3a.connection.ssl.enabled"] == "false"
    assert "spark.hadoop.fs.s3a.access.key" not in plain
    keyed = s3a_options("https://store", "id", "secret")
    assert keyed["spark.hadoop.fs.s3a.connection.ssl.enabled"] == "true"
    assert keyed["spark.hadoop.fs.s3a.secret.key"] == "secret"


def test_scratch_dir_is_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert first.startswith(f"{shared}/x-") and first != second


def test_scratch_dir_refuses_local_folders_on_a_cluster():
    def session(master):
        return SimpleNamespace(
            conf=SimpleNamespace(get=lambda name, default: default),
            sparkContext=SimpleNamespace(master=master),
        )

    with pytest.raises(ValueError):
        scratch_dir(session("yarn"), "x")
    assert "/x-" in scratch_dir(session("local[2]"), "x")


def test_settings_are_restored(spark):
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(name)
    with settings(spark, {name: "false", "spark.rillstone.none": "1"}):
        assert spark.conf.get(name) == "false"
    assert spark.conf.get(name) == before
    assert spark.conf.get("spark.rillstone.none", None) is None


def test_command_line(spark, place, capsys):
    with pytest.raises(SystemExit):
        arguments(["--base", "x"])
    chosen = arguments(["--base", "x", "--brokers", "h:1", "--bike-topic", "b2"])
    assert source_for(chosen, "bike") == KafkaTopic("h:1", "b2")
    drop_into(spark, place.bike, [bike(), bike(at="2024-01-01T12:00:00Z")])
    drop_into(spark, place.weather, [weather()], "weather")
    main([
        "--base", place.layout.base, "--bike-folder", place.bike,
        "--weather-folder", place.weather, "--available-now", "--quarantine",
    ])
    spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    assert table(spark, place, HOURLY).count() == 1
    assert "gold_bike_usage_hourly" in capsys.readouterr().out
