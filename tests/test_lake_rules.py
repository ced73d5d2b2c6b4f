"""Tables written both ways, views of the present, bounded backlogs, supervision."""

from __future__ import annotations

import json
from dataclasses import replace
from datetime import date

import pytest
from helpers import bike, bronze, drop_into, weather
from pyspark.sql import functions as F

from rillstone import LakeLayout, query_lake, register_views
from rillstone import schemas as S
from rillstone.__main__ import arguments, source_for
from rillstone.operators import as_json_rows, bike_silver, bike_usage, recent_bike, weather_silver, weather_violations
from rillstone.sources import EnvelopeFolder, ensure_table, read_table, rewrite_compact, stream_table, write_table
from rillstone.streaming import Flow, LakeJob, backfill_summaries, lake_flows


def job(spark, layout, folder, flows=None, **bounds):
    return LakeJob(spark, layout, {"bike": EnvelopeFolder(folder)}, flows or lake_flows(), **bounds)


def silver(spark, events):
    return bike_silver(bronze(spark, events))


@pytest.mark.parametrize("batch_first", [True, False])
def test_batch_and_stream_rows_are_one_table(spark, tmp_path, batch_first):
    layout, folder = LakeLayout(str(tmp_path / "lake")), str(tmp_path / "bike")
    drop_into(spark, folder, [bike("S002"), bike("S003")])

    def batch():
        write_table(silver(spark, [bike("S001", available=k) for k in range(5)]), layout, S.SILVER_BIKE)

    if batch_first:
        batch()
    job(spark, layout, folder).run_available([S.SILVER_BIKE])
    if not batch_first:
        batch()
    assert read_table(spark, layout, S.SILVER_BIKE).count() == 7
    batch()
    assert read_table(spark, layout, S.SILVER_BIKE).count() == 12
    # A summary follows rows written either way.
    drop_into(spark, folder, [bike("S002", at="2024-01-09T00:00:00Z")])
    job(spark, layout, folder).run_available([S.GOLD_BIKE_HOURLY])
    assert read_table(spark, layout, S.GOLD_BIKE_HOURLY).agg(F.count("*")).first()[0] == 3


def test_views_of_a_growing_and_partial_lake(spark, tmp_path):
    layout = LakeLayout(str(tmp_path))
    names = register_views(spark, layout)
    assert "quarantine_bike" in names and spark.table("silver_bike_events").count() == 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_table(spark, layout, S.SILVER_BIKE)
    for n in (1, 2):
        write_table(silver(spark, [bike()]), layout, S.SILVER_BIKE)
        assert query_lake(spark, layout, "SELECT * FROM silver_bike_events").count() == n


def test_bounded_batches_lose_no_summary_row(spark, tmp_path):
    layout, folder = LakeLayout(str(tmp_path / "lake")), str(tmp_path / "bike")
    for day in (9, 2, 7, 3, 8, 1):
        drop_into(spark, folder, [bike(at=f"2024-01-0{day}T10:00:00Z")])
    source = EnvelopeFolder(folder, max_files_per_trigger=1)
    seen = LakeJob(spark, layout, {"bike": source}, max_files_per_trigger=1).run_available([S.GOLD_BIKE_DAILY])
    assert seen["silver_bike_events"]["batches"] >= 6 and seen["bronze_bike"]["rows_in"] == 6
    assert seen["gold_bike_usage_daily"]["late_rows_dropped"] == 0
    assert read_table(spark, layout, S.GOLD_BIKE_DAILY).count() == 5  # the newest day is open


def test_backfill_then_stream(spark, tmp_path):
    layout = LakeLayout(str(tmp_path / "lake"))
    rows = silver(spark, [bike(at=f"2024-01-0{d}T{h}:30:00Z", available=d) for d in range(1, 8) for h in (10, 23)])
    write_table(rows, layout, S.SILVER_BIKE)
    backfill_summaries(spark, layout, date(2024, 1, 4), only=(S.GOLD_BIKE_HOURLY,))
    backfill_summaries(spark, layout, date(2024, 1, 5), date(2024, 1, 4), only=(S.GOLD_BIKE_HOURLY,))
    later = lake_flows(summaries_from=date(2024, 1, 5))
    hourly = tuple(f for f in later if f.target == S.GOLD_BIKE_HOURLY)
    LakeJob(spark, layout, {}, hourly).run_available()
    key = ["window_start", "bikes_occupied_hour", "dt"]
    expected = bike_usage(rows, "hour").where("window_start < '2024-01-07 23:00:00'").select(key).collect()
    assert sorted(read_table(spark, layout, S.GOLD_BIKE_HOURLY).select(key).collect()) == sorted(expected)


def test_compact_copy(spark, tmp_path):
    small, few = LakeLayout(str(tmp_path / "a")), LakeLayout(str(tmp_path / "b"))
    for k in range(4):
        write_table(silver(spark, [bike(available=k), bike(at="2024-01-05T00:00:00Z", available=k)]), small, S.SILVER_BIKE)
    before = read_table(spark, small, S.SILVER_BIKE)
    rewrite_compact(spark, small, few, S.SILVER_BIKE, until=date(2024, 1, 5))
    after = read_table(spark, few, S.SILVER_BIKE)
    assert len(after.inputFiles()) == 1 and len(before.inputFiles()) == 8
    assert sorted(after.collect()) == sorted(before.where("dt < '2024-01-05'").collect())
    ensure_table(spark, small, S.SILVER_BIKE)  # as a job does before it follows a table
    assert stream_table(spark, small, S.SILVER_BIKE).isStreaming and before.count() == 8


def test_recent_view_of_few_rows_takes_all_dates(spark, tmp_path):
    layout = LakeLayout(str(tmp_path))
    write_table(silver(spark, [bike(at=f"2024-01-0{d}T10:00:00Z") for d in range(1, 7)] + [bike(at="never")]), layout, S.SILVER_BIKE)
    stored = read_table(spark, layout, S.SILVER_BIKE)
    for n in (1, 2, 3, 5, 6, 7, 100):
        assert recent_bike(stored, limit=n).collect() == recent_bike(stored, limit=n, newest_partitions=None).collect()


def test_json_rows_keep_fractions_and_numbers(spark):
    df = spark.sql("SELECT timestamp'2024-01-01 00:00:00.123456' t, timestamp'2024-01-01 00:00:00' w, double('NaN') n, 1.5D x")
    assert json.loads(as_json_rows(df).first().json) == {"t": "2024-01-01 00:00:00.123456", "w": "2024-01-01 00:00:00", "n": None, "x": 1.5}


def test_numbers_that_are_none(spark):
    odd = ['{"station_id":"S1","temp_c":"NaN","wind_kph":"Infinity"}', '{"station_id":"S2","temp_c":1.0}', '{"station_id":"  "}']
    assert [r.station_id for r in weather_silver(bronze(spark, odd)).collect()] == ["S2"]
    broken = weather_violations(weather_silver(bronze(spark, odd), "keep")).collect()
    assert [(r.station_id, r.broken_rules) for r in broken] == [("S1", "finite")]


def test_flows_that_cannot_run_are_refused(spark, tmp_path):
    layout = LakeLayout(str(tmp_path))
    copy = lambda df: df
    with pytest.raises(ValueError, match="made from itself"):
        LakeJob(spark, layout, {}, (Flow(S.SILVER_BIKE, S.SILVER_BIKE, copy),))
    with pytest.raises(ValueError, match="made from itself"):
        LakeJob(spark, layout, {}, (Flow(S.BRONZE_BIKE, S.SILVER_BIKE, copy), Flow(S.SILVER_BIKE, S.BRONZE_BIKE, copy)))
    with pytest.raises(ValueError, match="more than one flow"):
        LakeJob(spark, layout, {}, lake_flows() + lake_flows())


def test_totals_outlast_the_reports_spark_keeps(spark, tmp_path):
    kept = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "3")
    try:
        layout, folder = LakeLayout(str(tmp_path / "lake")), str(tmp_path / "bike")
        running = job(spark, layout, folder, tuple(f for f in lake_flows(every=None) if f.target == S.BRONZE_BIKE))
        drop_into(spark, folder, [bike()])
        running.start()
        for k in range(1, 9):
            for _ in range(200):
                if running.progress()["bronze_bike"]["rows_in"] >= k:
                    break
                running.queries["bronze_bike"].awaitTermination(0.1)
            drop_into(spark, folder, [bike()])
        assert running.progress()["bronze_bike"]["rows_in"] >= 8
        running.stop()
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", kept)


def test_composed_flows_read_topics_only(spark, tmp_path):
    flows = lake_flows(composed=True)
    assert {f.source for f in flows} == {"bike", "weather"}
    layout, folder = LakeLayout(str(tmp_path / "lake")), str(tmp_path / "weather")
    drop_into(spark, folder, [weather(), weather(at="2024-01-05T00:00:00Z"), "{}"], "weather")
    LakeJob(spark, layout, {"weather": EnvelopeFolder(folder)}, flows).run_available([S.GOLD_WEATHER_DAILY, S.QUARANTINE_WEATHER])
    assert read_table(spark, layout, S.GOLD_WEATHER_DAILY).count() == 1
    assert read_table(spark, layout, S.QUARANTINE_WEATHER).count() == 1


def test_new_arguments():
    chosen = arguments(["--base", "x", "--brokers", "h:1", "--fail-on-data-loss", "--no-quarantine", "--composed", "--summaries-from", "2024-01-05"])
    assert source_for(chosen, "bike").read_options()["failOnDataLoss"] == "true"
    assert not chosen.quarantine and chosen.composed and chosen.summaries_from == date(2024, 1, 5)
    assert arguments(["--base", "x", "--brokers", "h:1"]).every == "2 minutes"


def test_writers_of_the_minute_table_follow_the_session(spark):
    assert replace(S.GOLD_BIKE_MINUTE).spread_by == ("station_id",)
