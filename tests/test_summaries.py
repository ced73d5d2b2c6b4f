from __future__ import annotations

from datetime import date, datetime

import pytest
from helpers import bike, bronze, plan_of, rows_of, weather
from pyspark.sql import functions as F

from rillstone import schemas as S
from rillstone.operators import (
    bike_minute,
    bike_silver,
    bike_usage,
    weather_silver,
    weather_summary,
    window_agg,
)
from rillstone.plans import registry
from rillstone.sources import staging


def silver(spark, *events):
    return bike_silver(bronze(spark, list(events)))


def test_hourly_measures(spark):
    row = bike_usage(
        silver(spark, bike(available=4), bike(available=6, at="2024-01-01T10:59:59Z")), "hour"
    ).collect()[0]
    assert row.bikes_occupied_hour == 10
    assert row.bikes_available_avg_hour == 5.0
    assert row.availability_rate_avg_hour == pytest.approx(0.5)
    assert row.utilization_rate_avg_hour == pytest.approx(0.5)
    assert row.docks_total == 10
    assert (row.window_start, row.window_end) == (
        datetime(2024, 1, 1, 10), datetime(2024, 1, 1, 11),
    )


def test_window_start_is_inside_and_end_outside(spark):
    events = [bike(at=f"2024-01-01T{t}Z") for t in ("10:00:00", "10:59:59", "11:00:00")]
    starts = bike_usage(silver(spark, *events), "hour").select("window_start", "bikes_occupied_hour")
    assert rows_of(starts) == [
        (datetime(2024, 1, 1, 10), 12), (datetime(2024, 1, 1, 11), 6),
    ]


def test_partition_date_rules(spark):
    late = silver(spark, bike(at="2024-01-01T23:30:00Z"))
    assert bike_usage(late, "hour").collect()[0].dt == date(2024, 1, 2)
    assert bike_usage(late, "day").collect()[0].dt == date(2024, 1, 2)
    assert bike_minute(late).collect()[0].dt == date(2024, 1, 1)
    noon = silver(spark, bike(at="2024-01-01T12:00:00Z"))
    assert bike_usage(noon, "hour").collect()[0].dt == date(2024, 1, 1)
    assert bike_usage(noon, "day").collect()[0].dt == date(2024, 1, 2)


@pytest.mark.parametrize("counts, mean", [((0, 1), 1), ((2, 3), 3), ((1, 2, 2), 2), ((1, 1, 2), 1)])
def test_minute_counts_round_half_up(spark, counts, mean):
    row = bike_minute(silver(spark, *[bike(available=n) for n in counts])).collect()[0]
    assert row.bikes_available == mean
    assert dict(bike_minute(silver(spark)).dtypes)["bikes_available"] == "int"


def test_city_spelling_splits_a_station(spark):
    rows = bike_usage(silver(spark, bike(city="Boston"), bike(city="boston")), "day")
    assert rows_of(rows.select("station_id", "bike_city")) == [("S001", "Boston"), ("S001", "boston")]


def test_rows_without_a_time_are_in_no_window(spark):
    some = silver(spark, bike(), bike(at="garbage"), bike(at=None))
    for frame in (bike_usage(some, "hour"), bike_usage(some, "day"), bike_minute(some)):
        assert frame.count() == 1


def test_weather_measures_ignore_missing_readings(spark):
    frame = weather_silver(
        bronze(spark, [weather(temp=10.0, precip=0.5, humidity=50, wind=10.0, pressure=1000),
                       weather(temp=None, precip=1.5, humidity=60, wind=20.0, pressure=1010)])
    )
    for grain in ("hour", "day"):
        row = weather_summary(frame, grain).collect()[0]
        got = [row[f"{m}_{grain}"] for m in (
            "avg_temp_c", "sum_precip_mm", "avg_humidity", "avg_wind_kph", "avg_pressure_mb")]
        assert got == [10.0, 2.0, 55.0, 15.0, 1005.0]


@pytest.mark.parametrize("spec, build", [
    (S.GOLD_BIKE_HOURLY, lambda b, w: bike_usage(b, "hour")),
    (S.GOLD_BIKE_DAILY, lambda b, w: bike_usage(b, "day")),
    (S.GOLD_BIKE_MINUTE, lambda b, w: bike_minute(b)),
    (S.GOLD_WEATHER_HOURLY, lambda b, w: weather_summary(w, "hour")),
    (S.GOLD_WEATHER_DAILY, lambda b, w: weather_summary(w, "day")),
])
def test_schemas_are_the_declared_ones(spark, spec, build):
    frame = build(bike_silver(bronze(spark, [])), weather_silver(bronze(spark, [])))
    assert frame.dtypes == [(f.name, f.dataType.simpleString()) for f in spec.schema.fields]


def test_bad_arguments(spark):
    with pytest.raises(ValueError):
        bike_usage(silver(spark), "week")
    with pytest.raises(ValueError):
        window_agg(silver(spark), "1 hour", ["station_id"], {"n": F.count("*")}, dt_from="middle")


def test_one_shuffle_after_a_partial_aggregate(spark, tmp_path):
    silver(spark, bike()).write.parquet(str(tmp_path / "s"))
    stored = spark.read.schema(S.SILVER_BIKE.schema).parquet(str(tmp_path / "s"))
    plan = plan_of(bike_usage(stored, "hour"))
    assert plan.count("Exchange") == 1
    assert "partial_sum" in plan and "Python" not in plan
    assert "docks_available" not in plan.split("ReadSchema")[1]


def test_properties_over_all_events(spark, sf_dir):
    events = staging.read_events(spark, sf_dir)
    base = bike_silver(registry._bronze(staging.bike_envelope(events))).cache()
    off = F.abs(F.col("availability_rate") + F.col("utilization_rate") - 1)
    assert base.where(off > 1e-12).count() == 0
    total = base.agg(F.sum("bikes_occupied")).first()[0]
    for grain in ("hour", "day"):
        rolled = bike_usage(base, grain)
        assert rolled.agg(F.sum(f"bikes_occupied_{grain}")).first()[0] == total
        assert rolled.where("window_end <= window_start").count() == 0
    hours = bike_usage(base, "hour").select(
        "station_id", F.date_trunc("day", "window_start").alias("day"), "bikes_occupied_hour"
    )
    summed = hours.groupBy("station_id", "day").agg(F.sum("bikes_occupied_hour").alias("n"))
    days = bike_usage(base, "day").select(
        "station_id", F.col("window_start").alias("day"), F.col("bikes_occupied_day").alias("n")
    )
    assert summed.exceptAll(days).count() == 0 and days.exceptAll(summed).count() == 0
    minutes = bike_minute(base).select(
        "station_id", F.date_trunc("hour", "window_start").alias("h")).distinct()
    hour_keys = bike_usage(base, "hour").select("station_id", F.col("window_start").alias("h"))
    assert minutes.exceptAll(hour_keys).count() == 0 and minutes.count() == hour_keys.count()
    base.unpersist()
