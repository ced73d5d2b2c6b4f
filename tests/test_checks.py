"""Labels, quality rules, the station dimension, insight and retention."""

from __future__ import annotations

import re
from datetime import date

import pytest
from helpers import bike, bronze, plan_of, rows_of, weather

from rillstone import LakeLayout
from rillstone import schemas as S
from rillstone.functions import classify_condition
from rillstone.operators import (
    bike_silver,
    bike_usage,
    bike_violations,
    rain_usage_correlation,
    retained,
    station_dim,
    utilization_by_hour_of_day,
    violation_counts,
    weather_bike_hourly,
    weather_silver,
    weather_summary,
    weather_violations,
    with_station,
)
from rillstone.operators.quality import bike_rules
from rillstone.sources import read_table, write_table


@pytest.mark.parametrize("temp, precip, wind, humidity, label", [
    (10.0, 2.0, 50.0, 90, "Rain"),
    (10.0, 0.1, 50.0, 90, "Light rain"),
    (10.0, 0.0, 30.0, 90, "Windy"),
    (19.9, 0.0, 29.9, 85, "Cloudy"),
    (20.0, 0.0, 29.9, 85, "Clear"),
    (10.0, 0.0, 0.0, 84, "Clear"),
    (None, 5.0, 0.0, 84, None),
    (10.0, None, 50.0, 90, None),
    (10.0, 0.0, None, 90, None),
    (10.0, 0.0, 50.0, None, None),
])
def test_condition_label(spark, temp, precip, wind, humidity, label):
    row = spark.createDataFrame(
        [(temp, precip, wind, humidity)],
        "temp_c double, precip_mm double, wind_kph double, humidity int",
    )
    assert row.select(classify_condition().alias("c")).first().c == label


def test_bike_rules(spark):
    good = bike()
    events = [
        good, {**good, "bikes_available": 11}, {**good, "bikes_occupied": 5},
        {**good, "docks_available": 9}, {**good, "bikes_available": -1},
        {**good, "bikes_available": None},
    ]
    frame = bike_silver(bronze(spark, events))
    broken = [r.broken_rules for r in bike_violations(frame).collect()]
    assert broken == [
        "available_in_range,occupied_is_rest", "occupied_is_rest,free_docks_match",
        "free_docks_match", "available_in_range,occupied_is_rest",
    ]
    counts = violation_counts(frame, bike_rules()).first()
    assert counts.asDict() == {
        "n_rows": 6, "available_in_range": 2, "occupied_is_rest": 3, "free_docks_match": 2,
    }


def test_weather_rules(spark):
    events = [
        weather(), weather(precip=-0.1), weather(wind=-1.0), weather(humidity=24),
        weather(humidity=101), weather(temp=1.25), weather(condition="Fog"),
        weather(condition=None), weather(humidity=25), weather(humidity=100),
    ]
    broken = [
        r.broken_rules
        for r in weather_violations(weather_silver(bronze(spark, events))).collect()
    ]
    assert broken == [
        "precip_not_negative", "wind_not_negative", "humidity_in_range", "humidity_in_range",
        "one_decimal", "known_condition",
    ]


def test_station_dimension(spark):
    dim = station_dim(spark)
    assert dim.count() == 30 and dim.select("station_id").distinct().count() == 30
    first, last = dim.orderBy("station_id").collect()[0], dim.orderBy("station_id").collect()[29]
    assert tuple(first) == ("S001", "Boston", 28, 18.0, 14.0, 70, 1015)
    assert tuple(last) == ("S030", "Salem", 16, 17.6, 13.0, 72, 1015)
    assert dim.agg({"docks_total": "sum"}).first()[0] == 526


def test_lookup_keeps_unknown_stations(spark):
    frame = weather_silver(bronze(spark, [weather("S004", temp=18.5), weather("X")]))
    rows = {r.station_id: r for r in with_station(frame).collect()}
    assert rows["S004"].city == "Worcester" and rows["S004"].temp_delta == 2.5
    assert rows["X"].city is None and rows["X"].temp_delta is None


def test_lookup_never_overwrites_readings(spark):
    frame = with_station(bike_silver(bronze(spark, [bike(docks=10)])))
    assert frame.first().docks_total == 10
    assert frame.columns.count("docks_total") == 1


def test_only_the_fixed_dimension_is_broadcast_by_hint(spark):
    frame = weather_silver(bronze(spark, [weather()]))
    own = spark.createDataFrame([("S001", "Depot")], "station_id string, depot string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" in plan_of(with_station(frame))
        assert "SortMergeJoin" in plan_of(with_station(frame, own))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert with_station(frame, own).first().depot == "Depot"


def _hourly(spark):
    rain = weather_summary(weather_silver(bronze(spark, [
        weather(at="2024-01-01T10:00:00Z", precip=1.0),
        weather(at="2024-01-01T11:00:00Z", precip=2.0),
        weather(at="2024-01-01T12:00:00Z", precip=3.0),
        weather("S002", precip=9.0),
    ])), "hour")
    usage = bike_usage(bike_silver(bronze(spark, [
        bike(at="2024-01-01T10:30:00Z", available=9),
        bike(at="2024-01-01T11:30:00Z", available=8),
        bike(at="2024-01-01T12:30:00Z", available=7),
        bike(at="2024-01-01T13:30:00Z", available=1),
    ])), "hour")
    return rain, usage


def test_rain_against_usage(spark):
    joined = weather_bike_hourly(*_hourly(spark))
    assert rows_of(joined.select("sum_precip_mm_hour", "bikes_occupied_hour")) == [
        (1.0, 1), (2.0, 2), (3.0, 3),
    ]
    whole = rain_usage_correlation(joined).first()
    assert whole.rain_usage_corr == pytest.approx(1.0) and whole.n_hours == 3
    by = rain_usage_correlation(joined, ["station_id"]).collect()
    assert [r.station_id for r in by] == ["S001"]


def test_join_is_not_forced_to_broadcast(spark):
    rain, usage = _hourly(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(weather_bike_hourly(rain, usage))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_date_filter_on_one_side_prunes_both(spark, tmp_path):
    layout = LakeLayout(str(tmp_path))
    rain, usage = _hourly(spark)
    write_table(rain, layout, S.GOLD_WEATHER_HOURLY)
    write_table(usage, layout, S.GOLD_BIKE_HOURLY)
    joined = weather_bike_hourly(
        retained(read_table(spark, layout, S.GOLD_WEATHER_HOURLY), date(2024, 1, 20), 5),
        read_table(spark, layout, S.GOLD_BIKE_HOURLY),
    )
    scans = re.findall(r"PartitionFilters: \[[^\]]*", plan_of(joined))
    assert len(scans) >= 2 and all(">= 2024-01-15" in scan for scan in scans)
    assert joined.count() == 0


def test_utilization_by_hour_of_day(spark):
    frame = bike_silver(bronze(spark, [
        bike(at="2024-01-01T10:00:00Z", available=2), bike(at="2024-01-05T10:59:00Z", available=4),
        bike(at="2024-01-05T11:00:00Z", available=10),
    ]))
    got = rows_of(utilization_by_hour_of_day(frame))
    assert [(s, h, round(u, 9)) for s, h, u in got] == [("S001", 10, 0.7), ("S001", 11, 0.0)]


def test_retention_boundary(spark):
    days = [(date(2024, 1, d),) for d in (1, 2, 3, 31)]
    frame = spark.createDataFrame(days, "dt date")
    assert rows_of(retained(frame, date(2024, 2, 1))) == [(date(2024, 1, 2),), (date(2024, 1, 3),),
                                                          (date(2024, 1, 31),)]
    assert retained(frame, date(2024, 2, 1), 1).count() == 1
