from __future__ import annotations

from datetime import date

import pytest
from helpers import bike, bronze, plan_of, rows_of, utc, weather
from pyspark.sql import functions as F

from rillstone import schemas as S
from rillstone.operators import bike_silver, parse_events, quarantined, to_bronze, weather_silver

TRUNCATED = '{"station_id":"S001","docks_total":1'
ODD_TEXTS = [
    None, "", "  ", "\t\r\n", "\x0b", "\x0c", " ", "not json", "[1,2]", "{}", "null", "12",
    '"text"', TRUNCATED, '{"station_id":"S001","docks_total":"x"}',
    '{"station_id":"S001","docks_total":1.5}', '{"bike_city":"Boston"}',
    '{"station_id":null}', '[{"station_id":"S001"}]',
]


def test_bronze_keeps_message_and_metadata(spark):
    row = bronze(spark, [bike()]).collect()[0]
    assert row.key == "S001" and '"docks_total": 10' in row.value
    assert (row.topic, row.partition, row.offset) == ("bike", 0, 0)
    assert row.kafka_timestamp.isoformat() == "2024-01-01T12:00:00"
    assert row.dt == date(2024, 2, 1)
    assert bronze(spark, []).columns == S.BRONZE_BIKE.schema.names


def test_bronze_clock_is_the_default(spark):
    from helpers import envelope

    frame = to_bronze(envelope(spark, [bike()]))
    assert frame.where(F.col("dt") == F.to_date("ingest_time")).count() == 1
    assert "timestamp" in dict(frame.dtypes)["ingest_time"]


def test_silver_columns_and_types(spark):
    assert bike_silver(bronze(spark, [])).dtypes == [
        (f.name, f.dataType.simpleString()) for f in S.SILVER_BIKE.schema.fields
    ]
    assert weather_silver(bronze(spark, [])).dtypes == [
        (f.name, f.dataType.simpleString()) for f in S.SILVER_WEATHER.schema.fields
    ]


def test_good_rows_survive_every_mode(spark):
    source = bronze(spark, [bike(), bike("S002", available=0), bike(extra=1)])
    for mode in ("drop", "keep"):
        assert bike_silver(source, mode).count() == 3
    assert quarantined(source, S.BIKE_EVENT).count() == 0


def test_keep_is_exactly_a_non_null_struct(spark):
    source = bronze(spark, ODD_TEXTS)
    kept = parse_events(source, S.BIKE_EVENT, "keep")
    plain = source.select(F.from_json("value", S.BIKE_EVENT).alias("j")).where("j is not null")
    assert kept.count() == plain.count()
    # Null, empty and blank texts hold no record; everything else gives a row.
    assert kept.count() == len(ODD_TEXTS) - 4


def test_keep_nulls_only_the_unreadable_field(spark):
    row = bike_silver(
        bronze(spark, ['{"station_id":"S009","docks_total":"x","bikes_available":3}']), "keep"
    ).collect()[0]
    assert (row.station_id, row.docks_total, row.bikes_available) == ("S009", None, 3)
    assert row.availability_rate is None


def test_drop_and_quarantine_split_bronze(spark):
    source = bronze(spark, [*ODD_TEXTS, bike(), bike("S002")])
    kept = bike_silver(source, "drop")
    refused = quarantined(source, S.BIKE_EVENT)
    assert rows_of(kept.select("station_id")) == [("S001",), ("S002",)]
    assert rows_of(refused.select("value")) == sorted([(t,) for t in ODD_TEXTS], key=repr)
    assert refused.columns == S.QUARANTINE_BIKE.schema.names


def test_unknown_mode_is_an_error(spark):
    with pytest.raises(ValueError):
        parse_events(bronze(spark, []), S.BIKE_EVENT, "ignore")


def test_bad_time_keeps_the_row_without_a_date(spark):
    source = bronze(spark, [bike(at="garbage"), bike(at=None), bike(at="2024-01-01T10:00:00Z")])
    rows = bike_silver(source).select("event_time", "dt").collect()
    assert sum(r.event_time is None and r.dt is None for r in rows) == 2
    assert [r.dt for r in rows if r.dt] == [date(2024, 1, 1)]


def test_times_are_utc(spark):
    rows = bike_silver(
        bronze(spark, [bike(at="2024-01-01T23:59:59Z"), bike(at="2024-01-02T01:00:00+02:00")])
    )
    assert rows_of(rows.select(F.unix_timestamp("event_time"), "dt")) == [
        (int(utc("2024-01-01 23:00:00").timestamp()), date(2024, 1, 1)),
        (int(utc("2024-01-01 23:59:59").timestamp()), date(2024, 1, 1)),
    ]


def test_rates(spark):
    cases = [bike(available=4, docks=10), bike(available=0, docks=0), bike(available=3, docks=None),
             bike(available=1, docks=-2), bike(available=None, docks=10)]
    got = [
        (r.availability_rate, r.utilization_rate)
        for r in bike_silver(bronze(spark, cases)).collect()
    ]
    assert got == [(0.4, 0.6), (None, None), (None, None), (None, None), (None, None)]


def test_weather_payload(spark):
    row = weather_silver(bronze(spark, [weather(temp=18.3, precip=0.4)], "weather")).collect()[0]
    assert (row.temp_c, row.precip_mm, row.humidity, row.condition) == (18.3, 0.4, 60, "Clear")


def test_numeric_station_stays_text(spark):
    assert bike_silver(bronze(spark, [bike("007")])).collect()[0].station_id == "007"


@pytest.mark.parametrize("mode", ["drop", "keep"])
def test_text_is_parsed_once(spark, tmp_path, mode):
    bronze(spark, [bike()]).write.parquet(str(tmp_path / "b"))
    stored = spark.read.schema(S.BRONZE_BIKE.schema).parquet(str(tmp_path / "b"))
    plan = plan_of(bike_silver(stored, mode))
    assert plan.count("from_json") == 1
    assert "ReadSchema: struct<value:string>" in plan
    assert plan_of(quarantined(stored, S.BIKE_EVENT)).count("from_json") == 1
