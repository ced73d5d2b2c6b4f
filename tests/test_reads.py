"""Client reads and stored tables."""

from __future__ import annotations

import json
from datetime import date

import pytest
from helpers import bike, bronze, plan_of, rows_of
from pyspark.sql import functions as F

from rillstone import LakeLayout, register_views
from rillstone import schemas as S
from rillstone.operators import (
    as_json_rows,
    bike_minute,
    bike_silver,
    bike_usage,
    read_view,
    recent_bike,
    recent_bike_hourly,
    recent_bike_minute,
    recent_weather,
    recent_weather_hourly,
    retained,
)
from rillstone.plans import registry
from rillstone.sources import ensure_table, read_table, staging, write_table


@pytest.fixture
def numbers(spark):
    return spark.createDataFrame(
        [("a", 2), ("b", None), ("c", 1), ("d", 3), ("e", 2)], "name string, n int"
    )


def test_nulls_are_last_both_ways(numbers):
    down = [r.name for r in read_view(numbers, order_by="n").collect()]
    up = [r.name for r in read_view(numbers, order_by="n", descending=False).collect()]
    assert down == ["d", "a", "e", "c", "b"]
    assert up == ["c", "a", "e", "d", "b"]


@pytest.mark.parametrize("limit, n", [(2, 2), (0, 5), (-1, 5), (None, 5), (99, 5)])
def test_limit(numbers, limit, n):
    assert read_view(numbers, order_by="n", limit=limit).count() == n


def test_filters(numbers):
    assert read_view(numbers, filters={"n": 2}).count() == 2
    assert read_view(numbers, filters={"n": 2, "name": "a"}).count() == 1
    assert read_view(numbers, filters={"n": None}).count() == 5
    empty = read_view(numbers, filters={"n": 77}, columns=["name"], order_by="n", limit=3)
    assert empty.collect() == [] and empty.columns == ["name"]


def test_unknown_names(numbers):
    for bad in ({"columns": ["x"]}, {"filters": {"x": 1}}, {"order_by": "x"}):
        with pytest.raises(ValueError):
            read_view(numbers, **bad)
    assert read_view(numbers, columns=["x", "n"], lenient=True).columns == ["n"]
    assert read_view(numbers, columns=["x"], lenient=True).columns == ["name", "n"]
    assert read_view(numbers, filters={"x": 1}, order_by="x", lenient=True).count() == 5


def test_order_column_need_not_be_shown(numbers):
    assert [r.name for r in read_view(numbers, ["name"], order_by="n", limit=2).collect()] == [
        "d", "a",
    ]


@pytest.mark.parametrize("view, most", [
    (recent_bike, 5000), (recent_weather, 5000), (recent_bike_minute, 10000),
    (recent_bike_hourly, 10000), (recent_weather_hourly, 10000),
])
def test_limit_range(numbers, view, most):
    for limit in (0, most + 1):
        with pytest.raises(ValueError):
            view(numbers.withColumn("window_start", F.lit(1)), limit=limit)


def test_minute_view_names_its_time(spark):
    frame = bike_minute(bike_silver(bronze(spark, [bike(), bike(at="2024-01-01T10:01:00Z")])))
    got = recent_bike_minute(frame, limit=1).collect()[0]
    assert got.minute.minute == 1


def test_top_rows_are_not_a_full_sort(numbers):
    assert "TakeOrderedAndProject" in plan_of(read_view(numbers, order_by="n", limit=3))


def test_json_rows(spark):
    frame = spark.sql(
        "SELECT timestamp'2024-01-01 00:00:00' AS t, date'2024-01-02' AS d, 1.5D AS x, "
        "CAST(NULL AS INT) AS n, CAST(NULL AS TIMESTAMP) AS none, 'é\"' AS s"
    )
    assert json.loads(as_json_rows(frame).first().json) == {
        "t": "2024-01-01 00:00:00", "d": "2024-01-02", "x": 1.5, "n": None, "none": None, "s": 'é"',
    }


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    layout = LakeLayout(str(tmp_path_factory.mktemp("lake")))
    days = [f"2024-01-{d:02d}T10:00:{s:02d}Z" for d in range(1, 6) for s in range(4)]
    events = [bike(f"S00{1 + n % 2}", at) for n, at in enumerate(days)] + [
        bike("S001", "garbage"), bike("007", "2024-01-03T00:00:00Z"),
    ]
    write_table(bike_silver(bronze(spark, events)), layout, S.SILVER_BIKE)
    return layout


def test_table_round_trip(spark, lake):
    table = read_table(spark, lake, S.SILVER_BIKE)
    assert table.schema.names == S.SILVER_BIKE.schema.names
    assert table.count() == 22
    assert table.where("station_id = '007'").count() == 1
    assert table.where("dt IS NULL").count() == 1


def test_station_filter_prunes_partitions_and_columns(spark, lake):
    plan = plan_of(recent_bike(read_table(spark, lake, S.SILVER_BIKE), "S001", 3))
    assert "TakeOrderedAndProject" in plan
    assert "PartitionFilters: [isnotnull(station_id" in plan
    assert "availability_rate" not in plan.split("ReadSchema")[1]


def test_retention_prunes_partitions(spark, lake):
    kept = retained(read_table(spark, lake, S.SILVER_BIKE), date(2024, 1, 5), 2)
    assert "PartitionFilters: [isnotnull(dt" in plan_of(kept)
    assert kept.count() == 13


@pytest.mark.parametrize("station", [None, "S001", "S404"])
@pytest.mark.parametrize("limit", [1, 4, 5, 11, 21, 22, 500])
def test_newest_partitions_give_the_same_rows(spark, lake, station, limit):
    table = read_table(spark, lake, S.SILVER_BIKE)
    pruned = recent_bike(table, station, limit, newest_partitions="dt")
    assert pruned.collect() == recent_bike(table, station, limit).collect()


@pytest.mark.parametrize("limit", [1, 2, 3, 4, 7, 8, 9, 200])
def test_newest_partitions_of_hours_around_midnight(hours, limit):
    pruned = recent_bike_hourly(hours, limit=limit, newest_partitions="dt")
    assert pruned.collect() == recent_bike_hourly(hours, limit=limit).collect()


@pytest.fixture(scope="module")
def hours(spark, tmp_path_factory):
    """The last hour of a day lies in the next day's partition."""
    layout = LakeLayout(str(tmp_path_factory.mktemp("hours")))
    moments = [f"2024-01-0{d}T{h}:15:00Z" for d in (1, 2) for h in ("00", "22", "23")]
    events = [bike(s, at) for at in moments for s in ("S001", "S002")]
    write_table(
        bike_usage(bike_silver(bronze(spark, events)), "hour"), layout, S.GOLD_BIKE_HOURLY
    )
    return read_table(spark, layout, S.GOLD_BIKE_HOURLY)


def test_newest_partitions_are_chosen_in_the_scan(spark, lake):
    """Without any option: a literal date reaches the scan of a stored table."""
    pruned = recent_bike(read_table(spark, lake, S.SILVER_BIKE), limit=4)
    plan = plan_of(pruned)
    assert "PartitionFilters: [isnotnull(dt" in plan and ">= 20" in plan
    assert "ReadSchema: struct<>" not in plan


def test_hot_station_is_written_by_many_tasks(spark, tmp_path):
    """A station with most rows is split before the write; no row is lost."""
    hot = spark.range(60_000).select(
        F.when(F.col("id") % 3 > 0, "S001").otherwise(
            F.format_string("S%03d", F.col("id") % 29 + 2)).alias("station_id"),
        F.sha2(F.col("id").cast("string"), 256).alias("bike_city"),
        F.lit(10).alias("docks_total"), F.lit(1).alias("bikes_available"),
        F.lit(9).alias("bikes_occupied"), F.lit(1).alias("docks_available"),
        F.lit("2024-01-01 10:00:00").cast("timestamp").alias("event_time"),
        F.lit("2024-01-01").cast("date").alias("dt"),
        F.lit(0.1).alias("availability_rate"), F.lit(0.9).alias("utilization_rate"),
    ).repartition(8)
    layout = LakeLayout(str(tmp_path))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    try:
        write_table(hot, layout, S.SILVER_BIKE)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256m")
    table = read_table(spark, layout, S.SILVER_BIKE)
    files = table.where("station_id = 'S001'").select(F.input_file_name()).distinct().count()
    assert files >= 4
    assert table.count() == 60_000


def test_views_for_sql(spark, lake):
    assert register_views(spark, lake, (S.SILVER_BIKE,)) == ["silver_bike_events"]
    by_hour = spark.sql(
        "SELECT station_id, hour(event_time) AS hr, avg(utilization_rate) AS u "
        "FROM silver_bike_events WHERE event_time IS NOT NULL GROUP BY station_id, hr"
    )
    assert by_hour.count() == 3


def test_empty_table(spark, tmp_path):
    layout = LakeLayout(str(tmp_path))
    ensure_table(spark, layout, S.GOLD_BIKE_HOURLY)
    ensure_table(spark, layout, S.GOLD_BIKE_HOURLY)
    table = read_table(spark, layout, S.GOLD_BIKE_HOURLY)
    assert recent_bike_hourly(table).collect() == []
    assert rows_of(as_json_rows(recent_bike_hourly(table))) == []


def test_minute_table_spreads_a_day_over_writers(spark, sf_dir, tmp_path):
    events = staging.read_events(spark, sf_dir)
    minutes = bike_minute(bike_silver(registry._bronze(staging.bike_envelope(events))))
    layout = LakeLayout(str(tmp_path))
    write_table(minutes, layout, S.GOLD_BIKE_MINUTE)
    assert read_table(spark, layout, S.GOLD_BIKE_MINUTE).count() == minutes.count()
