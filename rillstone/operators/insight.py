"""Questions across tables: weather against usage, and the shape of a day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def weather_bike_hourly(weather_hourly: DataFrame, bike_hourly: DataFrame) -> DataFrame:
    """Hourly rain and usage of the same station and hour.

    Inner join of two summary tables on (station, hour): both sides are already reduced
    to a row per station, city and hour, so no key is hot. The hour fixes ``dt``, the
    partition date, in both tables; joining on it too changes no result and lets a date
    filter on one side skip partitions of the other. No broadcast is forced; the planner
    uses the sides' measured sizes.
    """
    rain = weather_hourly.select(
        "station_id", "window_start", "dt", "weather_city", "avg_temp_c_hour",
        "sum_precip_mm_hour",
    )
    usage = bike_hourly.select(
        "station_id", "window_start", "dt", "bike_city", "bikes_occupied_hour",
        "utilization_rate_avg_hour",
    )
    return rain.join(usage, ["station_id", "window_start", "dt"], "inner")


def weather_bike_stream(weather: DataFrame, bike: DataFrame, watermark: str) -> DataFrame:
    """``weather_bike_hourly`` of two silver streams, an hour's row once both sides' watermarks have passed it.

    Two windowed aggregates and their join are one chain of stateful operators: each aggregate sends an hour
    downstream when it closes, and the join keeps it until the slower stream's watermark has passed that hour
    too, which its equality on the window tells Spark. So the join's state holds the hours between the two
    streams and nothing older. After a restart Spark closes nothing until both sides have sent a row. Stations without readings on the other side in an hour have no row, as in batch.
    """
    rain = weather.withWatermark("event_time", watermark).groupBy(F.window("event_time", "1 hour"), "station_id", "weather_city").agg(
        F.avg("temp_c").alias("avg_temp_c_hour"), F.sum("precip_mm").alias("sum_precip_mm_hour")
    )
    usage = bike.withWatermark("event_time", watermark).groupBy(F.window("event_time", "1 hour"), "station_id", "bike_city").agg(
        F.sum("bikes_occupied").alias("bikes_occupied_hour"), F.avg("utilization_rate").alias("utilization_rate_avg_hour")
    )
    return rain.join(usage, ["window", "station_id"]).select(
        "station_id",
        F.col("window.start").alias("window_start"),
        F.to_date("window.end").alias("dt"),
        "weather_city",
        "avg_temp_c_hour",
        "sum_precip_mm_hour",
        "bike_city",
        "bikes_occupied_hour",
        "utilization_rate_avg_hour",
    )


def utilization_by_hour_of_day(silver: DataFrame) -> DataFrame:
    """Mean utilization per station for each hour of the (UTC) day."""
    return silver.groupBy("station_id", F.hour("event_time").alias("hr")).agg(
        F.avg("utilization_rate").alias("avg_utilization_rate")
    )


def rain_usage_correlation(joined: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Pearson correlation of hourly rain and hourly usage, overall or per group."""
    return joined.groupBy(*(by or [])).agg(
        F.corr("sum_precip_mm_hour", "bikes_occupied_hour").alias("rain_usage_corr"),
        F.count(F.lit(1)).alias("n_hours"),
    )
