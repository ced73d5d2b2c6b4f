"""The weather label."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The five labels and the thresholds that separate them.
CONDITIONS = ("Rain", "Light rain", "Windy", "Cloudy", "Clear")
RAIN_FROM_MM = 2.0
WINDY_FROM_KPH = 30
CLOUDY_FROM_HUMIDITY = 85
CLOUDY_BELOW_C = 20


def classify_condition(
    temp_c: Column | str = "temp_c",
    precip_mm: Column | str = "precip_mm",
    wind_kph: Column | str = "wind_kph",
    humidity: Column | str = "humidity",
) -> Column:
    """First matching label; null when any reading is missing."""
    temp, precip, wind, damp = (
        F.col(c) if isinstance(c, str) else c for c in (temp_c, precip_mm, wind_kph, humidity)
    )
    incomplete = temp.isNull() | precip.isNull() | wind.isNull() | damp.isNull()
    return (
        F.when(incomplete, F.lit(None).cast("string"))
        .when(precip >= RAIN_FROM_MM, "Rain")
        .when(precip > 0, "Light rain")
        .when(wind >= WINDY_FROM_KPH, "Windy")
        .when((damp >= CLOUDY_FROM_HUMIDITY) & (temp < CLOUDY_BELOW_C), "Cloudy")
        .otherwise("Clear")
    )
