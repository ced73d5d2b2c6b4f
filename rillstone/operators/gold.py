"""The five summary tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillstone.functions import whole_mean
from rillstone.operators.windows import window_agg

WATERMARK = "15 minutes"

_GRAINS = {"hour": "1 hour", "day": "1 day"}


def _size(grain: str) -> str:
    if grain not in _GRAINS:
        raise ValueError(f"grain must be one of {sorted(_GRAINS)}, not {grain!r}")
    return _GRAINS[grain]


def bike_usage(silver: DataFrame, grain: str, watermark: str | None = None, audited: bool = False) -> DataFrame:
    """Bike usage per station and city by ``"hour"`` or ``"day"``."""
    return window_agg(
        silver,
        _size(grain),
        ["station_id", "bike_city"],
        {
            f"bikes_occupied_{grain}": F.sum("bikes_occupied"),
            f"bikes_available_avg_{grain}": F.avg("bikes_available"),
            f"availability_rate_avg_{grain}": F.avg("availability_rate"),
            f"utilization_rate_avg_{grain}": F.avg("utilization_rate"),
            "docks_total": F.max("docks_total"),
        },
        watermark=watermark,
        audited=audited,
    )


def weather_summary(silver: DataFrame, grain: str, watermark: str | None = None, audited: bool = False) -> DataFrame:
    """Weather per station and city by ``"hour"`` or ``"day"``."""
    return window_agg(
        silver,
        _size(grain),
        ["station_id", "weather_city"],
        {
            f"avg_temp_c_{grain}": F.avg("temp_c"),
            f"sum_precip_mm_{grain}": F.sum("precip_mm"),
            f"avg_humidity_{grain}": F.avg("humidity"),
            f"avg_wind_kph_{grain}": F.avg("wind_kph"),
            f"avg_pressure_mb_{grain}": F.avg("pressure_mb"),
        },
        watermark=watermark,
        audited=audited,
    )


def bike_minute(silver: DataFrame, watermark: str | None = None, audited: bool = False) -> DataFrame:
    """Typical whole-bike counts per station and city by minute."""
    return window_agg(
        silver,
        "1 minute",
        ["station_id", "bike_city"],
        {
            "bikes_available": whole_mean("bikes_available"),
            "bikes_occupied": whole_mean("bikes_occupied"),
            "docks_total": F.max("docks_total"),
        },
        dt_from="start",
        watermark=watermark,
        audited=audited,
    )
