from rillstone.operators.bronze import to_bronze
from rillstone.operators.gold import bike_minute, bike_usage, weather_summary
from rillstone.operators.insight import (
    rain_usage_correlation,
    utilization_by_hour_of_day,
    weather_bike_hourly,
    weather_bike_stream,
)
from rillstone.operators.offsets import offset_gaps, offset_repeats, without_repeats
from rillstone.operators.quality import bike_violations, violation_counts, weather_violations
from rillstone.operators.reconcile import missed_rows, window_gaps
from rillstone.operators.retention import retained
from rillstone.operators.silver import (
    bike_silver,
    parse_events,
    quarantined,
    weather_silver,
    with_rates,
)
from rillstone.operators.stations import station_dim, with_station
from rillstone.operators.views import (
    as_json_rows,
    read_view,
    recent_bike,
    recent_bike_hourly,
    recent_bike_minute,
    recent_weather,
    recent_weather_hourly,
)
from rillstone.operators.windows import window_agg

__all__ = [
    "as_json_rows",
    "bike_minute",
    "bike_silver",
    "bike_usage",
    "bike_violations",
    "missed_rows",
    "offset_gaps",
    "offset_repeats",
    "parse_events",
    "quarantined",
    "rain_usage_correlation",
    "read_view",
    "recent_bike",
    "recent_bike_hourly",
    "recent_bike_minute",
    "recent_weather",
    "recent_weather_hourly",
    "retained",
    "station_dim",
    "to_bronze",
    "utilization_by_hour_of_day",
    "violation_counts",
    "weather_bike_hourly",
    "weather_bike_stream",
    "weather_silver",
    "weather_summary",
    "weather_violations",
    "window_agg",
    "window_gaps",
    "with_rates",
    "with_station",
    "without_repeats",
]
