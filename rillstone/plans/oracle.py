"""The same results in SQL, computed straight from ``events`` without any messages."""

from __future__ import annotations

from rillstone.operators.stations import STATIONS

_BIKE = """
    bike AS (
        SELECT event_id, ts, m,
               'S' || lpad((m + 1)::VARCHAR, 3, '0') AS station_id,
               'City' || (m + 1)::VARCHAR AS bike_city,
               docks_total,
               (k % (docks_total + 1))::INT AS bikes_available,
               (docks_total - k % (docks_total + 1))::INT AS bikes_occupied,
               (k % (docks_total + 1))::INT AS docks_available,
               date_trunc('second', ts)::TIMESTAMP AS event_time,
               ts::DATE AS dt
        FROM (SELECT event_id, ts, user_id % 30 AS m, (props->>'k')::INT AS k,
                     (12 + (user_id % 30) % 17)::INT AS docks_total
              FROM events)
    )"""

_WEATHER = """
    weather AS (
        SELECT *, CASE WHEN precip_mm >= 2.0 THEN 'Rain'
                       WHEN precip_mm > 0 THEN 'Light rain'
                       WHEN wind_kph >= 30 THEN 'Windy'
                       WHEN humidity >= 85 AND temp_c < 20 THEN 'Cloudy'
                       ELSE 'Clear' END AS condition
        FROM (SELECT event_id, ts, m,
                     'S' || lpad((m + 1)::VARCHAR, 3, '0') AS station_id,
                     'City' || (m + 1)::VARCHAR AS weather_city,
                     (c % 400) / 10.0::DOUBLE AS temp_c,
                     CASE WHEN c % 20 < 13 THEN 0.0::DOUBLE
                          ELSE (c % 40) / 10.0::DOUBLE END AS precip_mm,
                     (25 + c % 76)::INT AS humidity,
                     (c % 450) / 10.0::DOUBLE AS wind_kph,
                     (1000 + c % 30)::INT AS pressure_mb,
                     date_trunc('second', ts)::TIMESTAMP AS event_time,
                     ts::DATE AS dt
              FROM (SELECT event_id, ts, user_id % 30 AS m, round(value * 100)::BIGINT AS c
                    FROM events))
    )"""

_BIKE_COLUMNS = """station_id, bike_city, docks_total, bikes_available, bikes_occupied,
    docks_available, event_time, dt"""

_BIKE_RATES = """
    CASE WHEN docks_total > 0 THEN bikes_available / docks_total::DOUBLE END AS availability_rate,
    CASE WHEN docks_total > 0 THEN bikes_occupied / docks_total::DOUBLE END AS utilization_rate"""

_WEATHER_COLUMNS = """station_id, weather_city, temp_c, precip_mm, humidity, wind_kph,
    pressure_mb, condition, event_time, dt"""

# Fixed ingest time and the date it falls on.
_TAKEN_IN = "TIMESTAMP '2024-02-01 00:00:00' AS ingest_time, DATE '2024-02-01' AS dt"


def _bronze(topic: str, cte: str, payload: str) -> str:
    return f"""
    WITH {cte}
    SELECT station_id AS key, to_json(struct_pack({payload}))::VARCHAR AS value,
           '{topic}' AS topic, (m % 3)::INT AS partition, event_id AS "offset",
           ts::TIMESTAMP AS kafka_timestamp, 0::INT AS kafka_timestamp_type, {_TAKEN_IN}
    FROM {topic}"""


_BRONZE_BIKE = _bronze(
    "bike",
    _BIKE,
    """station_id := station_id, bike_city := bike_city, docks_total := docks_total,
       bikes_available := bikes_available, bikes_occupied := bikes_occupied,
       docks_available := docks_available,
       event_time := strftime(event_time, '%Y-%m-%dT%H:%M:%SZ')""",
)
_BRONZE_WEATHER = _bronze(
    "weather",
    _WEATHER,
    """station_id := station_id, weather_city := weather_city, temp_c := temp_c,
       precip_mm := precip_mm, humidity := humidity, wind_kph := wind_kph,
       pressure_mb := pressure_mb, condition := condition,
       event_time := strftime(event_time, '%Y-%m-%dT%H:%M:%SZ')""",
)
_SILVER_BIKE = f"WITH {_BIKE} SELECT {_BIKE_COLUMNS}, {_BIKE_RATES} FROM bike"
_SILVER_WEATHER = f"WITH {_WEATHER} SELECT {_WEATHER_COLUMNS} FROM weather"

# The malformed variant: message n = 7j has lost its text to kind j modulo 7. Kind 4 is the
# empty text; kind 6 names its station and has an unreadable dock count.
_KIND = "CASE WHEN event_id % 7 = 0 THEN (event_id // 7) % 7 ELSE -1 END"
_MALFORMED_KEEP = f"""
    WITH {_BIKE}, kinds AS (SELECT *, {_KIND} AS kind FROM bike),
    read AS (
        SELECT CASE WHEN kind = -1 THEN station_id WHEN kind = 6 THEN 'S001' END AS station_id,
               CASE WHEN kind = -1 THEN bike_city END AS bike_city,
               CASE WHEN kind = -1 THEN docks_total END AS docks_total,
               CASE WHEN kind = -1 THEN bikes_available END AS bikes_available,
               CASE WHEN kind = -1 THEN bikes_occupied END AS bikes_occupied,
               CASE WHEN kind = -1 THEN docks_available END AS docks_available,
               CASE WHEN kind = -1 THEN event_time END AS event_time,
               CASE WHEN kind = -1 THEN dt END AS dt
        FROM kinds WHERE kind <> 4)
    SELECT *, {_BIKE_RATES} FROM read"""
_MALFORMED_DROP = f"""
    WITH {_BIKE} SELECT {_BIKE_COLUMNS}, {_BIKE_RATES} FROM bike WHERE event_id % 7 <> 0"""
_MALFORMED_QUARANTINE = f"""
    WITH {_BIKE}
    SELECT station_id AS key,
           CASE (event_id // 7) % 7
                WHEN 0 THEN 'not json' WHEN 1 THEN '[1,2]' WHEN 2 THEN '{{}}'
                WHEN 3 THEN 'null' WHEN 4 THEN ''
                WHEN 5 THEN '{{"station_id":"S001","docks_total":'
                ELSE '{{"station_id":"S001","docks_total":"x"}}' END AS value,
           'bike' AS topic, (m % 3)::INT AS partition, event_id AS "offset",
           ts::TIMESTAMP AS kafka_timestamp, 0::INT AS kafka_timestamp_type, {_TAKEN_IN}
    FROM bike WHERE event_id % 7 = 0"""

_CLOSED = "window_end <= (SELECT max(event_time) - INTERVAL 15 MINUTE FROM {0})"


def _bike_usage(grain: str, closed_only: bool = False) -> str:
    kept = f"WHERE {_CLOSED.format('bike')}" if closed_only else ""
    return f"""
    WITH {_BIKE}, usage AS (
        SELECT station_id, bike_city,
               date_trunc('{grain}', event_time)::TIMESTAMP AS window_start,
               (date_trunc('{grain}', event_time) + INTERVAL 1 {grain})::TIMESTAMP AS window_end,
               sum(bikes_occupied)::BIGINT AS bikes_occupied_{grain},
               round(avg(bikes_available), 9) AS bikes_available_avg_{grain},
               round(avg(bikes_available / docks_total::DOUBLE), 9)
                   AS availability_rate_avg_{grain},
               round(avg(bikes_occupied / docks_total::DOUBLE), 9)
                   AS utilization_rate_avg_{grain},
               max(docks_total) AS docks_total
        FROM bike GROUP BY ALL)
    SELECT *, window_end::DATE AS dt FROM usage {kept}"""


def _weather_summary(grain: str, closed_only: bool = False) -> str:
    kept = f"WHERE {_CLOSED.format('weather')}" if closed_only else ""
    return f"""
    WITH {_WEATHER}, summary AS (
        SELECT station_id, weather_city,
               date_trunc('{grain}', event_time)::TIMESTAMP AS window_start,
               (date_trunc('{grain}', event_time) + INTERVAL 1 {grain})::TIMESTAMP AS window_end,
               round(avg(temp_c), 9) AS avg_temp_c_{grain},
               round(sum(precip_mm), 9) AS sum_precip_mm_{grain},
               round(avg(humidity), 9) AS avg_humidity_{grain},
               round(avg(wind_kph), 9) AS avg_wind_kph_{grain},
               round(avg(pressure_mb), 9) AS avg_pressure_mb_{grain}
        FROM weather GROUP BY ALL)
    SELECT *, window_end::DATE AS dt FROM summary {kept}"""


def _bike_minute(closed_only: bool = False) -> str:
    kept = f"WHERE {_CLOSED.format('bike')}" if closed_only else ""
    return f"""
    WITH {_BIKE}, minutes AS (
        SELECT station_id, bike_city,
               date_trunc('minute', event_time)::TIMESTAMP AS window_start,
               (date_trunc('minute', event_time) + INTERVAL 1 MINUTE)::TIMESTAMP AS window_end,
               round(avg(bikes_available))::INT AS bikes_available,
               round(avg(bikes_occupied))::INT AS bikes_occupied,
               max(docks_total) AS docks_total
        FROM bike GROUP BY ALL)
    SELECT *, window_start::DATE AS dt FROM minutes {kept}"""


_JOINED = f"""
    WITH rain AS ({_weather_summary("hour")}), usage AS ({_bike_usage("hour")}),
    joined AS (
        SELECT station_id, window_start, rain.dt, weather_city, avg_temp_c_hour,
               sum_precip_mm_hour, bike_city, bikes_occupied_hour, utilization_rate_avg_hour
        FROM rain JOIN usage USING (station_id, window_start))"""

_STATION_ROWS = ", ".join(
    f"('{sid}', '{city}', {docks}, {temp}::DOUBLE, {wind}::DOUBLE, {damp}, {mb})"
    for sid, city, docks, temp, wind, damp, mb in STATIONS
)
_STATION_ENRICHED = f"""
    WITH {_WEATHER}, dim(station_id, city, docks_total, base_temp_c, base_wind_kph,
                         base_humidity, base_pressure_mb) AS (VALUES {_STATION_ROWS})
    SELECT {_WEATHER_COLUMNS}, city, docks_total, base_temp_c, base_wind_kph, base_humidity,
           base_pressure_mb, round(temp_c - base_temp_c, 9) AS temp_delta
    FROM weather LEFT JOIN dim USING (station_id)"""

_FAULTY_BIKE = f"""{_BIKE}, faulty AS (
        SELECT * REPLACE (
            CASE WHEN event_id % 11 = 3 THEN docks_total + bikes_available + 1
                 ELSE bikes_available END AS bikes_available,
            CASE WHEN event_id % 13 = 5 THEN bikes_occupied - 1
                 ELSE bikes_occupied END AS bikes_occupied)
        FROM bike),
    checked AS (
        SELECT *,
            NOT (bikes_available >= 0 AND bikes_available <= docks_total) AS r1,
            bikes_occupied <> docks_total - bikes_available AS r2,
            docks_available <> docks_total - bikes_occupied AS r3
        FROM faulty)"""
_FAULTY_WEATHER = f"""{_WEATHER}, faulty AS (
        SELECT * REPLACE (
            CASE WHEN event_id % 11 = 3 THEN humidity + 80 ELSE humidity END AS humidity,
            CASE WHEN event_id % 13 = 5 THEN -1.5::DOUBLE ELSE wind_kph END AS wind_kph,
            CASE WHEN event_id % 29 = 7 THEN -0.5::DOUBLE ELSE precip_mm END AS precip_mm,
            CASE WHEN event_id % 17 = 2 THEN 20.25::DOUBLE ELSE temp_c END AS temp_c,
            CASE WHEN event_id % 19 = 4 THEN 'Fog' ELSE condition END AS condition)
        FROM weather),
    checked AS (
        SELECT *,
            precip_mm < 0 AS r1, wind_kph < 0 AS r2, humidity NOT BETWEEN 25 AND 100 AS r3,
            round(temp_c, 1) <> temp_c OR round(precip_mm, 1) <> precip_mm
                OR round(wind_kph, 1) <> wind_kph AS r4,
            condition NOT IN ('Rain', 'Light rain', 'Windy', 'Cloudy', 'Clear') AS r5
        FROM faulty)"""
_BIKE_VIOLATIONS = f"""
    WITH {_FAULTY_BIKE}
    SELECT {_BIKE_COLUMNS}, {_BIKE_RATES},
           concat_ws(',', CASE WHEN r1 THEN 'available_in_range' END,
                          CASE WHEN r2 THEN 'occupied_is_rest' END,
                          CASE WHEN r3 THEN 'free_docks_match' END) AS broken_rules
    FROM checked WHERE r1 OR r2 OR r3"""
_WEATHER_VIOLATIONS = f"""
    WITH {_FAULTY_WEATHER}
    SELECT {_WEATHER_COLUMNS},
           concat_ws(',', CASE WHEN r1 THEN 'precip_not_negative' END,
                          CASE WHEN r2 THEN 'wind_not_negative' END,
                          CASE WHEN r3 THEN 'humidity_in_range' END,
                          CASE WHEN r4 THEN 'one_decimal' END,
                          CASE WHEN r5 THEN 'known_condition' END) AS broken_rules
    FROM checked WHERE r1 OR r2 OR r3 OR r4 OR r5"""
_BIKE_COUNTS = f"""
    WITH {_FAULTY_BIKE}
    SELECT station_id, count(*) AS n_rows,
           count(*) FILTER (r1) AS available_in_range,
           count(*) FILTER (r2) AS occupied_is_rest,
           count(*) FILTER (r3) AS free_docks_match
    FROM checked GROUP BY station_id"""
_WEATHER_COUNTS = f"""
    WITH {_FAULTY_WEATHER}
    SELECT station_id, count(*) AS n_rows,
           CAST(0 AS BIGINT) AS finite,
           count(*) FILTER (r1) AS precip_not_negative,
           count(*) FILTER (r2) AS wind_not_negative,
           count(*) FILTER (r3) AS humidity_in_range,
           count(*) FILTER (r4) AS one_decimal,
           count(*) FILTER (r5) AS known_condition
    FROM checked GROUP BY station_id"""


def _recent(table_sql: str, shown: list[str], first: str, limit: int, where: str = "") -> str:
    ties = ", ".join(f"{c} ASC NULLS LAST" for c in shown if c != first)
    return f"""
    SELECT {", ".join(shown)} FROM ({table_sql}) {where}
    ORDER BY {first} DESC NULLS LAST, {ties} LIMIT {limit}"""


_RECENT_BIKE = [
    "event_time", "dt", "station_id", "bike_city", "docks_total", "docks_available",
    "bikes_available", "bikes_occupied",
]
_RECENT_WEATHER = [
    "event_time", "dt", "station_id", "weather_city", "temp_c", "precip_mm", "humidity",
    "wind_kph", "pressure_mb", "condition",
]
_RECENT_MINUTE = [
    "minute", "station_id", "bike_city", "bikes_available", "bikes_occupied", "docks_total", "dt",
]
_RECENT_BIKE_HOURLY = [
    "window_start", "window_end", "dt", "station_id", "bike_city", "bikes_occupied_hour",
    "bikes_available_avg_hour", "availability_rate_avg_hour", "utilization_rate_avg_hour",
    "docks_total",
]
_RECENT_WEATHER_HOURLY = [
    "window_start", "window_end", "dt", "station_id", "weather_city", "avg_temp_c_hour",
    "sum_precip_mm_hour", "avg_humidity_hour", "avg_wind_kph_hour", "avg_pressure_mb_hour",
]

_MALFORMED_WEATHER_DROP = f"""
    WITH {_WEATHER}, kinds AS (SELECT *, {_KIND} AS kind FROM weather)
    SELECT {_WEATHER_COLUMNS} FROM kinds WHERE kind = -1
    UNION ALL
    SELECT 'S001', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM kinds WHERE kind = 6"""
_MALFORMED_WEATHER_QUARANTINE = (
    _MALFORMED_QUARANTINE.replace(_BIKE, _WEATHER)
    .replace("'bike' AS topic", "'weather' AS topic")
    .replace("FROM bike WHERE event_id % 7 = 0", "FROM weather WHERE event_id % 7 = 0 AND (event_id // 7) % 7 <> 6")
)
# Names the rules by what breaks them: NaN is greater than all numbers and equal to itself.
_NONFINITE_COUNTS = f"""
    WITH {_WEATHER}, faulty AS (
        SELECT *, event_id % 7 = 3 OR event_id % 5 = 1 AS odd FROM weather)
    SELECT station_id, count(*) AS n_rows, count(*) FILTER (odd) AS finite,
           CAST(0 AS BIGINT) AS precip_not_negative, CAST(0 AS BIGINT) AS wind_not_negative,
           CAST(0 AS BIGINT) AS humidity_in_range, CAST(0 AS BIGINT) AS one_decimal,
           CAST(0 AS BIGINT) AS known_condition
    FROM faulty GROUP BY station_id"""


def _json(rows: str, columns: list[str]) -> str:
    times = {"event_time": "%Y-%m-%d %H:%M:%S", "minute": "%Y-%m-%d %H:%M:%S", "dt": "%Y-%m-%d"}
    times |= {"window_start": times["minute"], "window_end": times["minute"]}
    fields = ", ".join(
        f"{c} := strftime({c}, '{times[c]}')" if c in times else f"{c} := {c}" for c in columns
    )
    return f"SELECT to_json(struct_pack({fields}))::VARCHAR AS json FROM ({rows})"


ORACLE: dict[str, str] = {
    "bronze_bike": _BRONZE_BIKE,
    "bronze_weather": _BRONZE_WEATHER,
    "silver_bike": _SILVER_BIKE,
    "silver_weather": _SILVER_WEATHER,
    "malformed_keep": _MALFORMED_KEEP,
    "malformed_drop": _MALFORMED_DROP,
    "malformed_quarantine": _MALFORMED_QUARANTINE,
    "bike_hourly": _bike_usage("hour"),
    "bike_daily": _bike_usage("day"),
    "bike_minute": _bike_minute(),
    "weather_hourly": _weather_summary("hour"),
    "weather_daily": _weather_summary("day"),
    "utilization_by_hour_of_day": f"""
    WITH {_BIKE}
    SELECT station_id, extract(hour FROM event_time)::INT AS hr,
           round(avg(bikes_occupied / docks_total::DOUBLE), 9) AS avg_utilization_rate
    FROM bike GROUP BY ALL""",
    "weather_bike_hourly": f"{_JOINED} SELECT * FROM joined",
    "rain_usage_correlation": f"""{_JOINED}
    SELECT round(corr(sum_precip_mm_hour, bikes_occupied_hour), 9) AS rain_usage_corr,
           count(*) AS n_hours FROM joined""",
    "rain_usage_correlation_by_station": f"""{_JOINED}
    SELECT station_id, round(corr(sum_precip_mm_hour, bikes_occupied_hour), 9) AS rain_usage_corr,
           count(*) AS n_hours FROM joined GROUP BY station_id""",
    "station_enriched": _STATION_ENRICHED,
    "retained": f"SELECT * FROM ({_SILVER_BIKE}) WHERE dt >= DATE '2024-02-05' - 20",
    "condition_labels": f"""
    WITH {_WEATHER}
    SELECT event_id AS "offset", CASE WHEN event_id % 23 <> 0 THEN temp_c END AS temp_c,
           precip_mm, wind_kph, humidity,
           CASE WHEN event_id % 23 <> 0 THEN condition END AS label
    FROM weather""",
    "bike_violations": _BIKE_VIOLATIONS,
    "weather_violations": _WEATHER_VIOLATIONS,
    "bike_violation_counts": _BIKE_COUNTS,
    "weather_violation_counts": _WEATHER_COUNTS,
    "recent_bike": _recent(_SILVER_BIKE, _RECENT_BIKE, "event_time", 100),
    "recent_bike_one_station": _recent(
        _SILVER_BIKE, _RECENT_BIKE, "event_time", 25, "WHERE station_id = 'S007'"
    ),
    "recent_weather": _recent(_SILVER_WEATHER, _RECENT_WEATHER, "event_time", 100),
    "recent_bike_minute": _recent(
        f"SELECT *, window_start AS minute FROM ({_bike_minute()})", _RECENT_MINUTE, "minute", 200
    ),
    "recent_bike_hourly": _recent(
        _bike_usage("hour"), _RECENT_BIKE_HOURLY, "window_start", 200
    ),
    "recent_weather_hourly": _recent(
        _weather_summary("hour"), _RECENT_WEATHER_HOURLY, "window_start", 200
    ),
    "bike_json_rows": f"""
    WITH {_BIKE}
    SELECT to_json(struct_pack(
               event_time := strftime(event_time, '%Y-%m-%d %H:%M:%S'),
               dt := strftime(dt, '%Y-%m-%d'), station_id := station_id,
               bike_city := bike_city, docks_total := docks_total,
               bikes_available := bikes_available))::VARCHAR AS json
    FROM bike""",
    "weather_json_rows": f"""
    WITH {_WEATHER}
    SELECT to_json(struct_pack(
               station_id := station_id,
               event_time := strftime(event_time, '%Y-%m-%d %H:%M:%S'),
               temp_c := temp_c, precip_mm := precip_mm, humidity := humidity,
               condition := condition))::VARCHAR AS json
    FROM weather""",
    "oldest_hours_one_station": f"""
    SELECT window_start, station_id, bikes_occupied_hour, docks_total
    FROM ({_bike_usage("hour")}) WHERE station_id = 'S003'
    ORDER BY window_start ASC NULLS LAST LIMIT 40""",
    "table_recent_bike": _recent(_SILVER_BIKE, _RECENT_BIKE, "event_time", 500),
    "sql_rain_and_usage": f"""
    WITH rain AS ({_weather_summary("hour")}), usage AS ({_bike_usage("hour")})
    SELECT rain.station_id, rain.window_start, rain.dt, rain.sum_precip_mm_hour,
           usage.bikes_occupied_hour
    FROM rain JOIN usage USING (station_id, window_start)""",
    "stream_bronze_bike": _BRONZE_BIKE,
    "stream_bronze_weather": _BRONZE_WEATHER,
    "stream_silver_bike": f"""
    SELECT * REPLACE (round(availability_rate, 9) AS availability_rate,
                      round(utilization_rate, 9) AS utilization_rate) FROM ({_SILVER_BIKE})""",
    "stream_silver_weather": _SILVER_WEATHER,
    "stream_bike_hourly": _bike_usage("hour", closed_only=True),
    "stream_bike_daily": _bike_usage("day", closed_only=True),
    "stream_bike_minute": _bike_minute(closed_only=True),
    "stream_weather_hourly": _weather_summary("hour", closed_only=True),
    "stream_weather_daily": _weather_summary("day", closed_only=True),
    "stream_quarantine": _MALFORMED_QUARANTINE,
    "malformed_weather_drop": _MALFORMED_WEATHER_DROP,
    "malformed_weather_quarantine": _MALFORMED_WEATHER_QUARANTINE,
    "weather_nonfinite_counts": _NONFINITE_COUNTS,
    "bronze_json_rows": f"""
    WITH {_BIKE}, rows AS (
        SELECT station_id AS key, event_id AS "offset",
               strftime(ts + to_microseconds(event_id % 1000000), '%Y-%m-%d %H:%M:%S.%f') AS long
        FROM bike)
    SELECT to_json(struct_pack(key := key, "offset" := "offset",
               kafka_timestamp := regexp_replace(rtrim(long, '0'), '\\.$', '')))::VARCHAR AS json
    FROM rows""",
    "table_recent_weather": _recent(_SILVER_WEATHER, _RECENT_WEATHER, "event_time", 500),
    "table_compacted": _SILVER_WEATHER,
    "table_batch_then_stream": f"""
    SELECT * REPLACE (round(availability_rate, 9) AS availability_rate,
                      round(utilization_rate, 9) AS utilization_rate) FROM ({_SILVER_BIKE})""",
    "sql_after_append": f"""
    WITH {_BIKE}
    SELECT station_id, hour(event_time)::INT AS hr, count(*) AS n_rows, CAST(0 AS BIGINT) AS refused
    FROM bike GROUP BY ALL""",
    "stream_bike_daily_bounded": _bike_usage("day", closed_only=True),
    "stream_weather_hourly_bounded": _weather_summary("hour", closed_only=True),
    "stream_bike_daily_backfilled": _bike_usage("day", closed_only=True),
    "stream_bike_hourly_composed": _bike_usage("hour", closed_only=True),
    "stream_quarantine_weather": _MALFORMED_WEATHER_QUARANTINE,
    # The late rows are events that were counted before: the result is that without them.
    "stream_late_rows": _bike_usage("day", closed_only=True),
}
ORACLE |= {
    f"table_{view}": ORACLE[view]
    for view in ("recent_bike_minute", "recent_bike_hourly", "recent_weather_hourly")
}
_SHOWN = {
    "recent_bike": _RECENT_BIKE,
    "recent_weather": _RECENT_WEATHER,
    "recent_bike_minute": _RECENT_MINUTE,
    "recent_bike_hourly": _RECENT_BIKE_HOURLY,
    "recent_weather_hourly": _RECENT_WEATHER_HOURLY,
}
ORACLE |= {f"{view}_json": _json(ORACLE[view], shown) for view, shown in _SHOWN.items()}

# One topic partition with lost and repeated messages.
_THERE = """
    there AS (SELECT event_id FROM events
              WHERE event_id % 97 NOT BETWEEN 5 AND 7 AND event_id % 1000 NOT BETWEEN 400 AND 480)"""
_PATCHY_BRONZE = f"""
    WITH all_rows AS ({_BRONZE_BIKE})
    SELECT * REPLACE (0::INT AS partition) FROM all_rows
    WHERE "offset" % 97 NOT BETWEEN 5 AND 7 AND "offset" % 1000 NOT BETWEEN 400 AND 480"""

_FORGOTTEN = "event_id % 50 = 7 AND ts < TIMESTAMP '2024-01-15'"
_LATE_ROWS = f"""
    WITH {_BIKE}, late AS (SELECT * FROM bike WHERE {_FORGOTTEN})
    SELECT {_BIKE_COLUMNS}, round(bikes_available / docks_total::DOUBLE, 9) AS availability_rate,
           round(bikes_occupied / docks_total::DOUBLE, 9) AS utilization_rate,
           date_trunc('day', event_time)::TIMESTAMP AS window_start,
           (date_trunc('day', event_time) + INTERVAL 1 DAY)::TIMESTAMP AS window_end,
           (m % 3)::INT AS source_partition, event_id + 1000000000 AS source_offset,
           count(*) OVER (PARTITION BY station_id, dt) AS n_missed, true AS certain
    FROM late"""
_LATE_WINDOWS = f"""
    WITH {_BIKE}, days AS (
        SELECT station_id, bike_city, date_trunc('day', event_time)::TIMESTAMP AS window_start,
               (date_trunc('day', event_time) + INTERVAL 1 DAY)::TIMESTAMP AS window_end,
               count(*) AS n_rows, count(*) FILTER (NOT ({_FORGOTTEN})) AS n_summarised
        FROM bike GROUP BY ALL)
    SELECT *, n_rows - n_summarised AS n_missed, (n_summarised > 0)::BIGINT AS n_summaries
    FROM days WHERE n_rows > n_summarised"""
_OPEN_WINDOWS = f"""
    WITH {_BIKE}, days AS (
        SELECT station_id, bike_city, date_trunc('day', event_time)::TIMESTAMP AS window_start,
               (date_trunc('day', event_time) + INTERVAL 1 DAY)::TIMESTAMP AS window_end, count(*) AS n_rows
        FROM bike GROUP BY ALL)
    SELECT * FROM days WHERE NOT {_CLOSED.format("bike")}"""
_JOINED_CLOSED = f"""
    WITH rain AS ({_weather_summary("hour", closed_only=True)}), usage AS ({_bike_usage("hour", closed_only=True)})
    SELECT station_id, window_start, rain.dt, weather_city, avg_temp_c_hour,
           sum_precip_mm_hour, bike_city, bikes_occupied_hour, utilization_rate_avg_hour
    FROM rain JOIN usage USING (station_id, window_start)"""
# Kind 6 of the broken texts fits the weather schema, which has no dock count: a row without readings.
_QUALITY_TOTALS = f"""
    WITH {_FAULTY_WEATHER}, kinds AS (SELECT *, {_KIND} AS kind FROM checked)
    SELECT count(*) AS n_messages, count(*) FILTER (kind NOT IN (-1, 6)) AS refused,
           count(*) FILTER (kind IN (-1, 6)) AS n_rows, CAST(0 AS BIGINT) AS finite,
           count(*) FILTER (kind = -1 AND r1) AS precip_not_negative,
           count(*) FILTER (kind = -1 AND r2) AS wind_not_negative,
           count(*) FILTER (kind = -1 AND r3) AS humidity_in_range,
           count(*) FILTER (kind = -1 AND r4) AS one_decimal,
           count(*) FILTER (kind = -1 AND r5) AS known_condition
    FROM kinds"""

ORACLE |= {
    "offset_gaps": f"""
    WITH {_THERE}, steps AS (
        SELECT event_id, lag(event_id) OVER (ORDER BY event_id) AS last FROM there)
    SELECT 'bike' AS topic, 0::INT AS partition, last + 1 AS first_missing, event_id - 1 AS last_missing,
           event_id - last - 1 AS n_missing
    FROM steps WHERE event_id > last + 1""",
    "offset_repeats": f"""
    WITH {_THERE}
    SELECT 'bike' AS topic, 0::INT AS partition, event_id AS "offset",
           (2 + (event_id % 2 = 0)::INT)::BIGINT AS n_copies, true AS same_message
    FROM there WHERE event_id % 53 = 0""",
    "offsets_once": _PATCHY_BRONZE,
    "newest_bike_one_station": ORACLE["recent_bike_one_station"],
    "newest_bike_minute": ORACLE["recent_bike_minute"],
    "table_compacted_twice": ORACLE["bike_minute"],
    "table_compacted_in_place": ORACLE["bike_minute"],
    "table_expired": ORACLE["retained"],
    "stream_expired": ORACLE["retained"],
    "stream_bike_daily_backfilled_twice": ORACLE["stream_bike_daily"],
    "stream_weather_hourly_backfilled_twice": ORACLE["stream_weather_hourly"],
    "late_rows_table": _LATE_ROWS,
    "late_windows_after_backfill": _LATE_WINDOWS,
    "restated_bike_daily": ORACLE["stream_bike_daily"],
    "restated_after_backfill": ORACLE["stream_bike_daily"],
    "stream_open_windows": _OPEN_WINDOWS,
    "stream_weather_bike_hourly": _JOINED_CLOSED,
    "stream_silver_with_quarantine": f"""
    SELECT * REPLACE (round(availability_rate, 9) AS availability_rate,
                      round(utilization_rate, 9) AS utilization_rate) FROM ({_MALFORMED_DROP})""",
    "stream_quality_totals": _QUALITY_TOTALS,
}
