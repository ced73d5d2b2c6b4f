"""The station dimension and its lookup."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

STATION_SCHEMA = (
    "station_id STRING, city STRING, docks_total INT, base_temp_c DOUBLE, "
    "base_wind_kph DOUBLE, base_humidity INT, base_pressure_mb INT"
)

# Id, city, docks, and the usual temperature (C), wind (km/h),
# humidity (%) and pressure (mb) of each station.
STATIONS = (
    ("S001", "Boston", 28, 18.0, 14.0, 70, 1015),
    ("S002", "Cambridge", 24, 17.5, 12.0, 68, 1015),
    ("S003", "Somerville", 20, 17.5, 12.0, 66, 1015),
    ("S004", "Worcester", 26, 16.0, 10.0, 72, 1013),
    ("S005", "Springfield", 22, 17.0, 9.0, 67, 1014),
    ("S006", "Lowell", 20, 17.0, 10.0, 66, 1014),
    ("S007", "Quincy", 18, 17.5, 13.0, 71, 1015),
    ("S008", "Newton", 20, 17.2, 11.0, 67, 1015),
    ("S009", "Brockton", 18, 17.0, 11.0, 69, 1014),
    ("S010", "Lynn", 16, 17.8, 14.0, 73, 1015),
    ("S011", "Fall River", 22, 17.2, 13.0, 74, 1015),
    ("S012", "New Bedford", 22, 17.0, 14.0, 75, 1015),
    ("S013", "Framingham", 18, 16.8, 10.0, 68, 1014),
    ("S014", "Waltham", 18, 16.9, 10.0, 67, 1015),
    ("S015", "Haverhill", 16, 16.6, 10.0, 66, 1014),
    ("S016", "Malden", 16, 17.2, 12.0, 69, 1015),
    ("S017", "Medford", 18, 17.1, 11.0, 68, 1015),
    ("S018", "Taunton", 16, 16.9, 11.0, 70, 1015),
    ("S019", "Chicopee", 16, 16.5, 9.0, 67, 1014),
    ("S020", "Everett", 14, 17.2, 12.0, 70, 1015),
    ("S021", "Revere", 16, 17.8, 15.0, 74, 1015),
    ("S022", "Peabody", 16, 17.0, 12.0, 69, 1015),
    ("S023", "Arlington", 14, 16.9, 11.0, 68, 1015),
    ("S024", "Attleboro", 14, 16.8, 11.0, 69, 1015),
    ("S025", "Methuen", 14, 16.5, 10.0, 66, 1014),
    ("S026", "Barnstable", 12, 17.0, 17.0, 76, 1016),
    ("S027", "Pittsfield", 12, 15.0, 9.0, 72, 1012),
    ("S028", "Leominster", 12, 16.2, 9.0, 68, 1013),
    ("S029", "Westfield", 12, 16.4, 9.0, 67, 1014),
    ("S030", "Salem", 16, 17.6, 13.0, 72, 1015),
)


def station_dim(spark: SparkSession) -> DataFrame:
    """The thirty known stations."""
    kinds = [part.strip().split(" ") for part in STATION_SCHEMA.split(",")]
    rows = ", ".join(str(row) for row in STATIONS)
    casts = ", ".join(f"CAST({name} AS {kind}) AS {name}" for name, kind in kinds)
    names = ", ".join(name for name, _ in kinds)
    return spark.sql(f"SELECT {casts} FROM VALUES {rows} AS t({names})")


def with_station(
    df: DataFrame, dim: DataFrame | None = None, columns: tuple[str, ...] | None = None
) -> DataFrame:
    """Add the station's fixed attributes; rows of unknown stations keep nulls.

    The built-in dimension has thirty rows, so it is broadcast. A caller's own ``dim``
    (one row per ``station_id``) has no known size: the join strategy is left to its
    statistics and to adaptive execution, which also splits skewed station keys.
    Where ``df`` carries a temperature, ``temp_delta`` is its distance from usual.
    """
    side = F.broadcast(station_dim(df.sparkSession)) if dim is None else dim
    taken = set(df.columns)
    wanted = columns or tuple(c for c in side.columns if c != "station_id" and c not in taken)
    joined = df.join(side.select("station_id", *wanted), "station_id", "left")
    if "temp_c" in taken and "base_temp_c" in wanted:
        joined = joined.withColumn("temp_delta", F.col("temp_c") - F.col("base_temp_c"))
    return joined
