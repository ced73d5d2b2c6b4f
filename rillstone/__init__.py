"""Layered streaming tables over JSON station events, written as plain Spark.

Every transform is a ``DataFrame -> DataFrame`` function that works on batch and
streaming frames alike; only ``sources.envelope`` and ``streaming`` know about
``readStream`` and ``writeStream``.
"""

from rillstone.layout import LakeLayout, query_lake, register_views
from rillstone.schemas import BIKE_EVENT, ENVELOPE, TABLES, WEATHER_EVENT, TableSpec
from rillstone.session import build_session, scratch_dir

__all__ = [
    "BIKE_EVENT",
    "ENVELOPE",
    "TABLES",
    "WEATHER_EVENT",
    "LakeLayout",
    "TableSpec",
    "build_session",
    "query_lake",
    "register_views",
    "scratch_dir",
]
