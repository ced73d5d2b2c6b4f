"""Numeric helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_ratio(part: str, whole: str) -> Column:
    """``part / whole`` as double; null when the whole is missing, zero or negative."""
    return F.when(F.col(whole) > 0, F.col(part) / F.col(whole))


def whole_mean(column: str) -> Column:
    """Mean rounded half up to an int."""
    return F.round(F.avg(column)).cast("int")
