"""Keep the newest days of a table."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def retained(df: DataFrame, as_of: date, days: int = 30) -> DataFrame:
    """Rows whose partition date is at most ``days`` before ``as_of``.

    The bound is a literal, so on a stored table whole partitions are skipped. Rows
    without a date are not retained.
    """
    return df.where(F.col("dt") >= F.date_sub(F.lit(as_of), days))
