"""Text going in and coming out."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType, FloatType, TimestampNTZType, TimestampType


def iso_utc(column: Column | str) -> Column:
    """``yyyy-MM-ddTHH:mm:ssZ``, whole seconds. The session zone must be UTC."""
    return F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def row_text(name: str, data_type: DataType) -> Column:
    """A column as clients get it: times as text with any fraction, NaN as null."""
    column = F.col(name)
    if isinstance(data_type, (TimestampType, TimestampNTZType)):
        column = column.cast("string")
    elif isinstance(data_type, (DoubleType, FloatType)):
        column = F.when(~F.isnan(column), column)
    return column.alias(name)
