"""The newest rows of a stored table, without looking at the rest of it."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession

from rillstone.layout import LakeLayout
from rillstone.schemas import TableSpec
from rillstone.sources.files import Files, partition_folders, partition_value
from rillstone.sources.tables import FROM_DT, read_table


def stored_dates(spark: SparkSession, layout: LakeLayout, spec: TableSpec) -> list[date]:
    """Dates that may have rows, newest first, from the names of folders one level down.

    Some may be empty, none with rows is missing: for windows stored by their start's date, which may be the day
    before their ``dt``, that date stands for both.
    """
    found = set()
    for folder in layout.folders(spec):
        for path in partition_folders(Files(spark, layout.base), folder):
            name = path.rpartition("/")[2]
            value = partition_value(name, "dt") or partition_value(name, FROM_DT)
            if value is not None:
                found.add(date.fromisoformat(value))
    return sorted(found, reverse=True)


def newest(
    spark: SparkSession, layout: LakeLayout, spec: TableSpec, n: int, where: Column | None = None
) -> DataFrame:
    """The rows of the newest dates that together hold ``n`` rows (those that fulfil ``where``).

    A read ordered by time, newest first, and limited to ``n`` rows gives the same from this frame as from the
    whole table. Folders are tried newest first: the last date, the last two, four and so on. Only folders
    that are tried are listed and opened, so the cost follows n and not the table's age or its number of files; a
    folder written by a streaming sink is the exception, where Spark reads the sink's log of files first.
    Fewer than ``n`` rows in all give all rows, also those without a date.
    """
    dates, look_back = stored_dates(spark, layout, spec), 1
    while dates:
        rows = read_table(spark, layout, spec, missing_ok=True, since=dates[min(look_back, len(dates)) - 1])
        rows = rows if where is None else rows.where(where)
        if rows.limit(n).count() >= n:
            return rows
        if look_back >= len(dates):
            break
        look_back *= 2
    rows = read_table(spark, layout, spec, missing_ok=True)
    return rows if where is None else rows.where(where)
