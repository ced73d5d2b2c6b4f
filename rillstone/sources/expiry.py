"""Expire whole dates of a table: their folders go, and readers no longer look for them."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import SparkSession

from rillstone.layout import LakeLayout
from rillstone.schemas import TableSpec
from rillstone.sources.files import Files, partition_folders, partition_value

_NO_DATE = "__HIVE_DEFAULT_PARTITION__"


def expired_before(spark: SparkSession, layout: LakeLayout, spec: TableSpec) -> date | None:
    """The first date that is kept, or None if the table never expired."""
    marks = Files(spark, layout.base).names(layout.expiry_marks(spec))
    return max((date.fromisoformat(m) for m in marks), default=None)


def expire(spark: SparkSession, layout: LakeLayout, spec: TableSpec, as_of: date, days: int = 30) -> list[str]:
    """Delete the folders of all dates more than ``days`` before ``as_of``, and that of rows without a date.

    What stays is what ``retained`` keeps. Returns the deleted folders. A folder is deleted as a whole, never
    row by row, and no file is opened or rewritten; the driver lists one level of folders.

    A streaming sink's log goes on naming the deleted files. So the first date kept is recorded before anything is
    deleted, and ``read_table`` leaves earlier dates out by a literal on the partition column: files of those
    dates are never asked for, while a file missing elsewhere is still an error. The record only moves
    forward; a run that stopped half-way is completed by the next. Flows that follow the table must have read
    the dates that expire.
    """
    if layout.fmt == "delta":
        raise ValueError("delete old partitions by the table format's own command")
    keep_from = as_of - timedelta(days=days)
    before = expired_before(spark, layout, spec)
    if before is not None and before > keep_from:
        keep_from = before
    files = Files(spark, layout.base)
    files.mark(f"{layout.expiry_marks(spec)}/{keep_from.isoformat()}")
    gone = []
    for folder in layout.folders(spec):
        for path in partition_folders(files, folder):
            start = partition_value(path.rpartition("/")[2], "from_dt")
            if start is None:
                gone += _expired(path, keep_from)
            elif date.fromisoformat(start) < keep_from:
                for below in partition_folders(files, path):
                    gone += _expired(below, keep_from)
    for path in gone:
        files.delete(path)
    return gone


def _expired(path: str, keep_from: date) -> list[str]:
    name = path.rpartition("/")[2]
    value = partition_value(name, "dt")
    old = name == f"dt={_NO_DATE}" or (value is not None and date.fromisoformat(value) < keep_from)
    return [path] if old else []
