"""Few large files in place of many small ones, within a table."""

from __future__ import annotations

import uuid
from dataclasses import replace
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillstone.layout import LakeLayout
from rillstone.schemas import TableSpec
from rillstone.sources.files import Files


def compact(
    spark: SparkSession, layout: LakeLayout, spec: TableSpec, until: date, since: date | None = None
) -> int:
    """Rewrite the batch folder's rows of closed dates (``since`` <= dt < ``until``) into few files.

    Returns the number of files replaced. The rows move to a folder that only batch reads look at, one
    sub-folder for each run, so a flow that follows the table does not take them for new ones; flows must have read
    the dates that are compacted, and one that is begun later takes them by ``backfill_summaries``. Rows that
    arrive for these dates afterwards are appended as ever and go along with the next run; a run that finds none
    changes nothing.

    The new files are complete before they are seen. A note of the run stands beside them from before
    they become visible, by one rename of a folder, until the old files are deleted; while it stands, reads
    leave the old files out by name. A run that stopped anywhere is undone or completed by the next. A store
    whose folder renames are not one step needs a table format instead, as do tables written by Spark's
    streaming file sink, whose log names the files.
    """
    from rillstone.sources.tables import arrange

    if layout.fmt == "delta":
        raise ValueError("compact by the table format's own command")
    files, root = Files(spark, layout.base), layout.compacted_table(spec)
    _finish(files, layout, spec)
    if not files.exists(layout.batch_table(spec)):
        return 0
    rows = spark.read.schema(spec.stored_schema).parquet(layout.batch_table(spec)).where(F.col("dt") < F.lit(until))
    if since is not None:
        rows = rows.where(F.col("dt") >= F.lit(since))
    # The names are fixed first, and exactly these files are read, whatever arrives meanwhile.
    old = sorted(r[0] for r in rows.select(F.col("_metadata.file_path")).distinct().collect())
    if not old:
        return 0
    run = uuid.uuid4().hex
    staged = f"{layout.compacting(spec)}/{run}"
    taken = spark.read.schema(spec.stored_schema).option("basePath", layout.batch_table(spec)).parquet(*old)
    arranged = arrange(taken.select(*spec.stored_schema.names), replace(spec, clustering="rebalance"))
    arranged.write.partitionBy(*spec.partitions).parquet(staged)
    spark.createDataFrame([(path,) for path in old], "path string").coalesce(1).write.parquet(f"{staged}/_replaced")
    spark.createDataFrame([(run,)], "run string").coalesce(1).write.mode("overwrite").parquet(layout.compaction_note(spec))
    files.move(staged, f"{root}/run={run}")
    _finish(files, layout, spec)
    return len(old)


def replaced_files(spark: SparkSession, layout: LakeLayout, spec: TableSpec) -> DataFrame | None:
    """Paths that a visible run has replaced and not yet deleted, or None."""
    return _replaced(Files(spark, layout.base), layout, spec)


def _replaced(files: Files, layout: LakeLayout, spec: TableSpec) -> DataFrame | None:
    note = layout.compaction_note(spec)
    if not files.exists(f"{note}/_SUCCESS"):
        return None
    run = files.spark.read.schema("run string").parquet(note).first()[0]
    below = f"{layout.compacted_table(spec)}/run={run}/_replaced"
    return files.spark.read.schema("path string").parquet(below) if files.exists(below) else None


def _finish(files: Files, layout: LakeLayout, spec: TableSpec) -> None:
    """Delete what a visible run replaced; drop what an invisible one had staged."""
    gone = _replaced(files, layout, spec)
    if gone is not None:
        for row in gone.toLocalIterator():
            files.delete(row[0])
    files.delete(layout.compaction_note(spec))
    files.delete(layout.compacting(spec))
