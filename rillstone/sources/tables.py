"""Reading and writing the stored tables, in batch and as streams."""

from __future__ import annotations

from dataclasses import replace
from datetime import date, timedelta
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rillstone.layout import LakeLayout
from rillstone.schemas import TableSpec
from rillstone.sources.compaction import replaced_files
from rillstone.sources.envelope import MAX_FILE_AGE
from rillstone.sources.expiry import expired_before
from rillstone.sources.files import Files, partition_folders, partition_value


#: Partition level of tables whose event dates are replaced as a whole: the date a window starts on.
#: A summary's own ``dt`` may be the next one, so the rows of one event date lie under two of those.
FROM_DT = "from_dt"


def _appended(layout: LakeLayout, spec: TableSpec) -> list[str]:
    """The table's folders that only grow: of streams, and of batch writes."""
    return list(dict.fromkeys([layout.table(spec), layout.batch_table(spec)]))


def _load(
    spark: SparkSession,
    layout: LakeLayout,
    spec: TableSpec,
    path: str,
    since: date | None = None,
    without: DataFrame | None = None,
) -> DataFrame | None:
    """All stored columns of one folder, or None where there is no such folder. With ``since`` only
    the folders of that date and later ones are listed, unless a streaming sink's log names the files.
    ``without`` holds paths of files that are left out."""
    reader, paths = spark.read.format(layout.fmt), [path]
    if layout.fmt != "delta":
        reader = reader.schema(spec.stored_schema)
        files = Files(spark, path)
        if since is not None and files.exists(path) and not files.exists(f"{path}/_spark_metadata"):
            paths = [folder for folder in partition_folders(files, path) if _reaches(folder.rpartition("/")[2], since)]
            reader = reader.option("basePath", path)
            if not paths:
                return None
    try:
        rows = reader.load(paths)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND" and "is not a Delta table" not in str(error):
            raise
        return None
    if without is not None:
        rows = rows.join(without, rows["_metadata.file_path"] == without["path"], "left_anti")
    return rows.select(
        *[F.col(f.name) if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in spec.stored_schema]
    )


def _reaches(name: str, since: date) -> bool:
    """Whether a partition folder may hold rows of the date or a later one."""
    dt, start = partition_value(name, "dt"), partition_value(name, FROM_DT)
    if dt is not None:
        return date.fromisoformat(dt) >= since
    return start is not None and date.fromisoformat(start) >= since - timedelta(days=1)


def read_table(
    spark: SparkSession,
    layout: LakeLayout,
    spec: TableSpec,
    missing_ok: bool = False,
    audit: bool = False,
    since: date | None = None,
) -> DataFrame:
    """Snapshot of a table with its declared columns, types and column order.

    Rows written by streams and rows written in batch are one table; windows that were restated
    stand in place of the rows they correct; expired dates are left out. ``audit`` adds the spec's audit columns (null in files
    written without them). ``since`` is the first partition date to be read; older folders are not
    even listed. A table that is in no folder is an error, or empty with ``missing_ok``.
    """
    replaced = replaced_files(spark, layout, spec)
    parts = []
    for path in [*_appended(layout, spec), layout.compacted_table(spec), layout.filled_table(spec)]:
        rows = _load(spark, layout, spec, path, since, replaced if path == layout.batch_table(spec) else None)
        if rows is not None:
            parts.append(rows)
    shown = spec.stored_schema.names if audit else spec.schema.names
    if not parts:
        if missing_ok or since is not None:
            return spark.createDataFrame([], spec.stored_schema).select(*shown)
        spark.read.format(layout.fmt).load(layout.table(spec))  # the reader's own error
    rows = reduce(DataFrame.unionAll, parts)
    restated = restated_windows(spark, layout, spec, since)
    if restated is not None:
        rows = _without(rows, restated, [*spec.keys, "window_start"]).unionAll(restated)
    kept_from = expired_before(spark, layout, spec)
    since = max((d for d in (since, kept_from) if d is not None), default=None)
    if since is not None:
        rows = rows.where(F.col("dt") >= F.lit(since))
    return rows.select(*shown)


def restated_windows(
    spark: SparkSession, layout: LakeLayout, spec: TableSpec, since: date | None = None
) -> DataFrame | None:
    """All stored columns of the windows that were restated, or None where none were."""
    return _load(spark, layout, spec, layout.restated_table(spec), since) if spec.keys else None


def _without(rows: DataFrame, others: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose keys are not among the others'; a null key equals a null key."""
    named = others.select(*[F.col(k).alias(f"_{k}") for k in keys]).distinct()
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    return rows.join(named, same, "left_anti")


def replace_dates(df: DataFrame, layout: LakeLayout, spec: TableSpec, path: str) -> None:
    """Write whole event dates of a summary, in place of what the folder has of them.

    A partition is a start date with the table's own partitions below it. Only partitions that get rows are
    replaced, each from one job, so that a second run, or one after a failure, leaves the same rows as one run.
    """
    rows = arrange(stored_columns(df, spec), spec).withColumn(FROM_DT, F.to_date("window_start"))
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.format(layout.fmt).partitionBy(FROM_DT, *spec.partitions).save(path)


def stream_table(
    spark: SparkSession,
    layout: LakeLayout,
    spec: TableSpec,
    max_files_per_trigger: int | None = None,
    max_bytes_per_trigger: str | None = None,
    audit: bool = False,
) -> DataFrame:
    """The table as an unbounded frame: what is there now, then every later append.

    Follows appends by streams and in batch, not windows filled or restated later. No file is skipped for its age.
    """
    reader = spark.readStream.format(layout.fmt)
    if layout.fmt != "delta":
        reader = reader.schema(spec.stored_schema).option("maxFileAge", MAX_FILE_AGE)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if max_bytes_per_trigger is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes_per_trigger)
    shown = spec.stored_schema.names if audit else spec.schema.names
    parts = [reader.load(path).select(*shown) for path in _appended(layout, spec)]
    return reduce(DataFrame.unionAll, parts)


def arrange(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Bring rows of one partition together before they are written.

    Without this every task opens a file in every partition it has a row for; with a
    plain hash shuffle a station holding a third of the events would be one task. See
    ``TableSpec.clustering``.
    """
    columns = [F.col(c) for c in spec.partitions]
    if spec.clustering == "rebalance":
        return df.hint("rebalance", *columns)
    if spec.clustering == "hash":
        if spec.spread_by:
            writers = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) // 4
            columns.append(F.pmod(F.xxhash64(*spec.spread_by), F.lit(max(1, writers))))
        return df.repartition(*columns)
    return df


def stored_columns(df: DataFrame, spec: TableSpec) -> DataFrame:
    """The declared columns, and those for audits that the frame has."""
    return df.select(*spec.schema.names, *[name for name in spec.audit.names if name in df.columns])


def write_table(df: DataFrame, layout: LakeLayout, spec: TableSpec, mode: str = "append") -> None:
    """Batch write with the table's layout."""
    (
        arrange(stored_columns(df, spec), spec)
        .write.mode(mode)
        .format(layout.fmt)
        .partitionBy(*spec.partitions)
        .save(layout.batch_table(spec))
    )


def rewrite_compact(
    spark: SparkSession,
    source: LakeLayout,
    target: LakeLayout,
    spec: TableSpec,
    since: date | None = None,
    until: date | None = None,
) -> None:
    """Copy closed dates (``since`` <= dt < ``until``) into another layout with few files.

    Each date and station comes together in one shuffle partition, or in several of the
    advisory size where it is larger, and so in as many files. The source stays as it is:
    streams that read or write it are not disturbed. What the target's batch folder has of a
    copied partition is replaced, so copying a date again, or after a failure, leaves it once.
    """
    if source == target:
        raise ValueError("source and target are one layout")
    rows = read_table(spark, source, spec, audit=True)
    if since is not None:
        rows = rows.where(F.col("dt") >= F.lit(since))
    if until is not None:
        rows = rows.where(F.col("dt") < F.lit(until))
    writer = arrange(rows, replace(spec, clustering="rebalance")).write.mode("overwrite")
    writer = writer.option("partitionOverwriteMode", "dynamic").format(target.fmt)
    writer.partitionBy(*spec.partitions).save(target.batch_table(spec))


def ensure_table(spark: SparkSession, layout: LakeLayout, spec: TableSpec) -> None:
    """Create an empty table where none exists, so a stream may start reading it."""
    for path in _appended(layout, spec):
        (
            spark.createDataFrame([], spec.stored_schema)
            .write.mode("ignore")
            .format(layout.fmt)
            .partitionBy(*spec.partitions)
            .save(path)
        )
