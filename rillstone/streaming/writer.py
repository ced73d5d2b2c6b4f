"""The sinks of streaming tables: one table a query, or several from one pass over its batches."""

from __future__ import annotations

from collections.abc import Callable
from urllib.parse import unquote, urlsplit

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from rillstone.layout import LakeLayout
from rillstone.schemas import TableSpec
from rillstone.sources.files import Files
from rillstone.sources.tables import arrange, stored_columns

#: Batches whose staging folders are kept behind the newest one.
STAGED_KEPT = 2


def write_table_stream(
    df: DataFrame,
    layout: LakeLayout,
    spec: TableSpec,
    every: str | None = None,
    available_now: bool = False,
) -> StreamingQuery:
    """Append a stream to its table, exactly once per checkpoint.

    ``every`` is a processing-time interval, ``available_now`` works off what is there
    and ends; with neither, micro-batches follow one another without pause.
    """
    writer = (
        arrange(stored_columns(df, spec), spec)
        .writeStream.queryName(spec.view_name)
        .format(layout.fmt)
        .outputMode("append")
        .option("checkpointLocation", layout.checkpoint(spec))
        .partitionBy(*spec.partitions)
    )
    return _triggered(writer, every, available_now).start(layout.table(spec))


def _triggered(writer: DataStreamWriter, every: str | None, available_now: bool) -> DataStreamWriter:
    if available_now:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=every) if every else writer


def write_tables_stream(
    df: DataFrame,
    layout: LakeLayout,
    targets: dict[TableSpec, Callable[[DataFrame], DataFrame]],
    every: str | None = None,
    available_now: bool = False,
) -> StreamingQuery:
    """Append a stream to several tables, each of which takes its rows from the same batch.

    A batch is computed once and kept (in memory, else on executors' disks) while the tables are
    written; what is lost with an executor is computed again. The first table names the query and its checkpoint.
    Each table gets a batch exactly once (see ``publish_batch``).
    """
    first = next(iter(targets))
    checkpoint = layout.checkpoint(first)

    def write(batch: DataFrame, number: int) -> None:
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for spec, take in targets.items():
                publish_batch(take(batch), layout, spec, checkpoint, number)
        finally:
            batch.unpersist()

    writer = df.writeStream.queryName(first.view_name).foreachBatch(write).option("checkpointLocation", checkpoint)
    return _triggered(writer, every, available_now).start()


def publish_batch(df: DataFrame, layout: LakeLayout, spec: TableSpec, checkpoint: str, number: int) -> None:
    """Add one batch's rows to the table's batch folder; a batch that is given again adds nothing.

    The files are written beside the checkpoint first. Once the job has marked them complete they
    are moved into the table one by one, and a second mark says that all are there. A replay goes on where
    the last attempt stopped: it writes anew what was not complete, moves what was not moved yet, and does
    nothing for a batch with the second mark. A new checkpoint has no marks and so is a new start.

    A table format with transactions takes checkpoint and batch number as its transaction's name.
    """
    spark = df.sparkSession
    rows = arrange(stored_columns(df, spec), spec).write.format(layout.fmt).partitionBy(*spec.partitions)
    if layout.fmt == "delta":
        named = rows.mode("append").option("txnAppId", f"{checkpoint}/{spec.view_name}")
        named.option("txnVersion", number).save(layout.batch_table(spec))
        return
    files = Files(spark, layout.base)
    staged = f"{checkpoint}/staged/{number}/{spec.view_name}"
    if files.exists(f"{staged}/_PUBLISHED"):
        return
    if not files.exists(f"{staged}/_SUCCESS"):
        rows.mode("overwrite").save(staged)
    written = [unquote(urlsplit(path).path) for path in spark.read.schema(spec.stored_schema).format(layout.fmt).load(staged).inputFiles()]
    places = [path[path.index(f"/staged/{number}/{spec.view_name}/") :].split("/", 4)[4] for path in written]
    files.move_all([(f"{staged}/{place}", f"{layout.batch_table(spec)}/{place}") for place in places])
    files.mark(f"{staged}/_PUBLISHED")
    files.delete(f"{checkpoint}/staged/{number - STAGED_KEPT}")
