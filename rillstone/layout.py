"""Where tables and checkpoints live below one base URI."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from rillstone.schemas import TABLES, TableSpec


@dataclass(frozen=True)
class LakeLayout:
    """``base`` is any folder Spark can reach (``s3a://bucket``, ``hdfs://...``, a path)."""

    base: str
    fmt: str = "parquet"

    def table(self, spec: TableSpec) -> str:
        return f"{self.base.rstrip('/')}/{spec.path}"

    def batch_table(self, spec: TableSpec) -> str:
        """Where batch writes go. Files beside a streaming sink's log would never be read, so
        they have a folder of their own; a table format with a common log needs none."""
        if self.fmt == "delta":
            return self.table(spec)
        return f"{self.base.rstrip('/')}/_batch/{spec.path}"

    def filled_table(self, spec: TableSpec) -> str:
        """Summaries of whole event dates, replaced date by date (``backfill_summaries``)."""
        return f"{self.base.rstrip('/')}/_filled/{spec.path}"

    def restated_table(self, spec: TableSpec) -> str:
        """Windows that were summarised again; they stand in place of those elsewhere."""
        return f"{self.base.rstrip('/')}/_restated/{spec.path}"

    def compacted_table(self, spec: TableSpec) -> str:
        """Rows of the batch folder that were rewritten into few files, a folder for each run."""
        return f"{self.base.rstrip('/')}/_compacted/{spec.path}"

    def compacting(self, spec: TableSpec) -> str:
        return f"{self.base.rstrip('/')}/_compacting/{spec.path}"

    def compaction_note(self, spec: TableSpec) -> str:
        return f"{self.base.rstrip('/')}/_compaction_notes/{spec.path}"

    def folders(self, spec: TableSpec) -> list[str]:
        """All folders that hold rows of the table."""
        appended = [self.table(spec), self.batch_table(spec)]
        return list(dict.fromkeys([*appended, self.compacted_table(spec), self.filled_table(spec), self.restated_table(spec)]))

    def expiry_marks(self, spec: TableSpec) -> str:
        return f"{self.base.rstrip('/')}/_expired/{spec.path}"

    def checkpoint(self, spec: TableSpec) -> str:
        return f"{self.base.rstrip('/')}/_checkpoints/{spec.view_name}"


def register_views(
    spark: SparkSession, layout: LakeLayout, specs: tuple[TableSpec, ...] = TABLES
) -> list[str]:
    """Temp views ``<layer>_<table>`` over the stored tables, for SQL users.

    A view shows the files of the moment it was registered; register again, or use
    ``query_lake``, to see later ones. A table that is not there yet is an empty view.
    """
    from rillstone.sources.tables import read_table

    for spec in specs:
        read_table(spark, layout, spec, missing_ok=True).createOrReplaceTempView(spec.view_name)
    return [spec.view_name for spec in specs]


def query_lake(
    spark: SparkSession, layout: LakeLayout, text: str, specs: tuple[TableSpec, ...] = TABLES
) -> DataFrame:
    """A SQL query over the views as the tables are now."""
    register_views(spark, layout, specs)
    return spark.sql(text)
