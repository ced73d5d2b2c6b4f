"""Look into the state of a summary flow: which windows are still open, and what they hold so far."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from rillstone.layout import LakeLayout
from rillstone.schemas import TableSpec


def open_windows(spark: SparkSession, layout: LakeLayout, target: TableSpec) -> DataFrame:
    """Keys, window_start, window_end and ``n_rows`` so far of every window in a summary flow's state.

    Read from the checkpoint with Spark's state reader, one task for each state partition, as of the last
    committed batch; the flow may be running. A window that was closed and written is not in the
    state any more. ``n_rows`` needs an ``audited`` flow: its four audit measures are the last ones.
    """
    state = spark.read.format("statestore").load(layout.checkpoint(target))
    buffers = state.schema["value"].dataType
    # Several buffers have one name (every mean keeps a "sum" and a "count"): name them by their place.
    numbered = StructType([StructField(f"b{k}", f.dataType) for k, f in enumerate(buffers.fields)])
    at = len(buffers.fields) - len(target.audit.names)
    if buffers.fields[at].name != "count":
        raise ValueError(f"the state of {target.view_name} was begun without audit columns")
    window = state.schema["key"].dataType.fields[0].name
    return state.select(
        *[F.col(f"key.{name}") for name in target.keys],
        F.col(f"key.{window}.start").alias("window_start"),
        F.col(f"key.{window}.end").alias("window_end"),
        F.col("value").cast(numbered)[f"b{at}"].alias("n_rows"),
    )
