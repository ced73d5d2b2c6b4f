"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import math
import uuid
from collections.abc import Callable, Iterator
from functools import wraps
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillstone.session import scratch_dir


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write a table once to the shared folder of ``spark.checkpoint.dir`` and read it from there.

    Cuts lineage and fixes what later steps read, also when executors are lost.
    """
    path = scratch_dir(df.sparkSession, purpose)
    df.write.mode("error").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh_name(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have (Spark compares names without case)."""
    taken = {c.lower() for c in df.columns}
    name = stem
    while name.lower() in taken:
        name = f"{stem}_{uuid.uuid4().hex[:6]}"
    return name


def crc_remainder(doc_id: str, modulus: int):
    """crc32(doc_id as text) mod ``modulus``; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string")) % F.lit(modulus)


def docs_per_block(n: int) -> int:
    """Rows of one block: a task's worth. Grows with the root of the table, up to a fixed bound."""
    return min(16384, max(512, math.isqrt(n)))


def release() -> None:
    """Give back to the system what this process has freed.

    A Python worker serves one task after another, and its allocators keep what a task has freed, so a worker would
    go on holding the most that any task has needed.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU C library
    if trim is not None:
        trim(0)


def releasing(task: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """A function over a task's batches that ends by giving memory back."""

    @wraps(task)
    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from task(batches)
        finally:
            release()

    return whole


def released(task: Callable[..., pa.Table], *tables: Any) -> pa.Table:
    """The result for one group; memory is given back afterwards."""
    try:
        return task(*tables)
    finally:
        release()
