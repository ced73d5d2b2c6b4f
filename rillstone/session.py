"""Session configuration and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def base_options(shuffle_partitions: int | None = None) -> dict[str, str]:
    """Options every job of this library relies on.

    Windows are aligned to UTC and ``to_date`` follows the session zone, so the zone is
    pinned. The advisory size is what adaptive execution cuts a skewed shuffle partition
    into before a table write, and so sets the size of the files of a large table.
    """
    options = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    }
    if shuffle_partitions is not None:
        options["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    return options


def streaming_options(
    spark: SparkSession, shuffle_partitions: int | None = None
) -> dict[str, str]:
    """Options of the streaming queries, on top of those of the session.

    Adaptive execution serves stateless queries too: it splits a hot station before the
    write. It must not merge small shuffle partitions there: rows are clustered by table
    partition, so merging saves no file and makes one task open them one after another.
    Stateful queries never use it; their partition count is ``spark.sql.shuffle.partitions``
    and is fixed in the checkpoint. File listing is spread over the cores there are,
    not over a task per file.
    """
    options = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.streaming.stateless.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.sources.parallelPartitionDiscovery.parallelism": str(
            2 * spark.sparkContext.defaultParallelism
        ),
    }
    if shuffle_partitions is not None:
        options["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    return options


@contextmanager
def settings(spark: SparkSession, options: dict[str, str]) -> Iterator[None]:
    """Runtime options for the duration of a block. A streaming query keeps those it
    was started under."""
    before = {name: spark.conf.get(name, None) for name in options}
    try:
        for name, value in options.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def rocksdb_options() -> dict[str, str]:
    """Keep window state on executor disk and upload only changes at each commit."""
    return {
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    }


def delta_options() -> dict[str, str]:
    """Needed when tables use ``fmt="delta"``; the Delta package must be on the class path."""
    return {
        "spark.sql.extensions": "io.delta.sql.DeltaSparkSessionExtension",
        "spark.sql.catalog.spark_catalog": "org.apache.spark.sql.delta.catalog.DeltaCatalog",
    }


def s3a_options(
    endpoint: str,
    access_key: str | None = None,
    secret_key: str | None = None,
    path_style: bool = True,
) -> dict[str, str]:
    """Object store access. Without keys, Hadoop's default credential chain applies."""
    scheme, _, host = endpoint.rpartition("://")
    options = {
        "spark.hadoop.fs.s3a.endpoint": host,
        "spark.hadoop.fs.s3a.path.style.access": str(path_style).lower(),
        "spark.hadoop.fs.s3a.connection.ssl.enabled": str(scheme != "http").lower(),
    }
    if access_key and secret_key:
        options["spark.hadoop.fs.s3a.access.key"] = access_key
        options["spark.hadoop.fs.s3a.secret.key"] = secret_key
    return options


def build_session(
    app_name: str = "rillstone",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    rocksdb: bool = True,
    extra: dict[str, str] | None = None,
    log_level: str = "WARN",
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    options = base_options(shuffle_partitions)
    if rocksdb:
        options.update(rocksdb_options())
    options.update(extra or {})
    for name, value in options.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel(log_level)
    return spark


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder path under the cluster's shared ``spark.checkpoint.dir``.

    A machine-local folder is used only where the setting is absent *and* the session
    runs in local mode; on a cluster a missing setting is an error.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        shared = tempfile.mkdtemp(prefix="rillstone-")
    return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
