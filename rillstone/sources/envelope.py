"""Message envelopes: one Kafka-shaped row per message, from a topic or from files."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillstone.schemas import ENVELOPE


#: Files older than this before the newest one read are skipped: none are.
MAX_FILE_AGE = "36500d"


@dataclass(frozen=True)
class KafkaTopic:
    """One topic. Needs the Spark Kafka connector on the class path.

    Messages are keyed by station, so a busy station fills one broker partition.
    ``min_partitions`` makes Spark read large offset ranges with several tasks each.
    """

    brokers: str
    topic: str
    starting: str = "latest"
    fail_on_data_loss: bool = False
    max_offsets_per_trigger: int | None = None
    min_partitions: int | None = None
    options: dict[str, str] = field(default_factory=dict)

    def read_options(self) -> dict[str, str]:
        chosen = {
            "kafka.bootstrap.servers": self.brokers,
            "subscribe": self.topic,
            "startingOffsets": self.starting,
            "failOnDataLoss": str(self.fail_on_data_loss).lower(),
        }
        if self.max_offsets_per_trigger is not None:
            chosen["maxOffsetsPerTrigger"] = str(self.max_offsets_per_trigger)
        if self.min_partitions is not None:
            chosen["minPartitions"] = str(self.min_partitions)
        return {**chosen, **self.options}

    def write_options(self) -> dict[str, str]:
        return {"kafka.bootstrap.servers": self.brokers, **self.options}


@dataclass(frozen=True)
class EnvelopeFolder:
    """A folder of envelope files with the same columns, for replays and tests.

    Spark forgets, and then skips, files more than ``max_file_age`` older than the newest
    one it has read. The default forgets none, since replayed files may keep old dates; it
    costs the driver an entry per file.
    """

    path: str
    fmt: str = "parquet"
    max_files_per_trigger: int | None = None
    max_bytes_per_trigger: str | None = None
    max_file_age: str = MAX_FILE_AGE

    def read_options(self) -> dict[str, str]:
        chosen = {"maxFileAge": self.max_file_age}
        if self.max_files_per_trigger is not None:
            chosen["maxFilesPerTrigger"] = str(self.max_files_per_trigger)
        if self.max_bytes_per_trigger is not None:
            chosen["maxBytesPerTrigger"] = self.max_bytes_per_trigger
        return chosen


def read_envelope_stream(spark: SparkSession, source: KafkaTopic | EnvelopeFolder) -> DataFrame:
    """Unbounded envelope rows from either kind of source."""
    reader = spark.readStream.options(**source.read_options())
    if isinstance(source, KafkaTopic):
        return reader.format("kafka").load()
    return reader.schema(ENVELOPE).format(source.fmt).load(source.path)


def to_envelope(
    df: DataFrame,
    topic: str,
    key: str = "station_id",
    payload: list[str] | None = None,
    carry: list[str] | None = None,
) -> DataFrame:
    """Encode rows as messages: key bytes, JSON value bytes, topic.

    ``payload`` names the columns of the JSON object (default: all), ``carry`` those to
    pass on beside it, such as partition and offset. Null payload fields are left out
    of the JSON text.
    """
    fields = payload or df.columns
    return df.select(
        F.col(key).cast("string").cast("binary").alias("key"),
        F.to_json(F.struct(*fields)).cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        *(carry or []),
    )


def publish(messages: DataFrame, target: KafkaTopic | EnvelopeFolder) -> None:
    """Send encoded messages to a topic, or append them to an envelope folder."""
    if isinstance(target, KafkaTopic):
        (
            messages.select("key", "value", F.lit(target.topic).alias("topic"))
            .write.format("kafka")
            .options(**target.write_options())
            .save()
        )
        return
    have = set(messages.columns)
    full = messages.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in ENVELOPE.fields
        ]
    )
    full.write.mode("append").format(target.fmt).save(target.path)
