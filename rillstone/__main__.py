"""``python -m rillstone`` (or spark-submit): run the streaming program."""

from __future__ import annotations

import argparse
import os
from datetime import date

from rillstone.layout import LakeLayout
from rillstone.session import build_session, delta_options, s3a_options
from rillstone.sources.envelope import EnvelopeFolder, KafkaTopic
from rillstone.streaming import LakeJob, backfill_summaries, lake_flows


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="rillstone", description=__doc__)
    parser.add_argument("--base", required=True, help="folder of the tables, e.g. s3a://bucket")
    parser.add_argument("--format", default="parquet", help="table format: parquet, delta, ...")
    parser.add_argument("--brokers", help="Kafka bootstrap servers")
    parser.add_argument("--bike-topic", default="bike")
    parser.add_argument("--weather-topic", default="weather")
    parser.add_argument("--starting", default="latest", help="Kafka starting offsets")
    parser.add_argument("--bike-folder", help="envelope files instead of a topic")
    parser.add_argument("--weather-folder", help="envelope files instead of a topic")
    parser.add_argument("--on-malformed", choices=["drop", "keep"], default="drop")
    parser.add_argument(
        "--quarantine", action=argparse.BooleanOptionalAction, default=True, help="store refused messages"
    )
    parser.add_argument("--composed", action="store_true", help="each flow reads its topic, in one plan")
    parser.add_argument("--summaries-from", type=date.fromisoformat, help="first event date of the summaries")
    parser.add_argument("--backfill-until", type=date.fromisoformat, help="fill summaries before this date, in batch, and end")
    parser.add_argument("--backfill-since", type=date.fromisoformat)
    parser.add_argument("--fail-on-data-loss", action="store_true", help="stop where Kafka offsets are lost")
    parser.add_argument("--watermark", default="15 minutes")
    parser.add_argument("--every", default="2 minutes", help="trigger interval; '' runs without pause")
    parser.add_argument("--minute-every", default="30 seconds", help="that of the minute table")
    parser.add_argument("--available-now", action="store_true", help="work off what is there")
    parser.add_argument("--max-bytes-per-trigger", help="bound per batch, reading files")
    parser.add_argument("--max-offsets-per-trigger", type=int, help="bound per batch, Kafka")
    parser.add_argument("--min-partitions", type=int, help="least tasks per Kafka batch")
    parser.add_argument("--shuffle-partitions", type=int, help="state partitions per summary")
    parser.add_argument("--s3-endpoint", help="keys come from AWS_ACCESS_KEY_ID and _SECRET_")
    parser.add_argument("--master")
    chosen = parser.parse_args(argv)
    for topic in ("bike", "weather"):
        if not (chosen.brokers or getattr(chosen, f"{topic}_folder")):
            parser.error(f"give --brokers or --{topic}-folder")
    return chosen


def source_for(chosen: argparse.Namespace, topic: str) -> KafkaTopic | EnvelopeFolder:
    folder = getattr(chosen, f"{topic}_folder")
    if folder:
        return EnvelopeFolder(folder, max_bytes_per_trigger=chosen.max_bytes_per_trigger)
    return KafkaTopic(
        chosen.brokers,
        getattr(chosen, f"{topic}_topic"),
        chosen.starting,
        max_offsets_per_trigger=chosen.max_offsets_per_trigger,
        min_partitions=chosen.min_partitions,
        fail_on_data_loss=chosen.fail_on_data_loss,
    )


def main(argv: list[str] | None = None) -> None:
    chosen = arguments(argv)
    extra: dict[str, str] = {}
    if chosen.format == "delta":
        extra.update(delta_options())
    if chosen.s3_endpoint:
        extra.update(
            s3a_options(
                chosen.s3_endpoint,
                os.environ.get("AWS_ACCESS_KEY_ID"),
                os.environ.get("AWS_SECRET_ACCESS_KEY"),
            )
        )
    spark = build_session(
        master=chosen.master, shuffle_partitions=chosen.shuffle_partitions, extra=extra
    )
    layout = LakeLayout(chosen.base, chosen.format)
    if chosen.backfill_until:
        backfill_summaries(spark, layout, chosen.backfill_until, chosen.backfill_since)
        return
    job = LakeJob(
        spark,
        layout,
        {topic: source_for(chosen, topic) for topic in ("bike", "weather")},
        lake_flows(
            chosen.on_malformed, chosen.quarantine, chosen.watermark,
            every=chosen.every or None, minute_every=chosen.minute_every,
            composed=chosen.composed, summaries_from=chosen.summaries_from,
        ),
        max_bytes_per_trigger=chosen.max_bytes_per_trigger,
    )
    if chosen.available_now:
        for name, seen in job.run_available().items():
            print(name, seen)
    else:
        job.run()


if __name__ == "__main__":
    main()
