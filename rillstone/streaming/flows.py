"""Which query fills which table, from what."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rillstone import schemas as S
from rillstone.operators.bronze import to_bronze
from rillstone.operators.gold import WATERMARK, bike_minute, bike_usage, weather_summary
from rillstone.operators.insight import weather_bike_stream
from rillstone.operators.quality import bike_rules, rule_metrics, weather_rules
from rillstone.operators.silver import accepted, parse_events, parsed_messages, quarantined, refused, with_rates

#: Rows that a summary flow passes over, since their dates are filled in batch.
LEFT_TO_BACKFILL = "left_to_backfill"


@dataclass(frozen=True)
class Flow:
    """``source`` is a topic name, or the table whose appends are followed.

    ``summary`` marks flows whose windows close: they take all that is there in one batch,
    since a bounded batch in file order would close windows whose rows are still to come.

    ``also`` names further tables that are filled from the same batches: ``transform`` then makes
    what they share, and each table, the target included, takes its rows from it by its own function.
    ``beside`` is a second source, whose frame ``transform`` gets as its second argument.
    """

    source: str | S.TableSpec
    target: S.TableSpec
    transform: Callable[[DataFrame], DataFrame]
    every: str | None = None
    summary: bool = False
    also: tuple[tuple[S.TableSpec, Callable[[DataFrame], DataFrame]], ...] = ()
    take: Callable[[DataFrame], DataFrame] | None = None
    beside: str | S.TableSpec | None = None

    @property
    def sources(self) -> tuple[str | S.TableSpec, ...]:
        return (self.source,) if self.beside is None else (self.source, self.beside)

    @property
    def targets(self) -> dict[S.TableSpec, Callable[[DataFrame], DataFrame]]:
        """Every table it fills, and how the table's rows come from the transformed frame."""
        return {self.target: self.take or _same, **dict(self.also)}


def lake_flows(
    on_malformed: str = "drop",
    quarantine: bool = True,
    watermark: str = WATERMARK,
    ingest_time: Column | None = None,
    every: str | None = "2 minutes",
    minute_every: str | None = "30 seconds",
    composed: bool = False,
    summaries_from: date | None = None,
    audited: bool = True,
    one_parse: bool = True,
    checked: bool = True,
    joined: bool = False,
) -> tuple[Flow, ...]:
    """The nine flows: topic to bronze, bronze to silver, silver to the five summaries.

    By default each layer follows the stored layer below, so the source is read twice (once per
    topic) and each text is parsed once, however many summaries there are. With
    ``quarantine`` what strict parsing refuses is stored too, by the flow that fills silver, from the same parse
    of each batch. Without ``one_parse`` that is two more flows, which parse a second time and
    leave silver to Spark's own file sink. ``checked`` counts, per flow into silver, the messages, the refused ones,
    and the rows that break each quality rule (``LakeJob.progress()``). ``every`` is the
    trigger interval of all flows but the minute table's (None: without pause); each
    micro-batch adds at least one file per table partition it touches, so a longer interval
    means fewer, larger files.

    With ``composed`` every flow reads its topic and does all steps to its table in one plan:
    texts are parsed once per table, but no flow follows a file sink, whose list of files the
    driver reads again for each batch. ``summaries_from`` leaves event dates before it to
    ``backfill_summaries``; rows of these dates that a flow meets are counted by
    ``LakeJob.progress()``, and ``late_rows`` finds those that no backfill has taken.

    With ``joined`` one more flow joins the two topics' hours, as they close, into a table of weather and usage.

    ``audited`` stores what went into each summary row beside it, for ``summary_gaps``. It is part of the
    windows' state: a checkpoint begun without it goes on only without it.
    """

    def land(envelope: DataFrame) -> DataFrame:
        return to_bronze(envelope, ingest_time)

    def later(df: DataFrame, counted_as: str = "summaries_from") -> DataFrame:
        if summaries_from is None:
            return df
        before = F.count_if(F.col("dt") < F.lit(summaries_from)).alias(LEFT_TO_BACKFILL)
        return df.observe(counted_as, before).where(F.col("dt") >= F.lit(summaries_from))

    options = _Parsing(on_malformed, audited, checked)
    flows = [
        Flow("bike", S.BRONZE_BIKE, land),
        Flow("weather", S.BRONZE_WEATHER, land),
        _silver_flow(S.BRONZE_BIKE, S.SILVER_BIKE, S.BIKE_EVENT, bike_rules, with_rates, options),
        _silver_flow(S.BRONZE_WEATHER, S.SILVER_WEATHER, S.WEATHER_EVENT, weather_rules, lambda df: df, options),
        *(
            Flow(source, target, lambda df, make=make: make(later(df)), interval, summary=True)
            for source, target, make, interval in (
                (S.SILVER_BIKE, S.GOLD_BIKE_HOURLY, lambda df: bike_usage(df, "hour", watermark, audited), None),
                (S.SILVER_BIKE, S.GOLD_BIKE_DAILY, lambda df: bike_usage(df, "day", watermark, audited), None),
                (S.SILVER_WEATHER, S.GOLD_WEATHER_HOURLY, lambda df: weather_summary(df, "hour", watermark, audited), None),
                (S.SILVER_WEATHER, S.GOLD_WEATHER_DAILY, lambda df: weather_summary(df, "day", watermark, audited), None),
                (S.SILVER_BIKE, S.GOLD_BIKE_MINUTE, lambda df: bike_minute(df, watermark, audited), minute_every),
            )
        ),
    ]
    together = one_parse and on_malformed == "drop"
    for silver, bronze, target, schema in _REFUSED_FROM if quarantine else ():
        if together:
            at = next(k for k, flow in enumerate(flows) if flow.target == silver)
            flows[at] = replace(flows[at], also=((target, refused),))
        else:
            flows.append(Flow(bronze, target, lambda df, schema=schema: quarantined(df, schema)))
    if joined:
        flows.append(
            Flow(
                S.SILVER_WEATHER, S.GOLD_WEATHER_BIKE,
                lambda rain, usage: weather_bike_stream(later(rain), later(usage, "summaries_from_beside"), watermark),
                summary=True, beside=S.SILVER_BIKE,
            )
        )
    if composed:
        # Counted once, by the flows into silver, not again on the way to each summary.
        plain = lake_flows(on_malformed, quarantine, ingest_time=ingest_time, audited=audited, one_parse=one_parse, checked=False)
        by_target = {target: flow for flow in plain for target in flow.targets}
        flows = [_from_topic(flow, by_target) for flow in flows]
    return tuple(flow if flow.every else replace(flow, every=every) for flow in flows)


@dataclass(frozen=True)
class _Parsing:
    on_malformed: str
    placed: bool
    checked: bool


def _silver_flow(
    source: S.TableSpec,
    target: S.TableSpec,
    schema: StructType,
    rules: Callable[..., dict[str, Column]],
    finish: Callable[[DataFrame], DataFrame],
    options: _Parsing,
) -> Flow:
    """Bronze to silver; in strict mode in two steps, so that other tables can share the parse."""

    def kept(bronze: DataFrame) -> DataFrame:
        silver = finish(parse_events(bronze, schema, options.on_malformed, placed=options.placed))
        return silver.observe("quality", *rule_metrics(rules())) if options.checked else silver

    def parsed(bronze: DataFrame) -> DataFrame:
        messages = parsed_messages(bronze, schema)
        if not options.checked:
            return messages
        fits = F.col("_fits")
        messages = messages.observe("messages", F.count(F.lit(1)).alias("n_messages"), F.count_if(~fits).alias("refused"))
        return messages.observe("quality", *rule_metrics(rules(lambda name: F.col(f"_event.{name}")), fits))

    def silver(messages: DataFrame) -> DataFrame:
        return finish(accepted(messages, schema, options.placed))

    if options.on_malformed == "drop":
        return Flow(source, target, parsed, take=silver)
    return Flow(source, target, kept)


#: What is refused on the way into which table, from where, to where.
_REFUSED_FROM = (
    (S.SILVER_BIKE, S.BRONZE_BIKE, S.QUARANTINE_BIKE, S.BIKE_EVENT),
    (S.SILVER_WEATHER, S.BRONZE_WEATHER, S.QUARANTINE_WEATHER, S.WEATHER_EVENT),
)


def _from_topic(flow: Flow, by_target: dict[S.TableSpec, Flow]) -> Flow:
    """The flow with all steps from its topic on."""
    steps, sources = [], []
    for source in flow.sources:
        step = _same
        while isinstance(source, S.TableSpec):
            below = by_target[source]
            step = _then(_then(below.transform, below.targets[source]), step)
            source = below.source
        steps.append(step)
        sources.append(source)
    if flow.beside is None:
        return replace(flow, source=sources[0], transform=_then(steps[0], flow.transform))
    both = lambda a, b: flow.transform(steps[0](a), steps[1](b))
    return replace(flow, source=sources[0], beside=sources[1], transform=both)


def _same(df: DataFrame) -> DataFrame:
    return df


def _then(first: Callable, second: Callable) -> Callable[[DataFrame], DataFrame]:
    return lambda df: second(first(df))
