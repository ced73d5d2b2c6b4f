"""Run the flows together in one session."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import replace

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from rillstone.layout import LakeLayout
from rillstone.schemas import TableSpec
from rillstone.session import settings, streaming_options
from rillstone.sources.envelope import EnvelopeFolder, KafkaTopic, read_envelope_stream
from rillstone.sources.tables import ensure_table, stream_table
from rillstone.streaming.flows import Flow, lake_flows
from rillstone.streaming.progress import listen
from rillstone.streaming.writer import write_table_stream, write_tables_stream

Source = KafkaTopic | EnvelopeFolder | DataFrame


class FlowFailed(RuntimeError):
    """One flow ended with an error; the others were stopped."""

    def __init__(self, name: str, reason: str) -> None:
        super().__init__(f"{name} failed: {reason}")
        self.name = name
        self.reason = reason


class LakeJob:
    """The streaming program: all flows over one layout.

    ``sources`` maps topic names to a Kafka topic, an envelope folder or a streaming
    envelope frame. ``max_files_per_trigger`` / ``max_bytes_per_trigger`` bound how much
    of a stored table one micro-batch takes, so a backlog is worked off in pieces that
    fit the cluster. Summary flows are not bounded, by these or by their source: rows of a
    later piece would be late for windows that an earlier one closed. For a history too
    large for one batch use ``backfill_summaries``, then flows with ``summaries_from``.
    ``shuffle_partitions`` is the number of state partitions of each summary (default:
    the session's); a checkpoint keeps the number it was started with.
    """

    def __init__(
        self,
        spark: SparkSession,
        layout: LakeLayout,
        sources: Mapping[str, Source],
        flows: tuple[Flow, ...] | None = None,
        max_files_per_trigger: int | None = None,
        max_bytes_per_trigger: str | None = None,
        shuffle_partitions: int | None = None,
    ) -> None:
        self.spark = spark
        self.layout = layout
        self.sources = dict(sources)
        self.flows = lake_flows() if flows is None else flows
        self.max_files_per_trigger = max_files_per_trigger
        self.max_bytes_per_trigger = max_bytes_per_trigger
        self.shuffle_partitions = shuffle_partitions
        self.queries: dict[str, StreamingQuery] = {}
        self._reports = listen(spark)
        self._check_flows()

    def _check_flows(self) -> None:
        targets = [target.view_name for flow in self.flows for target in flow.targets]
        twice = {t for t in targets if targets.count(t) > 1}
        if twice:
            raise ValueError(f"more than one flow fills {sorted(twice)}")
        by_target = self._by_target()
        for flow in self.flows:
            above, frontier = set(), list(flow.sources)
            while frontier:
                source = frontier.pop()
                if source in flow.targets:
                    raise ValueError(f"{flow.target.view_name} is made from itself")
                if source in by_target and source not in above:
                    above.add(source)
                    frontier += by_target[source].sources

    def _by_target(self) -> dict[TableSpec, Flow]:
        return {target: flow for flow in self.flows for target in flow.targets}

    def start(self) -> dict[str, StreamingQuery]:
        """Start every flow; each follows its source until stopped. All or none run."""
        self._start_all(self.flows, available_now=False)
        return self.queries

    def run(self, poll_seconds: int = 5) -> None:
        """Start every flow and block. The first failure stops all and is raised by name."""
        self.start()
        self.wait(poll_seconds)

    def wait(self, poll_seconds: int = 5) -> None:
        """Block until a flow ends, whether by error or because it was stopped."""
        running = list(self.queries.values())
        try:
            while all(query.isActive for query in running):
                running[0].awaitTermination(poll_seconds)
        except StreamingQueryException:
            pass
        finally:
            self.stop()
        self._raise_failure()

    def run_available(self, only: Iterable[TableSpec] | None = None) -> dict[str, dict]:
        """Work off everything there is now, layer after layer, then return progress.

        Flows of a layer run side by side. ``only`` restricts the run to the named
        tables and what they are made from. Windows still open stay in the checkpoint.
        """
        waiting = self._needed(only)
        while waiting:
            pending = {target for flow in waiting for target in flow.targets}
            ready = [flow for flow in waiting if pending.isdisjoint(flow.sources)]
            started = self._start_all(ready, available_now=True)
            try:
                active = started
                while active:
                    # The first to fail is reported at once, not after those before it.
                    for query in active:
                        query.awaitTermination(0.2)
                    active = [query for query in active if query.isActive]
            except StreamingQueryException:
                self.stop()
                self._raise_failure()
            waiting = [flow for flow in waiting if flow not in ready]
        return self.progress()

    def stop(self) -> None:
        for query in self.queries.values():
            query.stop()

    def progress(self) -> dict[str, dict]:
        """Per flow: batches and rows seen, late rows dropped, newest watermark, what it observed.

        Sums run over the whole time since the flow was started, whether or not anyone asked in
        between. A flow that has ended is waited for until its last report is in.
        """
        return {name: self._progress_of(query) for name, query in self.queries.items()}

    def _progress_of(self, query: StreamingQuery) -> dict:
        total = self._reports.totals(query)
        return {
            "batches": len(total.batches),
            "rows_in": total.rows_in,
            "late_rows_dropped": total.late_rows_dropped,
            "watermark": total.watermark,
            "observed": {name: dict(sums) for name, sums in total.observed.items()},
            "active": query.isActive,
        }

    def _needed(self, only: Iterable[TableSpec] | None) -> list[Flow]:
        if only is None:
            return list(self.flows)
        by_target = self._by_target()
        wanted: set[TableSpec] = set()
        frontier = list(only)
        while frontier:
            spec = frontier.pop()
            if spec not in by_target:
                raise ValueError(f"no flow fills {spec.view_name}")
            wanted.add(by_target[spec].target)
            frontier += [source for source in by_target[spec].sources if isinstance(source, TableSpec)]
        return [flow for flow in self.flows if flow.target in wanted]

    def _start_all(self, flows: Iterable[Flow], available_now: bool) -> list[StreamingQuery]:
        try:
            return [self._start(flow, available_now) for flow in flows]
        except Exception:
            self.stop()
            raise

    def _start(self, flow: Flow, available_now: bool) -> StreamingQuery:
        options = streaming_options(self.spark, self.shuffle_partitions)
        with settings(self.spark, options):
            rows = flow.transform(*[self._read(source, flow.summary) for source in flow.sources])
            how = {"every": flow.every, "available_now": available_now}
            if flow.also:
                for target in flow.targets:
                    ensure_table(self.spark, self.layout, target)
                query = write_tables_stream(rows, self.layout, flow.targets, **how)
            else:
                query = write_table_stream(flow.targets[flow.target](rows), self.layout, flow.target, **how)
        self.queries |= {target.view_name: query for target in flow.targets}
        return query

    def _read(self, source: str | TableSpec, whole: bool) -> DataFrame:
        if isinstance(source, TableSpec):
            ensure_table(self.spark, self.layout, source)
            return stream_table(
                self.spark,
                self.layout,
                source,
                None if whole else self.max_files_per_trigger,
                None if whole else self.max_bytes_per_trigger,
                audit=True,
            )
        origin = self.sources[source]
        if isinstance(origin, DataFrame):
            return origin
        if whole and isinstance(origin, EnvelopeFolder):
            origin = replace(origin, max_files_per_trigger=None, max_bytes_per_trigger=None)
        elif whole:
            origin = replace(origin, max_offsets_per_trigger=None)
        return read_envelope_stream(self.spark, origin)

    def _raise_failure(self) -> None:
        for name, query in self.queries.items():
            error = query.exception()
            if error is not None:
                raise FlowFailed(name, str(error)) from error
