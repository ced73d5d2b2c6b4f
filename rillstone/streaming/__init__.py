from rillstone.streaming.backfill import backfill_summaries, late_rows, restate, summary_gaps
from rillstone.streaming.flows import Flow, lake_flows
from rillstone.streaming.job import FlowFailed, LakeJob
from rillstone.streaming.state import open_windows
from rillstone.streaming.writer import write_table_stream, write_tables_stream

__all__ = [
    "Flow",
    "FlowFailed",
    "LakeJob",
    "backfill_summaries",
    "lake_flows",
    "late_rows",
    "open_windows",
    "restate",
    "summary_gaps",
    "write_table_stream",
    "write_tables_stream",
]
