"""The shipment streams."""

from depotlake.streaming.late import finished_batches, keep_late_rows
from depotlake.streaming.latest import latest_table_stream, merge_latest, newest_events, read_derived, read_latest, snapshot_stream
from depotlake.streaming.progress import ProgressTable, progress_totals, read_progress
from depotlake.streaming.queries import (
    bronze_shipments,
    compact_latest_state,
    dedup_stream,
    latest_state,
    latest_state_stream,
    run_stream,
    silver_shipments_stream,
    stream_report,
)

__all__ = [
    "ProgressTable",
    "finished_batches",
    "keep_late_rows",
    "latest_table_stream",
    "merge_latest",
    "newest_events",
    "progress_totals",
    "read_derived",
    "read_latest",
    "read_progress",
    "snapshot_stream",
    "bronze_shipments",
    "compact_latest_state",
    "dedup_stream",
    "latest_state",
    "latest_state_stream",
    "run_stream",
    "silver_shipments_stream",
    "stream_report",
]
