"""Readers: daily files, the event stream, folder listings."""

from depotlake.sources.events import EVENT_COLUMNS, parse_events, read_event_files, read_event_stream
from depotlake.sources.files import (
    delete_paths,
    list_files,
    make_folder,
    path_exists,
    read_csv_by_name,
    read_csv_text,
    read_file_mapping,
)
from depotlake.sources.tables import read_table, read_table_stream, warehouse_mapping

__all__ = [
    "EVENT_COLUMNS",
    "delete_paths",
    "list_files",
    "make_folder",
    "parse_events",
    "path_exists",
    "read_csv_by_name",
    "read_csv_text",
    "read_event_files",
    "read_event_stream",
    "read_file_mapping",
    "read_table",
    "read_table_stream",
    "warehouse_mapping",
]
