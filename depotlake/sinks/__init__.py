"""Writers: idempotent table writes, exports and the serving load."""

from depotlake.sinks.bucketed import create_bucketed, merged_in_buckets, upsert_bucketed
from depotlake.sinks.publishing import export, load_serving, publish, publish_changed, read_export
from depotlake.sinks.tables import (
    apply_retention,
    ensure_tables,
    overwrite_path,
    replace_partition,
    replace_partitions,
    replace_table,
    upsert_table,
)

__all__ = [
    "apply_retention",
    "create_bucketed",
    "ensure_tables",
    "export",
    "load_serving",
    "merged_in_buckets",
    "overwrite_path",
    "publish",
    "publish_changed",
    "read_export",
    "replace_partition",
    "replace_partitions",
    "replace_table",
    "upsert_bucketed",
    "upsert_table",
]
