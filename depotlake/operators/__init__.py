"""DataFrame operators the plans are composed of."""

from depotlake.operators.completeness import completeness_counts, expected_files, file_completeness
from depotlake.operators.grid import grid_join
from depotlake.operators.latest import latest_by
from depotlake.operators.quality import add_audit, is_rejected, split_rejects
from depotlake.operators.balance import layer_counts, reconcile, write_balanced
from depotlake.operators.merge import upsert

__all__ = [
    "add_audit",
    "completeness_counts",
    "expected_files",
    "file_completeness",
    "grid_join",
    "is_rejected",
    "latest_by",
    "layer_counts",
    "reconcile",
    "split_rejects",
    "upsert",
    "write_balanced",
]
