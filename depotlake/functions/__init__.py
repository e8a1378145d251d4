"""Column expressions shared by the batch and the streaming jobs."""

from depotlake.functions.columns import is_text, normalise_id, parse_date, parse_timestamp
from depotlake.functions.shipments import canonical_status, is_recent, parse_location, valid_shipment_key

__all__ = [
    "canonical_status",
    "is_recent",
    "is_text",
    "normalise_id",
    "parse_date",
    "parse_location",
    "parse_timestamp",
    "valid_shipment_key",
]
