"""Shipment business rules as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns and status names the gold tables are defined by.
WAREHOUSE_PATTERN = "^WH[0-9]+$"
COORDINATES_PATTERN = "^[0-9.+-]+,[0-9.+-]+$"
IN_TRANSIT = "In Transit"
DELAYED = "Delayed"
DELIVERED = "Delivered"
UNKNOWN = "Unknown"
ACTIVE_STATUSES = (IN_TRANSIT, DELAYED)
DEFAULT_DELAY_REASON = "Traffic"


def valid_shipment_key(shipment_id: Column, warehouse_id: Column) -> Column:
    return shipment_id.isNotNull() & warehouse_id.rlike(WAREHOUSE_PATTERN)


def canonical_status(status: Column) -> Column:
    """Map a lower-cased free-text status; the first match wins, null is Unknown."""
    return (
        F.when(status.contains("transit"), IN_TRANSIT)
        .when(status.contains("delayed"), DELAYED)
        .when(status.contains("delivered"), DELIVERED)
        .otherwise(UNKNOWN)
    )


def is_recent(event_time: Column, now: Column) -> Column:
    return event_time >= now - F.expr("INTERVAL 1 DAY")


def parse_location(location: Column) -> dict[str, Column]:
    """Split a location into coordinates or, when it is not a pair of numbers, a city."""
    text = F.trim(location)
    is_pair = text.rlike(COORDINATES_PATTERN)
    parts = F.split(text, ",")
    return {
        "latitude": F.when(is_pair, F.get(parts, F.lit(0)).try_cast("double")),
        "longitude": F.when(is_pair, F.get(parts, F.lit(1)).try_cast("double")),
        "city": F.when(~is_pair, F.initcap(text)),
    }
