"""Bronze to silver for the daily files and the shipment events."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from depotlake.functions import (
    canonical_status,
    is_recent,
    is_text,
    normalise_id,
    parse_date,
    parse_location,
    parse_timestamp,
    valid_shipment_key,
)
from depotlake.functions.shipments import DELAYED
from depotlake.operators.latest import latest_by, latest_counted
from depotlake.operators.quality import add_audit, run_time, split_rejects

# Where the rows come from.
BATCH_SOURCE = "aws-s3"
STREAM_SOURCE = "TMS_live"

INVENTORY_KEYS = ("warehouse_id", "product_id")
SALES_KEYS = ("order_id", "product_id", "warehouse_id")
SHIPMENT_KEYS = ("shipment_id",)
# The one rule for the latest event of a shipment, in the stream, in silver and in gold.
LATEST_ORDER = ("timestamp", "ingestion_time")

BLANK_LINE = "blank line"
UNPARSED_DATE = "unparsed date"
UNREADABLE_QUANTITY = "unreadable quantity"
# Findings on rows that reach silver all the same, with a null in place of the value.
KEPT_WITH_NULL = (UNPARSED_DATE, UNREADABLE_QUANTITY)

INVALID_SHIPMENT_KEY = "invalid shipment key"
UNREADABLE_TIME = "no readable event time"


def _blank(df: DataFrame) -> Column:
    return reduce(and_, (F.col(c).isNull() for c in df.columns))


def _missing(columns: Sequence[str]) -> dict[str, Column]:
    """A key of white space names nothing, as a null does."""
    return {f"missing {c}": F.col(c).isNull() | (F.trim(F.col(c).cast("string")) == "") for c in columns}


def _date(df: DataFrame, name: str) -> Column:
    return parse_date(name) if is_text(df, name) else F.col(name).cast("date")


def _unparsed_date(df: DataFrame, name: str) -> Column:
    return F.col(name).isNotNull() & _date(df, name).isNull()


def _quantity(name: str) -> Column:
    """No quantity is 0; a text that is no whole number is unknown."""
    text = F.trim(F.col(name).cast("string"))
    return F.when(text.isNull() | (text == ""), F.lit(0)).otherwise(text.try_cast("int"))


def _unreadable_quantity(name: str) -> Column:
    return _quantity(name).isNull()


# --- inventory ---------------------------------------------------------------------------


def inventory_rules(df: DataFrame) -> dict[str, Column]:
    return {BLANK_LINE: _blank(df), **_missing(("product_id", "product_name"))}


def split_inventory(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that name a product, and the others with the reason."""
    return split_rejects(df, inventory_rules(df))


def clean_inventory(accepted: DataFrame) -> DataFrame:
    return accepted.select(
        normalise_id("warehouse_id").alias("warehouse_id"),
        normalise_id("product_id").alias("product_id"),
        F.trim("product_name").alias("product_name"),
        _quantity("quantity_in_stock").alias("quantity_in_stock"),
        _date(accepted, "last_restock_date").alias("last_restock_date"),
    )


def silver_inventory(
    df: DataFrame, run_ts: datetime | None = None, source_system: str = BATCH_SOURCE, counted: bool = False
) -> DataFrame:
    """The latest restock of each product in each warehouse; ``counted`` adds the rows each replaced."""
    accepted, _ = split_inventory(df)
    choose = latest_counted if counted else latest_by
    return add_audit(choose(clean_inventory(accepted), INVENTORY_KEYS, ["last_restock_date"]), source_system, run_ts)


# --- sales -------------------------------------------------------------------------------


def sales_rules(df: DataFrame) -> dict[str, Column]:
    return {BLANK_LINE: _blank(df), **_missing(SALES_KEYS)}


def split_sales(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with a complete order-line key, and the others with the reason."""
    return split_rejects(df, sales_rules(df))


def clean_sales(accepted: DataFrame) -> DataFrame:
    return accepted.select(
        normalise_id("order_id").alias("order_id"),
        normalise_id("product_id").alias("product_id"),
        _quantity("quantity_sold").alias("quantity_sold"),
        _date(accepted, "sale_date").alias("sale_date"),
        normalise_id("warehouse_id").alias("warehouse_id"),
    )


def silver_sales(
    df: DataFrame, run_ts: datetime | None = None, source_system: str = BATCH_SOURCE, counted: bool = False
) -> DataFrame:
    """The latest sale date of each order line; ``counted`` adds the rows each replaced."""
    accepted, _ = split_sales(df)
    choose = latest_counted if counted else latest_by
    return add_audit(choose(clean_sales(accepted), SALES_KEYS, ["sale_date"]), source_system, run_ts)


# --- quarantine --------------------------------------------------------------------------


def quarantine(inventory: DataFrame, sales: DataFrame) -> DataFrame:
    """What the batch jobs put aside or could not read, one row per finding.

    ``dropped`` tells rows that did not reach silver from rows that did with a null date or
    quantity.
    """

    def findings(entity: str, raw: DataFrame, rules: dict[str, Column], date: str, quantity: str) -> DataFrame:
        unread = {UNPARSED_DATE: _unparsed_date(raw, date), UNREADABLE_QUANTITY: _unreadable_quantity(quantity)}
        _, found = split_rejects(raw, {**rules, **unread})
        order_id = F.col("order_id") if "order_id" in raw.columns else F.lit(None).cast("string")
        return found.select(
            F.lit(entity).alias("entity"),
            order_id.alias("order_id"),
            "product_id",
            "warehouse_id",
            F.col(date).cast("string").alias("raw_date"),
            "reject_reason",
            (~F.col("reject_reason").isin(*KEPT_WITH_NULL)).alias("dropped"),
        )

    stock = findings("inventory", inventory, inventory_rules(inventory), "last_restock_date", "quantity_in_stock")
    return stock.unionByName(findings("sales", sales, sales_rules(sales), "sale_date", "quantity_sold"))


def quarantine_shipments(bronze: DataFrame) -> DataFrame:
    """Bronze events that no gold table can show, with the reason.

    Events with an invalid key do not reach silver; those without a readable time belong to
    no day and so to no fact.
    """
    valid = F.coalesce(valid_shipment_key(F.col("shipment_id"), F.col("warehouse_id")), F.lit(False))
    rules = {INVALID_SHIPMENT_KEY: ~valid, UNREADABLE_TIME: F.col("timestamp").isNull()}
    _, found = split_rejects(bronze, rules)
    return found.select("shipment_id", "warehouse_id", "status", "timestamp", "ingestion_time", "reject_reason")


# --- shipments: the same functions serve the batch and the stream ------------------------


def standardise_shipments(
    df: DataFrame, run_ts: datetime | Column | None = None, source_system: str = STREAM_SOURCE
) -> DataFrame:
    """Landing fields to bronze: parsed time, tidy keys and status, audit columns."""
    time = parse_timestamp("timestamp") if is_text(df, "timestamp") else F.col("timestamp").cast("timestamp")
    return df.withColumns(
        {
            "timestamp": time,
            "warehouse_id": normalise_id("warehouse_id"),
            "shipment_id": normalise_id("shipment_id"),
            "status": F.lower(F.trim("status")),
            "delay_reason": F.trim("delay_reason"),
            "ingestion_time": run_time(run_ts),
            "source_system": F.lit(source_system),
        }
    )


def valid_shipments(bronze: DataFrame) -> DataFrame:
    return bronze.filter(valid_shipment_key(F.col("shipment_id"), F.col("warehouse_id")))


def describe_shipments(df: DataFrame, run_ts: datetime | Column | None = None) -> DataFrame:
    """Canonical status, delay and recency flags, coordinates or city."""
    status = canonical_status(F.col("status"))
    return df.withColumns(
        {
            "status": status,
            "is_delayed": status == DELAYED,
            "is_recent": is_recent(F.col("timestamp"), run_time(run_ts)),
            **parse_location(F.col("location")),
        }
    ).drop("location")


def silver_shipments(
    bronze: DataFrame, run_ts: datetime | Column | None = None, parity: bool = False
) -> DataFrame:
    """The latest event of each shipment, described.

    Rows with an invalid key are left out before the choice, so they cannot hide a valid
    event; ``parity=True`` chooses first, as the streaming job of old did.
    """
    if parity:
        kept = valid_shipments(latest_by(bronze, SHIPMENT_KEYS, LATEST_ORDER))
    else:
        kept = latest_by(valid_shipments(bronze), SHIPMENT_KEYS, LATEST_ORDER)
    return describe_shipments(kept, run_ts)
