"""The seven gold tables, each a function from DataFrames to a DataFrame."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from depotlake.functions.shipments import ACTIVE_STATUSES, DEFAULT_DELAY_REASON, DELAYED, is_recent
from depotlake.operators.grid import CELL_ROWS, grid_join
from depotlake.operators.latest import latest_by
from depotlake.operators.merge import upsert
from depotlake.operators.quality import run_time
from depotlake.plans.silver import LATEST_ORDER, SHIPMENT_KEYS
from depotlake.schemas import DIM_PRODUCT, DIM_WAREHOUSE, FACT_SHIPMENTS

# Fixed values of the gold tables.
LOW_STOCK_BELOW = 50
LOW_STOCK = "Low Stock"
IN_STOCK = "OK"
PRODUCT_SOURCE = "inventory_silver"
WAREHOUSE_SOURCE = "static_mapping"
KEEP_DAYS = 90


def product_source(inventory: DataFrame, as_of: date) -> DataFrame:
    """One row per product: the name in the warehouse that restocked it last.

    The same product is stocked in many warehouses, and a merge needs unique source keys.
    """
    names = inventory.select("product_id", "product_name", "last_restock_date", "warehouse_id")
    latest = latest_by(names, ["product_id"], ["last_restock_date", "warehouse_id"])
    return latest.select(
        "product_id",
        "product_name",
        F.lit(as_of).alias("effective_date"),
        F.lit(PRODUCT_SOURCE).alias("source"),
    )


def attribute_changed(name: str) -> Callable[[Callable, Callable], Column]:
    """The update rule of the dimensions: a null on either side is no change."""
    return lambda target, source: target(name) != source(name)


def dim_product(target: DataFrame, inventory: DataFrame, as_of: date) -> DataFrame:
    return upsert(
        target, product_source(inventory, as_of), DIM_PRODUCT.keys, attribute_changed("product_name")
    )


def warehouse_source(mapping: DataFrame, as_of: date) -> DataFrame:
    return mapping.select(
        "warehouse_id",
        "city",
        F.lit(as_of).alias("effective_date"),
        F.lit(WAREHOUSE_SOURCE).alias("source"),
    )


def dim_warehouse(target: DataFrame, mapping: DataFrame, as_of: date) -> DataFrame:
    return upsert(target, warehouse_source(mapping, as_of), DIM_WAREHOUSE.keys, attribute_changed("city"))


def fact_inventory_daily(
    inventory: DataFrame, as_of: date, low_stock_below: int = LOW_STOCK_BELOW
) -> DataFrame:
    return inventory.select(
        "warehouse_id",
        "product_id",
        "quantity_in_stock",
        "last_restock_date",
        F.lit(as_of).alias("snapshot_date"),
        F.when(F.col("quantity_in_stock") < low_stock_below, LOW_STOCK).otherwise(IN_STOCK).alias("stock_status"),
    )


def low_stock_top(fact_inventory: DataFrame, limit: int = 10) -> DataFrame:
    """The newest snapshot rows first, lowest stock first within a day, in a total order."""
    return fact_inventory.orderBy(
        F.col("snapshot_date").desc(), "quantity_in_stock", "warehouse_id", "product_id"
    ).limit(limit)


def fact_sales_daily(sales: DataFrame) -> DataFrame:
    """Units per warehouse, product and day. Undated lines have no day and stay in silver."""
    return (
        sales.filter(F.col("sale_date").isNotNull())
        .groupBy("warehouse_id", "product_id", "sale_date")
        .agg(F.sum("quantity_sold").alias("qty_sold"))
    )


def fact_shipments(
    shipments: DataFrame,
    as_of: date,
    keep_days: int = KEEP_DAYS,
    recent_at: datetime | None = None,
    order_by: Sequence[str] = LATEST_ORDER,
) -> DataFrame:
    """The latest state of each shipment, if it is recent enough.

    The latest is the one silver keeps; ``order_by=["ingestion_time"]`` takes the last ingested.
    The age is checked after the choice: a shipment whose last state is too old is left out, an
    older state must not take its place. ``is_recent`` is the flag silver stored when it
    saw the event, unless ``recent_at`` asks for it at another time.
    """
    latest = latest_by(shipments, SHIPMENT_KEYS, order_by)
    if recent_at is not None:
        latest = latest.withColumn("is_recent", is_recent(F.col("timestamp"), run_time(recent_at)))
    recent = latest.filter(F.col("timestamp") >= F.date_sub(F.lit(as_of), keep_days).cast("timestamp"))
    return shipment_columns(recent)


def shipment_columns(states: DataFrame) -> DataFrame:
    """Silver states with the columns of ``fact_shipments``."""
    times = {"event_ts": F.col("timestamp"), "event_date": F.to_date("timestamp")}
    return states.withColumns(times).select(*FACT_SHIPMENTS.schema.fieldNames())


def supplychain_snapshot(
    fact_inventory: DataFrame,
    products: DataFrame,
    fact_shipment: DataFrame,
    as_of: date,
    cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """The day's stock with every active shipment of the same warehouse.

    Both sides are reduced before they meet. The pairing is many-to-many on few keys, so
    the pairs of a large warehouse are spread over many tasks.
    """
    shipments = fact_shipment.select(
        "shipment_id", "warehouse_id", "status", "city", "event_ts", "delay_reason"
    )
    is_active = F.col("status").isin(*ACTIVE_STATUSES)
    active = latest_by(shipments, ["shipment_id"], ["event_ts"]).filter(is_active)
    today = fact_inventory.filter(F.col("snapshot_date") == F.lit(as_of)).select(
        "warehouse_id", "product_id", "quantity_in_stock", "stock_status"
    )
    stock = today.join(products.select("product_id", "product_name"), "product_id")
    pairs = grid_join(
        stock,
        active,
        "warehouse_id",
        ["product_id"],
        ["shipment_id"],
        left_keys=today,
        right_keys=shipments.filter(is_active),
        cell_rows=cell_rows,
    )
    return pairs.select(
        "warehouse_id",
        "product_id",
        "product_name",
        "quantity_in_stock",
        "stock_status",
        "shipment_id",
        "status",
        F.col("city").alias("location"),
        F.col("event_ts").alias("timestamp"),
        "delay_reason",
        F.lit(as_of).alias("snapshot_date"),
    )


def alerts_shipments(fact_shipment: DataFrame) -> DataFrame:
    return fact_shipment.filter(F.col("status") == DELAYED).select(
        "shipment_id",
        "warehouse_id",
        F.col("city").alias("location"),
        F.coalesce("delay_reason", F.lit(DEFAULT_DELAY_REASON)).alias("delay_reason"),
        F.col("event_ts").alias("timestamp"),
        F.to_date("event_ts").alias("event_date"),
    )


def within_retention(df: DataFrame, date_column: str, as_of: date, keep_days: int = KEEP_DAYS) -> DataFrame:
    """The rows retention leaves: the row form of dropping whole expired partitions."""
    return df.filter(F.col(date_column) >= F.date_sub(F.lit(as_of), keep_days))
