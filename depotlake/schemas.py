"""One registry of every table: columns, keys, partitioning and serving widths."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

_TYPES: dict[str, DataType] = {
    "STRING": StringType(),
    "INT": IntegerType(),
    "BIGINT": LongType(),
    "DOUBLE": DoubleType(),
    "BOOLEAN": BooleanType(),
    "DATE": DateType(),
    "TIMESTAMP": TimestampType(),
}


def struct(columns: str) -> StructType:
    """``"a STRING, b INT"`` as a schema, without a running session."""
    pairs = (column.split() for column in columns.split(","))
    return StructType([StructField(name, _TYPES[kind]) for name, kind in pairs])


INVENTORY_CSV = struct(
    "warehouse_id STRING, product_id STRING, product_name STRING, category STRING,"
    " quantity_in_stock STRING, last_restock_date STRING"
)
INVENTORY_OPTIONAL = ("category",)

SALES_CSV = struct(
    "order_id STRING, product_id STRING, quantity_sold STRING, sale_date STRING, warehouse_id STRING"
)

SHIPMENT_JSON = struct(
    "shipment_id STRING, warehouse_id STRING, status STRING, location STRING,"
    " timestamp STRING, delay_reason STRING"
)

BRONZE_SHIPMENTS = struct(
    "shipment_id STRING, warehouse_id STRING, status STRING, location STRING, timestamp TIMESTAMP,"
    " delay_reason STRING, _rescued_data STRING, ingestion_time TIMESTAMP, source_file STRING,"
    " source_system STRING"
)

SILVER_INVENTORY = struct(
    "warehouse_id STRING, product_id STRING, product_name STRING, quantity_in_stock INT,"
    " last_restock_date DATE, ingestion_timestamp TIMESTAMP, source_system STRING"
)

SILVER_SALES = struct(
    "order_id STRING, product_id STRING, quantity_sold INT, sale_date DATE, warehouse_id STRING,"
    " ingestion_timestamp TIMESTAMP, source_system STRING"
)

SILVER_SHIPMENTS = struct(
    "shipment_id STRING, warehouse_id STRING, status STRING, timestamp TIMESTAMP, delay_reason STRING,"
    " _rescued_data STRING, ingestion_time TIMESTAMP, source_file STRING, source_system STRING,"
    " is_delayed BOOLEAN, is_recent BOOLEAN, latitude DOUBLE, longitude DOUBLE, city STRING"
)

FILE_MAPPING = struct("filenamePrefix STRING, sinkFolder STRING")


@dataclass(frozen=True)
class Table:
    """A gold table. ``widths`` are the serving lengths of its string columns."""

    name: str
    ddl: str
    keys: tuple[str, ...]
    partition_by: str | None = None
    widths: dict[str, int] = field(default_factory=dict)
    width: int = 200

    @property
    def schema(self) -> StructType:
        return struct(self.ddl)

    def columns_ddl(self) -> str:
        return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema)

    def serving_ddl(self) -> str:
        def serving_type(f):
            if f.dataType.simpleString() != "string":
                return f.dataType.simpleString()
            return f"varchar({self.widths.get(f.name, self.width)})"

        return ", ".join(f"`{f.name}` {serving_type(f)}" for f in self.schema)


DIM_PRODUCT = Table(
    "dim_product",
    "product_id STRING, product_name STRING, effective_date DATE, source STRING",
    keys=("product_id",),
    widths={"product_id": 50, "source": 100},
)
DIM_WAREHOUSE = Table(
    "dim_warehouse",
    "warehouse_id STRING, city STRING, effective_date DATE, source STRING",
    keys=("warehouse_id",),
)
FACT_INVENTORY_DAILY = Table(
    "fact_inventory_daily",
    "warehouse_id STRING, product_id STRING, quantity_in_stock INT, last_restock_date DATE,"
    " snapshot_date DATE, stock_status STRING",
    keys=("warehouse_id", "product_id", "snapshot_date"),
    partition_by="snapshot_date",
)
FACT_SALES_DAILY = Table(
    "fact_sales_daily",
    "warehouse_id STRING, product_id STRING, sale_date DATE, qty_sold BIGINT",
    keys=("warehouse_id", "product_id", "sale_date"),
    partition_by="sale_date",
)
FACT_SHIPMENTS = Table(
    "fact_shipments",
    "shipment_id STRING, warehouse_id STRING, status STRING, event_ts TIMESTAMP, event_date DATE,"
    " city STRING, delay_reason STRING, is_delayed BOOLEAN, is_recent BOOLEAN, latitude DOUBLE,"
    " longitude DOUBLE, source_file STRING",
    keys=("shipment_id", "event_date"),
    partition_by="event_date",
    widths={"source_file": 1024},
)
SUPPLYCHAIN_SNAPSHOT = Table(
    "supplychain_snapshot",
    "warehouse_id STRING, product_id STRING, product_name STRING, quantity_in_stock INT,"
    " stock_status STRING, shipment_id STRING, status STRING, location STRING, timestamp TIMESTAMP,"
    " delay_reason STRING, snapshot_date DATE",
    keys=("warehouse_id", "product_id", "shipment_id", "snapshot_date"),
    partition_by="snapshot_date",
)
ALERTS_SHIPMENTS = Table(
    "alerts_shipments",
    "shipment_id STRING, warehouse_id STRING, location STRING, delay_reason STRING,"
    " timestamp TIMESTAMP, event_date DATE",
    keys=("shipment_id", "event_date"),
    partition_by="event_date",
)

# Dimensions first: the serving load follows this order.
GOLD = (
    DIM_PRODUCT,
    DIM_WAREHOUSE,
    FACT_INVENTORY_DAILY,
    FACT_SALES_DAILY,
    FACT_SHIPMENTS,
    ALERTS_SHIPMENTS,
    SUPPLYCHAIN_SNAPSHOT,
)
