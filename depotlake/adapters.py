"""The driver's tables projected into the supply-chain domain, every row of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from depotlake.sources.tables import read_table_stream


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def inventory_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stock lines: the supplier is the warehouse. One product in fifty has no name."""
    lineitem = load(spark, sf_dir, "lineitem")
    part = load(spark, sf_dir, "part")
    return lineitem.join(part, F.col("l_partkey") == F.col("p_partkey")).select(
        F.concat(F.lit("wh"), F.col("l_suppkey") + 1).alias("warehouse_id"),
        F.concat(F.lit("prd"), "l_partkey").alias("product_id"),
        F.when(F.col("l_partkey") % 50 != 0, F.concat(F.lit(" "), "p_name", F.lit(" "))).alias("product_name"),
        F.when(F.col("l_linenumber") != 7, (F.col("l_quantity") * 4).cast("int")).alias("quantity_in_stock"),
        F.col("l_shipdate").cast("date").alias("last_restock_date"),
    )


def inventory_raw_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same lines as text in both date formats; line number 6 has an impossible date."""
    lineitem = load(spark, sf_dir, "lineitem")
    part = load(spark, sf_dir, "part")
    date_text = (
        F.when(F.col("l_linenumber") == 6, "13/45/2025")
        .when(F.col("l_orderkey") % 2 == 0, F.date_format("l_shipdate", "M/d/yyyy"))
        .otherwise(F.date_format("l_shipdate", "yyyy-MM-dd"))
    )
    return lineitem.join(part, F.col("l_partkey") == F.col("p_partkey")).select(
        F.concat(F.lit("wh"), F.col("l_suppkey") + 1).alias("warehouse_id"),
        F.concat(F.lit("prd"), "l_partkey").alias("product_id"),
        F.when(F.col("l_partkey") % 50 != 0, F.concat(F.lit(" "), "p_name", F.lit(" "))).alias("product_name"),
        F.when(F.col("l_linenumber") != 7, (F.col("l_quantity") * 4).cast("int"))
        .cast("string")
        .alias("quantity_in_stock"),
        date_text.alias("last_restock_date"),
    )


def sales_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines over ten products and five warehouses, so lines repeat and days add up."""
    return load(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_orderkey") % 97 != 0, F.concat(F.lit("ord"), "l_orderkey")).alias("order_id"),
        F.concat(F.lit("prd"), F.col("l_partkey") % 10).alias("product_id"),
        F.when(F.col("l_linenumber") != 7, F.col("l_quantity").cast("int")).alias("quantity_sold"),
        F.when(F.col("l_partkey") % 211 != 0, F.col("l_shipdate").cast("date")).alias("sale_date"),
        F.concat(F.lit("wh"), F.col("l_suppkey") % 5 + 1).alias("warehouse_id"),
    )


def shipments_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shipments_of(load(spark, sf_dir, "events"))


def events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a stream; the pattern lets it be one file or a folder of files."""
    schema = load(spark, sf_dir, "events").schema
    return read_table_stream(spark, f"{sf_dir}/events.parque[t]", schema)


def shipments_of(events: DataFrame, warehouses: int | None = None) -> DataFrame:
    """Four events per shipment; the user is the warehouse, one user in 37 has a bad id.

    ``warehouses`` folds the users into that many warehouses.
    """
    number = F.col("user_id") if warehouses is None else F.col("user_id") % warehouses
    event_id = F.col("event_id")
    status = (
        F.when(F.col("event_type") == "view", " In Transit ")
        .when(F.col("event_type") == "click", "IN TRANSIT")
        .when(F.col("event_type") == "error", "Delayed")
        .when(F.col("event_type") == "purchase", "delivered")
        .otherwise("lost")
    )
    coordinates = F.concat(
        (event_id % 16 + 12).cast("string"),
        F.lit(".5,"),
        (event_id % 16 + 72).cast("string"),
        F.lit(".25"),
    )
    location = F.when(event_id % 5 == 0, coordinates).when(event_id % 5 == 1, " new delhi ").otherwise("mumbai")
    ts = F.col("ts").cast("timestamp")
    return events.select(
        F.concat(F.lit(" sh"), event_id - event_id % 4).alias("shipment_id"),
        F.when(F.col("user_id") % 37 == 0, "X9")
        .otherwise(F.concat(F.lit("wh"), number + 1))
        .alias("warehouse_id"),
        status.alias("status"),
        location.alias("location"),
        ts.alias("timestamp"),
        F.when((F.col("event_type") == "error") & (event_id % 3 != 0), " Weather ").alias("delay_reason"),
        ts.alias("ingestion_time"),
    )


def warehouse_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One warehouse per supplier, in the city named after its nation."""
    supplier = load(spark, sf_dir, "supplier")
    nation = load(spark, sf_dir, "nation")
    return supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.concat(F.lit("WH"), F.col("s_suppkey") + 1).alias("warehouse_id"),
        F.col("n_name").alias("city"),
    )


def landing_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shipment events as landing fields with their day.

    Events in one city carry a field the schema does not know.
    """
    fields = shipments_raw(spark, sf_dir).drop("ingestion_time")
    return fields.withColumns(
        {
            "carrier": F.when(F.col("location") == "mumbai", "road"),
            "day": F.date_format("timestamp", "yyyyMMdd"),
            "timestamp": F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"),
        }
    )


def as_ntz(df: DataFrame) -> DataFrame:
    """Timestamps without zone, as the oracle has them."""
    return df.withColumns(
        {f.name: F.col(f.name).cast("timestamp_ntz") for f in df.schema if isinstance(f.dataType, TimestampType)}
    )
