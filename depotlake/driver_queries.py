"""One query per operator over the driver's tables; ``driver_oracles`` holds the same in SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from depotlake import adapters, schemas
from depotlake.config import Layout, apply_settings, conf, dated_path, scratch_dir
from depotlake.operators import (
    completeness_counts,
    expected_files,
    file_completeness,
    is_rejected,
    reconcile,
    upsert,
    write_balanced,
)
from depotlake.operators import grid
from depotlake.plans import gold, increments, lifecycle, run, silver
from depotlake.sinks import (
    apply_retention,
    create_bucketed,
    ensure_tables,
    export,
    load_serving,
    publish,
    publish_changed,
    read_export,
    replace_partition,
    replace_partitions,
    replace_table,
    upsert_bucketed,
    upsert_table,
)
from depotlake.sources import (
    delete_paths,
    list_files,
    make_folder,
    read_csv_by_name,
    read_file_mapping,
    read_table,
    read_table_stream,
    warehouse_mapping,
)
from depotlake.streaming import (
    ProgressTable,
    bronze_shipments,
    keep_late_rows,
    latest_state,
    latest_state_stream,
    latest_table_stream,
    progress_totals,
    read_derived,
    read_latest,
    run_stream,
    silver_shipments_stream,
    snapshot_stream,
    stream_report,
)

AS_OF = date(2024, 4, 15)
RUN_TS = datetime(2024, 1, 31)
# What the dimension already holds when the merge runs.
KNOWN_BEFORE = date(1995, 3, 1)

Query = Callable[[SparkSession, str], DataFrame]


# --- frames shared by the queries --------------------------------------------------------


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared scratch folder and read back: a table at rest between two jobs."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scratch_db(spark: SparkSession, tables: tuple[schemas.Table, ...] = ()) -> str:
    db = f"depotlake_{uuid.uuid4().hex}"
    ensure_tables(spark, db, tables, scratch_dir(spark, "db"))
    return db


def inventory(spark: SparkSession, sf: str) -> DataFrame:
    return silver.silver_inventory(adapters.inventory_raw(spark, sf), RUN_TS)


def sales(spark: SparkSession, sf: str) -> DataFrame:
    return silver.silver_sales(adapters.sales_raw(spark, sf), RUN_TS)


def bronze_of(raw: DataFrame) -> DataFrame:
    bronze = silver.standardise_shipments(raw, F.col("ingestion_time"))
    nothing = F.lit(None).cast("string")
    return bronze.withColumns({"_rescued_data": nothing, "source_file": nothing})


def bronze(spark: SparkSession, sf: str) -> DataFrame:
    return bronze_of(adapters.shipments_raw(spark, sf))


def shipments(spark: SparkSession, sf: str) -> DataFrame:
    """Silver as the stream appends it: every valid event, the newest is chosen in gold."""
    return silver.describe_shipments(silver.valid_shipments(bronze(spark, sf)), RUN_TS)


def shipment_facts(spark: SparkSession, sf: str) -> DataFrame:
    return gold.fact_shipments(shipments(spark, sf), AS_OF)


def landing_folder(spark: SparkSession, sf: str) -> str:
    path = scratch_dir(spark, "landing")
    events = adapters.landing_events(spark, sf).hint("rebalance", F.col("day"))
    events.write.partitionBy("day").json(path)
    return path


# --- silver ------------------------------------------------------------------------------


def silver_inventory(spark, sf):
    return adapters.as_ntz(inventory(spark, sf))


def silver_inventory_text_dates(spark, sf):
    return adapters.as_ntz(silver.silver_inventory(adapters.inventory_raw_text(spark, sf), RUN_TS))


def silver_sales(spark, sf):
    return adapters.as_ntz(sales(spark, sf))


def quarantine(spark, sf):
    return silver.quarantine(adapters.inventory_raw_text(spark, sf), adapters.sales_raw(spark, sf))


def quarantine_shipments(spark, sf):
    """Events of one minute of the hour carry a text that is no time."""
    ts = F.col("timestamp")
    text = F.when(F.minute(ts) == 7, "soon").otherwise(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
    raw = adapters.shipments_raw(spark, sf).withColumn("timestamp", text)
    run_ts = F.col("ingestion_time")
    return adapters.as_ntz(silver.quarantine_shipments(silver.standardise_shipments(raw, run_ts)))


def shipment_standardise(spark, sf):
    return adapters.as_ntz(bronze(spark, sf).drop("_rescued_data", "source_file"))


def shipment_status(spark, sf):
    described = silver.describe_shipments(bronze(spark, sf), RUN_TS)
    return adapters.as_ntz(described.select("shipment_id", "timestamp", "status", "is_delayed"))


def shipment_location(spark, sf):
    described = silver.describe_shipments(bronze(spark, sf), RUN_TS)
    return adapters.as_ntz(described.select("shipment_id", "timestamp", "latitude", "longitude", "city"))


def shipment_recent(spark, sf):
    described = silver.describe_shipments(bronze(spark, sf), RUN_TS)
    return adapters.as_ntz(described.select("shipment_id", "timestamp", "is_recent"))


def _without_lineage(df: DataFrame) -> DataFrame:
    return adapters.as_ntz(df.drop("_rescued_data", "source_file"))


def silver_shipments(spark, sf):
    return _without_lineage(silver.silver_shipments(bronze(spark, sf), RUN_TS))


def silver_shipments_parity(spark, sf):
    return _without_lineage(silver.silver_shipments(bronze(spark, sf), RUN_TS, parity=True))


# --- gold --------------------------------------------------------------------------------


def fact_inventory_daily(spark, sf):
    return gold.fact_inventory_daily(inventory(spark, sf), AS_OF)


def low_stock_topk(spark, sf):
    return gold.low_stock_top(fact_inventory_daily(spark, sf))


def fact_sales_daily(spark, sf):
    return gold.fact_sales_daily(sales(spark, sf))


def sales_upsert(spark, sf):
    daily = staged(fact_sales_daily(spark, sf), "daily")
    target = daily.filter(F.col("sale_date") < date(1999, 1, 1))
    source = daily.filter(F.col("sale_date") >= date(1998, 1, 1)).withColumn("qty_sold", F.col("qty_sold") + 1)
    return upsert(target, source, schemas.FACT_SALES_DAILY.keys, update_cols=["qty_sold"])


def sales_incremental(spark, sf):
    """Daily sales after a late correction of quantities and days that comes twice, by differences only."""
    table = schemas.FACT_SALES_DAILY
    db, state = scratch_db(spark, (table,)), scratch_dir(spark, "sales-state")
    # Folded into three weeks, as a daily job's lines lie in few days.
    folded = F.date_add(F.lit(date(1998, 1, 1)), F.dayofyear("sale_date") % 21)
    lines = staged(sales(spark, sf).withColumn("sale_date", folded), "sales")
    number = F.substring("order_id", 4, 20).cast("long")
    more = lines.filter(number % 5 == 0).withColumn("quantity_sold", F.col("quantity_sold") + 7)
    later = lines.filter(number % 7 == 0).withColumn("sale_date", F.date_add("sale_date", 3))
    for step in (lines, more.unionByName(later), more):
        increments.merge_sales(spark, step, db, state)
    return spark.table(f"{db}.{table.name}")


def dim_product_scd1(spark, sf):
    table = schemas.DIM_PRODUCT
    db = scratch_db(spark, (table,))
    stock = staged(inventory(spark, sf), "inventory")
    before = stock.filter(F.col("last_restock_date") < KNOWN_BEFORE)
    replace_table(gold.product_source(before, date(2024, 1, 1)), db, table)
    renamed = F.when(F.col("product_name").endswith("ring"), F.concat("product_name", F.lit(" v2")))
    now = stock.withColumn("product_name", F.coalesce(renamed, "product_name"))
    upsert_table(gold.product_source(now, AS_OF), db, table, gold.attribute_changed("product_name"))
    return spark.table(f"{db}.{table.name}")


def dim_product_bucketed(spark, sf):
    """The same merge into a target that is stored in buckets of its key."""
    table = schemas.DIM_PRODUCT
    db = scratch_db(spark)
    create_bucketed(spark, db, table, 8)
    stock = staged(inventory(spark, sf), "inventory")
    before = stock.filter(F.col("last_restock_date") < KNOWN_BEFORE)
    upsert_bucketed(gold.product_source(before, date(2024, 1, 1)), db, table)
    renamed = F.when(F.col("product_name").endswith("ring"), F.concat("product_name", F.lit(" v2")))
    now = stock.withColumn("product_name", F.coalesce(renamed, "product_name"))
    upsert_bucketed(gold.product_source(now, AS_OF), db, table, gold.attribute_changed("product_name"))
    return spark.table(f"{db}.{table.name}")


def dim_warehouse_scd1(spark, sf):
    table = schemas.DIM_WAREHOUSE
    db = scratch_db(spark, (table,))
    mapping = adapters.warehouse_map(spark, sf)
    known = mapping.filter(F.col("warehouse_id") < "WH5").withColumn(
        "city", F.when(F.col("city") < "NATION_2", F.concat(F.lit("Old "), "city")).otherwise(F.col("city"))
    )
    replace_table(gold.warehouse_source(known, date(2024, 1, 1)), db, table)
    upsert_table(gold.warehouse_source(mapping, AS_OF), db, table, gold.attribute_changed("city"))
    return spark.table(f"{db}.{table.name}")


def fact_shipments(spark, sf):
    return adapters.as_ntz(shipment_facts(spark, sf).drop("source_file"))


def fact_shipments_upsert(spark, sf):
    table = schemas.FACT_SHIPMENTS
    db = scratch_db(spark, (table,))
    # One row per shipment and day, as several daily runs leave them behind.
    states = staged(shipments(spark, sf), "shipments")
    day = F.col("timestamp").cast("date")
    earlier = states.filter(day < date(2024, 1, 20))
    later = states.filter(day >= date(2024, 1, 10)).withColumn("delay_reason", F.lit("Restated"))
    replace_partitions(_per_day(earlier), db, table)
    upsert_table(_per_day(later), db, table)
    return adapters.as_ntz(spark.table(f"{db}.{table.name}").drop("source_file"))


def _per_day(states: DataFrame) -> DataFrame:
    """The last state of each shipment on each day."""
    rows = gold.shipment_columns(states)
    return gold.latest_by(rows, schemas.FACT_SHIPMENTS.keys, ["event_ts"])


def supplychain_snapshot(spark, sf, cell_rows=grid.CELL_ROWS):
    stock = staged(inventory(spark, sf), "inventory")
    snapshot = gold.supplychain_snapshot(
        gold.fact_inventory_daily(stock, AS_OF),
        gold.product_source(stock, AS_OF),
        staged(shipment_facts(spark, sf), "fact_shipments"),
        AS_OF,
        cell_rows,
    )
    return adapters.as_ntz(snapshot)


def supplychain_snapshot_hot(spark, sf):
    """Cells so small that every warehouse is a hot key and is cut into a grid."""
    return supplychain_snapshot(spark, sf, cell_rows=8)


def alerts_shipments(spark, sf):
    return adapters.as_ntz(gold.alerts_shipments(shipment_facts(spark, sf)))


def retention_purge(spark, sf):
    table = schemas.FACT_SHIPMENTS
    db = scratch_db(spark, (table,))
    replace_partitions(_per_day(shipments(spark, sf)), db, table)
    apply_retention(spark, db, table, AS_OF, gold.KEEP_DAYS)
    return adapters.as_ntz(spark.table(f"{db}.{table.name}").drop("source_file"))


def partition_overwrite(spark, sf):
    table = schemas.FACT_INVENTORY_DAILY
    db = scratch_db(spark, (table,))
    stock = staged(inventory(spark, sf), "inventory")
    days = (AS_OF - timedelta(days=1), AS_OF)
    for day in days:
        replace_partition(gold.fact_inventory_daily(stock, day), db, table, day)
    replace_partition(gold.fact_inventory_daily(stock, AS_OF, low_stock_below=100), db, table, AS_OF)
    return spark.table(f"{db}.{table.name}")


# --- streams -----------------------------------------------------------------------------


def _finished(query):
    query.awaitTermination()
    return query


def _bronze_stream(spark: SparkSession, sf: str):
    out = scratch_dir(spark, "bronze")
    rows = bronze_shipments(spark, landing_folder(spark, sf), multiline=False, run_ts=RUN_TS)
    query = run_stream(rows, out, scratch_dir(spark, "checkpoint"), name="shipments_bronze")
    return out, _finished(query)


def stream_bronze(spark, sf):
    out, _ = _bronze_stream(spark, sf)
    return adapters.as_ntz(spark.read.schema(schemas.BRONZE_SHIPMENTS).parquet(out).drop("source_file"))


def stream_report_bronze(spark, sf):
    _, query = _bronze_stream(spark, sf)
    return stream_report(spark, [query]).select(
        "name", "is_active", "recent_input_rows", "recent_rows_dropped_late"
    )


def _deduplicated(spark: SparkSession, sf: str, mode: str) -> DataFrame:
    # Five warehouses, as the silver folder is partitioned by them.
    events = bronze_of(adapters.shipments_of(adapters.events_stream(spark, sf), warehouses=5))
    rows = silver_shipments_stream(events, mode)
    out = scratch_dir(spark, f"silver-{mode}")
    _finished(run_stream(rows, out, scratch_dir(spark, "checkpoint"), partition_by=["warehouse_id"]))
    return spark.read.schema(schemas.SILVER_SHIPMENTS).parquet(out)


def stream_dedup_first(spark, sf):
    return _deduplicated(spark, sf, "first").select("shipment_id")


def stream_dedup_within_watermark(spark, sf):
    return _deduplicated(spark, sf, "within_watermark").select("shipment_id")


def stream_latest_state(spark, sf):
    events = bronze_of(adapters.shipments_of(adapters.events_stream(spark, sf)))
    rows = silver_shipments_stream(events, "none", run_ts=RUN_TS)
    out = scratch_dir(spark, "latest")
    _finished(latest_state_stream(rows, out, scratch_dir(spark, "checkpoint")))
    return _without_lineage(latest_state(spark, out, schemas.SILVER_SHIPMENTS))


def _in_steps(spark: SparkSession, steps: list[DataFrame], start) -> None:
    """Land one step after the other and run the stream after each, so micro-batches follow their order."""
    landing, schema = scratch_dir(spark, "steps"), steps[0].schema
    make_folder(spark, landing)
    for step in steps:
        step.write.mode("append").parquet(landing)
        _finished(start(read_table_stream(spark, landing, schema)))


def _arriving(spark: SparkSession, sf: str) -> list[DataFrame]:
    """The bronze events in four steps, in which the events of a shipment come in another order than they happened."""
    events = adapters.load(spark, sf, "events")
    steps = [adapters.shipments_of(events.where(F.col("event_id") % 4 == k)) for k in (2, 0, 3, 1)]
    return [bronze_of(step) for step in steps]


def stream_latest_table(spark, sf):
    """One row per shipment at rest after four micro-batches with events out of order."""
    out, checkpoint = scratch_dir(spark, "latest-table"), scratch_dir(spark, "checkpoint")

    def start(bronze_rows):
        return latest_table_stream(silver_shipments_stream(bronze_rows, "none", run_ts=RUN_TS), out, checkpoint)

    _in_steps(spark, _arriving(spark, sf), start)
    return _without_lineage(read_latest(spark, out, schemas.SILVER_SHIPMENTS))


def stream_late_rows(spark, sf):
    """Events that come after the watermark has passed them, beside those that were kept: all of them."""
    events = adapters.load(spark, sf, "events")

    def step(k: int) -> DataFrame:
        # Each event is a shipment of its own here.
        part = events.where(F.col("event_id") % 3 == k)
        return bronze_of(adapters.shipments_of(part.withColumn("event_id", F.col("event_id") * 4)))

    out, late, checkpoint = (scratch_dir(spark, name) for name in ("kept", "late", "checkpoint"))
    _in_steps(spark, [step(k) for k in range(3)], lambda rows: run_stream(silver_shipments_stream(rows, "first"), out, checkpoint))
    schema = step(0).schema
    keep_late_rows(spark, checkpoint, late, lambda files: silver.valid_shipments(spark.read.schema(schema).parquet(*files)))
    kept = spark.read.schema(schemas.SILVER_SHIPMENTS).parquet(out)
    dropped = spark.read.schema(schema).parquet(late)
    one = lambda rows, is_late: rows.select("shipment_id", "timestamp", F.lit(is_late).alias("is_late"))
    return adapters.as_ntz(one(kept, False).unionByName(one(dropped, True)))


def stream_dedup_returning(spark, sf):
    """What both modes keep of shipments that come again a day later, after the watermark has passed most of them."""
    events = adapters.load(spark, sf, "events")

    def step(k: int) -> DataFrame:
        part = events.where(F.least(F.col("event_id") % 4, F.lit(2)) == k)
        hour = F.expr("make_dt_interval(0, cast(div(event_id, 4) % 20 AS INT))")
        return bronze_of(adapters.shipments_of(part.withColumn("ts", F.lit(datetime(2024, 1, 1 + k)) + hour)))

    found = []
    for mode in ("first", "within_watermark"):
        out, checkpoint = scratch_dir(spark, f"returning-{mode}"), scratch_dir(spark, "checkpoint")
        _in_steps(spark, [step(k) for k in range(3)], lambda rows: run_stream(silver_shipments_stream(rows, mode), out, checkpoint))  # noqa: B023
        kept = spark.read.schema(schemas.SILVER_SHIPMENTS).parquet(out)
        found.append(kept.select(F.lit(mode).alias("mode"), "shipment_id", (F.dayofmonth("timestamp") - 1).alias("step")))
    return found[0].unionByName(found[1])


def stream_progress_totals(spark, sf):
    """The rows of all micro-batches of a stream of which Spark itself remembers two."""
    path, out = scratch_dir(spark, "progress"), scratch_dir(spark, "bronze")
    landing = landing_folder(spark, sf)
    # About seven micro-batches, whatever the number of files.
    files = -(-list_files(spark, landing, "*.json").count() // 7)
    progress = ProgressTable(spark, path)
    spark.streams.addListener(progress)
    with conf(spark, spark__sql__streaming__numRecentProgressUpdates="2"):
        rows = bronze_shipments(spark, landing, multiline=False, max_files=files, run_ts=RUN_TS)
        query = _finished(run_stream(rows, out, scratch_dir(spark, "checkpoint"), name="bronze_in_steps"))
    progress.wait_for(query)
    spark.streams.removeListener(progress)
    totals = progress_totals(spark, path)
    return totals.select("name", "input_rows", "rows_dropped_late", (F.col("batches") > 2).alias("beyond_memory"))


def bronze_lineage(spark, sf):
    """The file each bronze row came from: its dated folder."""
    out, _ = _bronze_stream(spark, sf)
    day = F.regexp_extract("source_file", "/day=([0-9]{8})/[^/]+$", 1)
    return adapters.as_ntz(spark.read.schema(schemas.BRONZE_SHIPMENTS).parquet(out).select("shipment_id", "timestamp", day.alias("source_day")))


def stream_snapshot(spark, sf):
    """The snapshot kept up by joining each micro-batch's shipments with the stock of the day."""
    out, snapshot, checkpoint, at = (scratch_dir(spark, name) for name in ("latest", "snapshot", "checkpoint", "inventory"))
    # What a table was made of goes once it is at rest: its shuffle files, and the inventory.
    with conf(spark, spark__sql__classic__shuffleDependency__fileCleanup__enabled="true"):
        inventory(spark, sf).write.parquet(at)
        stock = read_table(spark, at, schemas.SILVER_INVENTORY)
        facts = staged(gold.fact_inventory_daily(stock, AS_OF), "stock")
        products = staged(gold.product_source(stock, AS_OF), "products")
    delete_paths(spark, [at])

    def start(bronze_rows):
        rows = silver_shipments_stream(bronze_rows, "none", run_ts=RUN_TS)
        return snapshot_stream(rows, facts, products, AS_OF, out, snapshot, checkpoint)

    _in_steps(spark, _arriving(spark, sf), start)
    return adapters.as_ntz(read_derived(spark, snapshot, schemas.SUPPLYCHAIN_SNAPSHOT.schema))


# --- files -------------------------------------------------------------------------------


def _arrivals(spark: SparkSession, sf: str) -> DataFrame:
    """A file is expected from each warehouse for each day, and found where it sold something."""
    events = adapters.load(spark, sf, "events").select(
        F.concat(F.lit("wh"), F.col("user_id") + 1, F.lit("_")).alias("filenamePrefix"),
        F.col("ts").cast("date").alias("day"),
        "event_type",
    )
    expected = expected_files(events.select("filenamePrefix", "day").distinct(), F.col("day"))
    found = expected_files(events.filter(F.col("event_type") == "purchase"), F.col("day"))
    return file_completeness(expected, found)


def file_completeness_by_name(spark, sf):
    return _arrivals(spark, sf).select("file_name", "is_present")


def file_completeness_counts(spark, sf):
    return completeness_counts(_arrivals(spark, sf), ["day"])


def ingest_roundtrip(spark, sf):
    landing, bronze_root = scratch_dir(spark, "landing"), scratch_dir(spark, "bronze")
    mapping_path = scratch_dir(spark, "mapping")
    mapping = '[{"filenamePrefix": "salesorder_", "sinkFolder": "salesorder"}]'
    spark.createDataFrame([(mapping,)], "value STRING").write.text(mapping_path)
    raw = adapters.sales_raw(spark, sf)
    raw.write.option("header", True).csv(f"{landing}/salesorder_{AS_OF:%Y%m%d}.csv")
    written = lifecycle.ingest_landing(
        spark, landing, read_file_mapping(spark, mapping_path), AS_OF, bronze_root
    )
    return read_csv_by_name(spark, list(written.values()), schemas.SALES_CSV)


def ingest_by_header(spark, sf):
    """Two files that hold half of the lines each, in different column order."""
    raw = adapters.sales_raw(spark, sf)
    halves = []
    for half, columns in enumerate((raw.columns, raw.columns[::-1])):
        halves.append(scratch_dir(spark, "half"))
        own = raw.filter(F.pmod(F.xxhash64(*raw.columns), F.lit(2)) == half)
        own.select(*columns).write.option("header", True).csv(halves[-1])
    return read_csv_by_name(spark, halves, schemas.SALES_CSV)


def silver_job(spark, sf):
    """Landed files through ingest and the silver job: dated paths, folders by warehouse, both entities."""
    layout = Layout(scratch_dir(spark, "lake"))
    for raw, prefix in ((adapters.inventory_raw_text(spark, sf), "inventory_"), (adapters.sales_raw(spark, sf), "salesorder_")):
        lifecycle.write_quoted_csv(raw, dated_path(layout.landing_batch, prefix, AS_OF))
    mapping = spark.createDataFrame([("inventory_", "inventory"), ("salesorder_", "salesorder")], schemas.FILE_MAPPING)
    lifecycle.ingest_landing(spark, layout.landing_batch, mapping, AS_OF, layout.bronze_batch_root)
    run.run_silver(spark, layout, AS_OF, RUN_TS)
    stock = read_table(spark, layout.silver_inventory, schemas.SILVER_INVENTORY)
    lines = read_table(spark, layout.silver_sales, schemas.SILVER_SALES)
    return stock.select(
        F.lit(None).cast("string").alias("order_id"), "product_id", "warehouse_id", F.col("quantity_in_stock").alias("quantity"), F.col("last_restock_date").alias("day")
    ).unionByName(lines.select("order_id", "product_id", "warehouse_id", F.col("quantity_sold").alias("quantity"), F.col("sale_date").alias("day")))


def sales_by_city(spark, sf):
    """Units per city by the built-in warehouse map, through the view that SQL users see."""
    warehouse_mapping(spark)
    sales(spark, sf).createOrReplaceTempView("sales_of_the_day")
    return spark.sql(
        "SELECT city, sum(quantity_sold) AS units, count(*) AS lines"
        " FROM sales_of_the_day JOIN warehouse_mapping USING (warehouse_id) GROUP BY city"
    )


def ingest_quoted_breaks(spark, sf):
    """A landed file of notes over several lines, whose splits end inside of its records."""
    landing, bronze_root = scratch_dir(spark, "landing"), scratch_dir(spark, "bronze")
    raw = adapters.sales_raw(spark, sf)
    note = F.concat(F.lit('said "'), "product_id", F.lit('",\nthen\n\n'), F.coalesce("order_id", F.lit('"')))
    lifecycle.write_quoted_csv(raw.withColumn("note", note), f"{landing}/salesorder_{AS_OF:%Y%m%d}.csv")
    mapping = spark.createDataFrame([("salesorder_", "salesorder")], schemas.FILE_MAPPING)
    # So small that the files of any scale have many splits.
    with conf(spark, spark__sql__files__maxPartitionBytes="256k"):
        written = lifecycle.ingest_landing(spark, landing, mapping, AS_OF, bronze_root)
    noted = StructType([*schemas.SALES_CSV, StructField("note", StringType())])
    return read_csv_by_name(spark, list(written.values()), noted)


def archive_batch(spark, sf):
    """The day's landed file and one that no mapping names, copied and then deleted."""
    landing, dest = scratch_dir(spark, "landing"), scratch_dir(spark, "archive")
    raw = adapters.sales_raw(spark, sf)
    even = F.coalesce(F.col("quantity_sold") % 2 == 0, F.lit(False))
    for name, own in ((f"salesorder_{AS_OF:%Y%m%d}.csv", even), ("returns_late.csv", ~even)):
        raw.filter(own).write.option("header", True).csv(f"{landing}/{name}")
    mapping = spark.createDataFrame([("salesorder_", "salesorder")], schemas.FILE_MAPPING)
    written = lifecycle.archive_batch(spark, landing, mapping, dest, AS_OF, purge=True)
    left = list_files(spark, landing, "*.csv").count()
    found = [
        read_csv_by_name(spark, path, schemas.SALES_CSV).withColumn("folder", F.lit(path.split("/")[-2]))
        for path in written
    ]
    return reduce(DataFrame.unionByName, found).withColumn("left_in_landing", F.lit(left))


def publish_counts(spark, sf):
    """The export's counts per layer and the acknowledgement that follows them."""
    table = schemas.FACT_SHIPMENTS
    db, out = scratch_db(spark, (table,)), scratch_dir(spark, "published")
    replace_partitions(_per_day(shipments(spark, sf)), db, table)
    counts = publish(spark, db, out, (table,))
    said = spark.read.text(f"{out}/_success").select(F.col("value").alias("layer"), F.lit(1).alias("row_count"))
    return counts.unionByName(said)


def publish_incremental(spark, sf):
    """Two publications with one day restated and one gone between them: what each wrote, and what lies there."""
    table = schemas.FACT_SHIPMENTS
    db, out = scratch_db(spark, (table,)), scratch_dir(spark, "published")
    facts = staged(_per_day(shipments(spark, sf)), "facts")
    replace_partitions(facts, db, table)
    reports = [publish_changed(spark, db, out, (table,)), publish_changed(spark, db, out, (table,))]
    restated = facts.filter(F.col("event_date") == date(2024, 1, 12)).withColumn("delay_reason", F.lit("Restated"))
    replace_partitions(restated, db, table)
    spark.sql(f"ALTER TABLE {db}.{table.name} DROP IF EXISTS PARTITION (event_date = DATE '2024-01-05')")
    reports.append(publish_changed(spark, db, out, (table,)))
    written = [
        r.select(F.concat_ws(" ", F.lit(f"publication {k}"), "layer").alias("what"), "row_count", "parts_written")
        for k, r in enumerate(reports)
    ]
    left = [
        read_export(spark, f"{out}/{folder}", fmt, table)
        .groupBy(F.concat_ws(" ", F.lit(fmt), F.col("event_date").cast("string")).alias("what"))
        .agg(F.count("*").alias("row_count"), F.count_if(F.col("delay_reason") == "Restated").alias("parts_written"))
        for fmt, folder in (("csv", f"tables/{table.name}"), ("parquet", f"{table.name}_parquet"))
    ]
    return reduce(DataFrame.unionByName, written + left)


def archive_events(spark, sf):
    dest = scratch_dir(spark, "archive")
    lifecycle.archive_events(spark, landing_folder(spark, sf), dest, date(2024, 1, 15), multiline=False)
    return lifecycle.read_archive(spark, dest).select(
        "ingest_date", F.get_json_object("value", "$.timestamp").alias("event_time")
    )


def _export_roundtrip(spark: SparkSession, sf: str, fmt: str) -> DataFrame:
    table = schemas.FACT_SHIPMENTS
    out = scratch_dir(spark, f"export-{fmt}")
    export(shipment_facts(spark, sf), out, fmt)
    return adapters.as_ntz(read_export(spark, out, fmt, table).drop("source_file"))


def export_roundtrip_csv(spark, sf):
    return _export_roundtrip(spark, sf, "csv")


def export_roundtrip_parquet(spark, sf):
    return _export_roundtrip(spark, sf, "parquet")


def serving_load(spark, sf):
    table = schemas.FACT_SHIPMENTS
    out = scratch_dir(spark, "export")
    db = scratch_db(spark)
    export(shipment_facts(spark, sf), f"{out}/{table.name}_parquet", "parquet")
    load_serving(spark, out, db, table)
    return adapters.as_ntz(spark.table(f"{db}.{table.name}").drop("source_file"))


def reconcile_layers(spark, sf):
    """The balance of both silver writes, taken while they run: one scan of the raw rows of each."""

    def balance(entity, raw, rules, make):
        out = scratch_dir(spark, entity)
        kept = lambda seen: make(seen, RUN_TS, counted=True)
        write = lambda rows: rows.write.parquet(out)
        return write_balanced(entity, raw, is_rejected(rules(raw)), kept, write, lambda: spark.read.parquet(out))

    stock, lines = adapters.inventory_raw(spark, sf), adapters.sales_raw(spark, sf)
    found = balance("inventory", stock, silver.inventory_rules, silver.silver_inventory)
    return found.unionByName(balance("sales", lines, silver.sales_rules, silver.silver_sales))


def reconcile_recount(spark, sf):
    """The same balance counted again from all rows, as it is settled where the first looks wrong."""
    stock, lines = adapters.inventory_raw(spark, sf), adapters.sales_raw(spark, sf)
    kept_stock, _ = silver.split_inventory(stock)
    kept_lines, _ = silver.split_sales(lines)
    return reconcile(
        "inventory",
        stock,
        is_rejected(silver.inventory_rules(stock)),
        silver.clean_inventory(kept_stock),
        inventory(spark, sf),
        silver.INVENTORY_KEYS,
    ).unionByName(
        reconcile(
            "sales",
            lines,
            is_rejected(silver.sales_rules(lines)),
            silver.clean_sales(kept_lines),
            sales(spark, sf),
            silver.SALES_KEYS,
        )
    )


QUERIES: dict[str, Query] = {
    "silver_inventory": silver_inventory,
    "silver_inventory_text_dates": silver_inventory_text_dates,
    "silver_sales": silver_sales,
    "quarantine": quarantine,
    "quarantine_shipments": quarantine_shipments,
    "shipment_standardise": shipment_standardise,
    "shipment_status": shipment_status,
    "shipment_location": shipment_location,
    "shipment_recent": shipment_recent,
    "silver_shipments": silver_shipments,
    "silver_shipments_parity": silver_shipments_parity,
    "fact_inventory_daily": fact_inventory_daily,
    "low_stock_topk": low_stock_topk,
    "fact_sales_daily": fact_sales_daily,
    "sales_upsert": sales_upsert,
    "sales_incremental": sales_incremental,
    "dim_product_scd1": dim_product_scd1,
    "dim_product_bucketed": dim_product_bucketed,
    "dim_warehouse_scd1": dim_warehouse_scd1,
    "fact_shipments": fact_shipments,
    "fact_shipments_upsert": fact_shipments_upsert,
    "supplychain_snapshot": supplychain_snapshot,
    "supplychain_snapshot_hot": supplychain_snapshot_hot,
    "alerts_shipments": alerts_shipments,
    "retention_purge": retention_purge,
    "partition_overwrite": partition_overwrite,
    "stream_bronze": stream_bronze,
    "stream_dedup_first": stream_dedup_first,
    "stream_dedup_within_watermark": stream_dedup_within_watermark,
    "stream_latest_state": stream_latest_state,
    "stream_latest_table": stream_latest_table,
    "stream_late_rows": stream_late_rows,
    "stream_dedup_returning": stream_dedup_returning,
    "stream_progress_totals": stream_progress_totals,
    "stream_snapshot": stream_snapshot,
    "bronze_lineage": bronze_lineage,
    "stream_report": stream_report_bronze,
    "file_completeness": file_completeness_by_name,
    "file_completeness_counts": file_completeness_counts,
    "ingest_roundtrip": ingest_roundtrip,
    "ingest_by_header": ingest_by_header,
    "ingest_quoted_breaks": ingest_quoted_breaks,
    "silver_job": silver_job,
    "sales_by_city": sales_by_city,
    "archive_batch": archive_batch,
    "publish_counts": publish_counts,
    "publish_incremental": publish_incremental,
    "archive_events": archive_events,
    "export_roundtrip_csv": export_roundtrip_csv,
    "export_roundtrip_parquet": export_roundtrip_parquet,
    "serving_load": serving_load,
    "reconcile": reconcile_layers,
    "reconcile_recount": reconcile_recount,
}


def queries() -> dict[str, Query]:
    """The queries, each with the settings its result depends on."""

    def with_settings(query: Query) -> Query:
        return lambda spark, sf_dir: query(apply_settings(spark), sf_dir)

    return {name: with_settings(query) for name, query in QUERIES.items()}
