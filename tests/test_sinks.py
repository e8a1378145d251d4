from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from depotlake.plans import gold
from depotlake.schemas import (
    ALERTS_SHIPMENTS,
    DIM_PRODUCT,
    FACT_INVENTORY_DAILY,
    FACT_SALES_DAILY,
    FACT_SHIPMENTS,
    GOLD,
)
from depotlake.sinks import (
    apply_retention,
    ensure_tables,
    export,
    load_serving,
    overwrite_path,
    publish,
    read_export,
    replace_partition,
    replace_partitions,
    replace_table,
    upsert_table,
)
from depotlake.sources import delete_paths, path_exists, read_table
from tests.helpers import plan, rows

D1, D2, D3 = date(2025, 8, 29), date(2025, 8, 30), date(2025, 8, 31)


def inventory_day(spark, day, *quantities):
    found = [("WH1", f"P{i}", q, D1, day, "OK") for i, q in enumerate(quantities)]
    return spark.createDataFrame(found, FACT_INVENTORY_DAILY.schema)


def sales_rows(spark, *found):
    return spark.createDataFrame(list(found), FACT_SALES_DAILY.schema)


def test_ensure_tables_is_repeatable_and_matches_the_registry(spark, db):
    ensure_tables(spark, db)
    ensure_tables(spark, db)
    for table in GOLD:
        stored = spark.table(f"{db}.{table.name}")
        assert {f.name: f.dataType for f in stored.schema} == {f.name: f.dataType for f in table.schema}
        described = {r.col_name for r in spark.sql(f"DESCRIBE {db}.{table.name}").collect()}
        assert ("# Partition Information" in described) is (table.partition_by is not None)


def test_overwrite_path_replaces_rows_partitions_and_columns(spark, tmp_path):
    path = f"{tmp_path}/t"
    first = spark.createDataFrame([("WH1", 1), ("WH2", 2), (None, 3)], "warehouse_id string, a int")
    overwrite_path(first, path, ["warehouse_id"])
    assert rows(read_table(spark, path, first.schema)) == [(None, 3), ("WH1", 1), ("WH2", 2)]
    second = spark.createDataFrame([("WH1", 1, "x")], "warehouse_id string, a int, b string")
    overwrite_path(second, path, ["warehouse_id"])
    assert rows(read_table(spark, path, second.schema)) == [("WH1", 1, "x")]


def test_partitioned_writes_are_rebalanced(spark):
    from depotlake.sinks.tables import _rebalanced

    df = _rebalanced(spark.range(10).withColumn("d", F.col("id") % 2), ["d"])
    assert "REBALANCE_PARTITIONS_BY_COL" in plan(df)


def test_replace_partition_keeps_the_other_days_and_reruns(spark, db):
    table = FACT_INVENTORY_DAILY
    ensure_tables(spark, db, [table])
    replace_partition(inventory_day(spark, D1, 1, 2), db, table, D1)
    assert replace_partition(inventory_day(spark, D2, 3), db, table, D2) is None
    for _ in range(2):
        former = replace_partition(inventory_day(spark, D2, 4, 5), db, table, D2)
        assert path_exists(spark, former)
        delete_paths(spark, [former])
    stored = spark.table(f"{db}.{table.name}")
    assert rows(stored.select("snapshot_date", "quantity_in_stock")) == [(D1, 1), (D1, 2), (D2, 4), (D2, 5)]
    assert rows(stored.filter(F.col("snapshot_date") == D1).select("stock_status")) == [("OK",), ("OK",)]
    replace_partition(inventory_day(spark, D2), db, table, D2)
    assert rows(spark.table(f"{db}.{table.name}").select("snapshot_date").distinct()) == [(D1,)]


def test_replace_partition_refuses_rows_of_other_days(spark, db):
    table = FACT_INVENTORY_DAILY
    ensure_tables(spark, db, [table])
    replace_partition(inventory_day(spark, D1, 1), db, table, D1)
    with pytest.raises(Exception, match="row of"):
        replace_partition(inventory_day(spark, D2, 2), db, table, D1)
    assert rows(spark.table(f"{db}.{table.name}").select("quantity_in_stock")) == [(1,)]


def test_replace_partition_that_fails_leaves_the_former_rows(spark, db):
    table = FACT_INVENTORY_DAILY
    ensure_tables(spark, db, [table])
    replace_partition(inventory_day(spark, D1, 1), db, table, D1)
    broken = inventory_day(spark, D1, 2).withColumn(
        "stock_status", F.when(F.col("quantity_in_stock") == 2, F.raise_error(F.lit("stop"))).otherwise(F.lit("OK"))
    )
    with pytest.raises(Exception, match="stop"):
        replace_partition(broken, db, table, D1)
    assert rows(spark.table(f"{db}.{table.name}").select("quantity_in_stock")) == [(1,)]


def test_replace_partitions_is_by_name_and_dynamic(spark, db):
    table = FACT_INVENTORY_DAILY
    ensure_tables(spark, db, [table])
    both = inventory_day(spark, D1, 1).unionByName(inventory_day(spark, D2, 2))
    replace_partitions(both, db, table)
    with_static = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    replace_partitions(inventory_day(spark, D2, 7), db, table)
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == with_static
    stored = spark.table(f"{db}.{table.name}").select("snapshot_date", "quantity_in_stock", "stock_status")
    assert rows(stored) == [(D1, 1, "OK"), (D2, 7, "OK")]


def test_replace_table_from_itself(spark, db):
    table = DIM_PRODUCT
    ensure_tables(spark, db, [table])
    replace_table(spark.createDataFrame([("P1", "a", D1, "s")], table.schema), db, table)
    grown = spark.table(f"{db}.{table.name}").withColumn("product_name", F.lit("b"))
    delete_paths(spark, [replace_table(grown, db, table)])
    assert rows(spark.table(f"{db}.{table.name}")) == [("P1", "b", D1, "s")]


def test_upsert_table_unpartitioned_twice(spark, db):
    table = DIM_PRODUCT
    ensure_tables(spark, db, [table])
    for day, name in ((D1, "a"), (D2, "a"), (D3, "b")):
        source = spark.createDataFrame([("P1", name, day, "s"), ("P2", "z", day, "s")], table.schema)
        upsert_table(source, db, table, gold.attribute_changed("product_name"))
    assert rows(spark.table(f"{db}.{table.name}")) == [("P1", "b", D3, "s"), ("P2", "z", D1, "s")]


def test_upsert_table_touches_only_its_partitions(spark, db):
    table = FACT_SALES_DAILY
    ensure_tables(spark, db, [table])
    first = sales_rows(spark, ("WH1", "P1", D1, 1), ("WH1", "P1", D2, 2), ("WH1", "P2", D2, 3))
    replace_partitions(first, db, table)
    untouched = spark.table(f"{db}.{table.name}").filter(F.col("sale_date") == D1).inputFiles()
    for _ in range(2):
        upsert_table(sales_rows(spark, ("WH1", "P1", D2, 20), ("WH1", "P1", D3, 30)), db, table, update_cols=["qty_sold"])
    stored = spark.table(f"{db}.{table.name}")
    assert rows(stored.select("product_id", "sale_date", "qty_sold")) == [
        ("P1", D1, 1),
        ("P1", D2, 20),
        ("P1", D3, 30),
        ("P2", D2, 3),
    ]
    assert stored.filter(F.col("sale_date") == D1).inputFiles() == untouched


def test_upsert_table_into_several_and_new_partitions(spark, db):
    table = FACT_SALES_DAILY
    ensure_tables(spark, db, [table])
    replace_partitions(sales_rows(spark, *[("WH1", "P1", d, 1) for d in (D1, D2)]), db, table)
    upsert_table(sales_rows(spark, ("WH1", "P1", D2, 5), ("WH1", "P1", D3, 6)), db, table)
    assert rows(spark.table(f"{db}.{table.name}").select("sale_date", "qty_sold")) == [(D1, 1), (D2, 5), (D3, 6)]


def test_upsert_table_failure_changes_nothing(spark, db):
    table = FACT_SALES_DAILY
    ensure_tables(spark, db, [table])
    replace_partitions(sales_rows(spark, ("WH1", "P1", D1, 1)), db, table)
    with pytest.raises(Exception, match="repeats key"):
        upsert_table(sales_rows(spark, ("WH1", "P1", D1, 5), ("WH1", "P1", D1, 6)), db, table)
    assert rows(spark.table(f"{db}.{table.name}").select("qty_sold")) == [(1,)]


def test_upsert_table_needs_the_partition_in_the_key(spark, db):
    from dataclasses import replace

    table = replace(FACT_SALES_DAILY, keys=("warehouse_id", "product_id"))
    ensure_tables(spark, db, [table])
    with pytest.raises(ValueError, match="partition"):
        upsert_table(sales_rows(spark, ("WH1", "P1", D1, 5)), db, table)


def test_retention_removes_the_files_of_replaced_partitions(spark, db, tmp_path):
    table = FACT_INVENTORY_DAILY
    ensure_tables(spark, db, [table])
    replace_partition(inventory_day(spark, D1, 1), db, table, D1)
    replace_partition(inventory_day(spark, D3, 1), db, table, D3)
    apply_retention(spark, db, table, D3, keep_days=1)
    assert [p.name.split("-")[1] for p in (tmp_path / "db").glob("fact_inventory_daily-*")] == ["20250831"]


def test_retention_drops_whole_partitions(spark, db):
    table = FACT_SALES_DAILY
    ensure_tables(spark, db, [table])
    days = [D3 - timedelta(days=n) for n in (0, 90, 91, 200)]
    replace_partitions(sales_rows(spark, *[("WH1", "P1", d, 1) for d in days]), db, table)
    assert len(apply_retention(spark, db, table, D3)) == 2
    assert apply_retention(spark, db, table, D3) == []
    stored = spark.table(f"{db}.{table.name}")
    assert rows(stored.select("sale_date")) == sorted((d,) for d in days[:2])


SHIPMENT = ("S1", "WH1", "Delayed", datetime(2025, 8, 31, 1, 2, 3, 456789), D3, 'New "Delhi", x', " two\nlines ", True, None, 1.5, None, "f")


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_export_keeps_values(spark, tmp_path, fmt):
    df = spark.createDataFrame([SHIPMENT], FACT_SHIPMENTS.schema)
    export(df, f"{tmp_path}/x", fmt)
    export(df, f"{tmp_path}/x", fmt)
    assert rows(read_export(spark, f"{tmp_path}/x", fmt, FACT_SHIPMENTS)) == [SHIPMENT]


def test_export_file_count(spark, tmp_path):
    df = spark.range(100, numPartitions=5).selectExpr("cast(id as string) s")
    for files, expected in ((None, 5), (1, 1), (3, 3)):
        export(df, f"{tmp_path}/n", "parquet", files)
        assert len(list((tmp_path / "n").glob("*.parquet"))) == expected
    with pytest.raises(ValueError):
        export(df, f"{tmp_path}/n", "orc")


def filled(spark, db):
    ensure_tables(spark, db)
    replace_table(spark.createDataFrame([("P1", "a", D1, "s")], DIM_PRODUCT.schema), db, DIM_PRODUCT)
    replace_partitions(spark.createDataFrame([SHIPMENT], FACT_SHIPMENTS.schema), db, FACT_SHIPMENTS)


def test_publish_acknowledges_last_and_serving_loads(spark, db, tmp_path):
    filled(spark, db)
    out = f"{tmp_path}/gold"
    counts = {r.layer: r.row_count for r in publish(spark, db, out).collect()}
    assert len(counts) == 21
    assert counts["fact_shipments"] == counts["fact_shipments csv"] == counts["fact_shipments parquet"] == 1
    assert counts["alerts_shipments csv"] == 0
    marker = [p.read_text() for p in (tmp_path / "gold" / "_success").glob("*.txt")]
    assert "".join(marker).strip() == "acknowledged"
    spark.sql(f"CREATE DATABASE {db}_serving LOCATION '{tmp_path}/serving'")
    try:
        for _ in range(2):
            for table in GOLD:
                load_serving(spark, out, f"{db}_serving", table)
        assert rows(spark.table(f"{db}_serving.fact_shipments")) == [SHIPMENT]
        assert spark.table(f"{db}_serving.{ALERTS_SHIPMENTS.name}").count() == 0
        assert spark.sql(f"SHOW TABLES IN {db}_serving").filter("not isTemporary").count() == len(GOLD)
    finally:
        spark.sql(f"DROP DATABASE {db}_serving CASCADE")


def test_publish_without_a_full_export_does_not_acknowledge(spark, db, tmp_path, monkeypatch):
    import depotlake.sinks.publishing as module

    filled(spark, db)
    module.publish(spark, db, f"{tmp_path}/gold", files=1)
    assert path_exists(spark, f"{tmp_path}/gold/_success")
    real = module.export

    def losing(df, path, fmt, files=None):
        real(df.limit(0) if fmt == "csv" else df, path, fmt, files)

    monkeypatch.setattr(module, "export", losing)
    with pytest.raises(RuntimeError, match="csv"):
        module.publish(spark, db, f"{tmp_path}/gold")
    assert not path_exists(spark, f"{tmp_path}/gold/_success")


def test_serving_refuses_overlong_text_and_keeps_the_table(spark, db, tmp_path):
    out = f"{tmp_path}/gold"
    good = spark.createDataFrame([("P1", "a", D1, "s")], DIM_PRODUCT.schema)
    export(good, f"{out}/dim_product_parquet", "parquet")
    load_serving(spark, out, db, DIM_PRODUCT)
    export(good.withColumn("product_id", F.repeat(F.lit("x"), F.lit(51))), f"{out}/dim_product_parquet", "parquet")
    with pytest.raises(Exception, match="(?i)length"):
        load_serving(spark, out, db, DIM_PRODUCT)
    assert rows(spark.table(f"{db}.dim_product")) == [("P1", "a", D1, "s")]
    assert spark.sql(f"SHOW TABLES IN {db}").filter("not isTemporary").count() == 1


def test_only_the_days_at_hand_are_read(spark, db):
    """The merge and the snapshot prune partitions and columns of the stored tables."""
    from depotlake.sinks.tables import _touched_partitions

    ensure_tables(spark, db)
    replace_partitions(sales_rows(spark, *[("WH1", "P1", d, 1) for d in (D1, D2, D3)]), db, FACT_SALES_DAILY)
    target = _touched_partitions(spark.table(f"{db}.fact_sales_daily"), sales_rows(spark, ("WH1", "P1", D2, 1)), "sale_date", [str(D1), str(D2)])
    assert f"(sale_date#" in plan(target) and "PartitionFilters: [isnotnull(sale_date" in plan(target)
    assert len(target.inputFiles()) >= 1 and rows(target.select("sale_date")) == [(D2,)]
    snapshot = gold.supplychain_snapshot(
        spark.table(f"{db}.fact_inventory_daily"), spark.table(f"{db}.dim_product"), spark.table(f"{db}.fact_shipments"), D3
    )
    text = plan(snapshot)
    assert "PartitionFilters: [isnotnull(snapshot_date" in text
    assert "ReadSchema: struct<warehouse_id:string,product_id:string,quantity_in_stock:int,stock_status:string>" in text
    assert "ReadSchema: struct<product_id:string,product_name:string>" in text
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_partitions_are_listed_by_few_tasks(spark, tmp_path):
    spark.range(60).select(F.col("id"), F.concat(F.lit("WH"), "id").alias("warehouse_id")).write.partitionBy("warehouse_id").parquet(f"{tmp_path}/t")
    spark.sparkContext.setJobGroup("listing", "listing")
    try:
        found = read_table(spark, f"{tmp_path}/t")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    tracker = spark.sparkContext.statusTracker()
    stages = [s for job in tracker.getJobIdsForGroup("listing") for s in tracker.getJobInfo(job).stageIds]
    assert found.count() == 60 and max(tracker.getStageInfo(s).numTasks for s in stages) <= 16
