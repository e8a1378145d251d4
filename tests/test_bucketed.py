"""Merges into bucketed targets: the rows of any merge, and one exchange."""

from datetime import date

import pytest

from depotlake.plans import gold
from depotlake.schemas import DIM_PRODUCT, FACT_SALES_DAILY
from depotlake.sinks import create_bucketed, ensure_tables, merged_in_buckets, upsert_bucketed, upsert_table
from tests.helpers import plan, rows

D = date(2025, 8, 31)


def products(spark, *found):
    return spark.createDataFrame([(i, n, D, "s") for i, n in found], DIM_PRODUCT.schema)


def test_rows_are_those_of_the_plain_merge(spark, db):
    create_bucketed(spark, db, DIM_PRODUCT, 3)
    create_bucketed(spark, db, DIM_PRODUCT, 3)
    ensure_tables(spark, f"{db}_plain", [DIM_PRODUCT])
    try:
        for step in ([("P1", "a"), ("P2", None), ("P3", "c")], [], [("P1", "b"), ("P2", "x"), ("P4", "d")], [("P1", None)]):
            former = upsert_bucketed(products(spark, *step), db, DIM_PRODUCT, gold.attribute_changed("product_name"))
            assert former
            upsert_table(products(spark, *step), f"{db}_plain", DIM_PRODUCT, gold.attribute_changed("product_name"))
            assert rows(spark.table(f"{db}.dim_product")) == rows(spark.table(f"{db}_plain.dim_product"))
    finally:
        spark.sql(f"DROP DATABASE {db}_plain CASCADE")
    assert spark.sql(f"SHOW TABLES IN {db}").where("not isTemporary").count() == 1


def test_only_the_source_is_shuffled(spark, db):
    create_bucketed(spark, db, DIM_PRODUCT, 3)
    upsert_bucketed(products(spark, *((f"P{i}", "a") for i in range(50))), db, DIM_PRODUCT)
    text = plan(merged_in_buckets(products(spark, ("P1", "b")), db, DIM_PRODUCT))
    assert text.count("Exchange ") == text.count("Exchange hashpartitioning(product_id") == 1
    target = next(block for block in text.split("FileScan")[1:] if "Bucketed: true" in block)
    assert "SelectedBucketsCount: 3 out of 3" in target


def test_bad_sources_and_plain_targets_are_refused(spark, db):
    create_bucketed(spark, db, DIM_PRODUCT, 3)
    with pytest.raises(Exception, match="repeats key"):
        upsert_bucketed(products(spark, ("P1", "a"), ("P1", "b")), db, DIM_PRODUCT)
    with pytest.raises(Exception, match="null key"):
        upsert_bucketed(products(spark, (None, "a")), db, DIM_PRODUCT)
    assert spark.table(f"{db}.dim_product").count() == 0
    ensure_tables(spark, db, [FACT_SALES_DAILY])
    with pytest.raises(ValueError, match="not bucketed"):
        upsert_bucketed(spark.table(f"{db}.fact_sales_daily"), db, FACT_SALES_DAILY)
