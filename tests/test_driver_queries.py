"""Every driver query against its SQL on the smallest tables."""

from pathlib import Path

import pytest

import __spark_entry__ as contract

duckdb = pytest.importorskip("duckdb")

TABLES = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not TABLES.exists(), reason="the driver's tables are not here")

QUERIES, ORACLES = contract.driver_queries.queries(), contract.driver_oracles.oracle_sql()


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for path in TABLES.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'").fetchall()
    return connection


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_its_sql(spark, oracle, name):
    result = QUERIES[name](spark, str(TABLES))
    columns = sorted(result.columns)
    found = sorted(map(repr, (tuple(r) for r in result.select(*columns).collect())))
    listed = ", ".join(f'"{c}"' for c in columns)
    expected = oracle.execute(f"SELECT {listed} FROM ({ORACLES[name]})").fetchall()
    assert found == sorted(map(repr, expected))
    assert found


def test_entry(spark):
    assert contract.entry(spark).columns == [
        "warehouse_id",
        "product_id",
        "product_name",
        "quantity_in_stock",
        "stock_status",
        "shipment_id",
        "status",
        "location",
        "timestamp",
        "delay_reason",
        "snapshot_date",
    ]
